"""Operators on one key that holds most rows, against plain Python."""

import json
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from endpointlens.operators import dedup, evaluate, export, metrics
from endpointlens.operators.ranks import ahead, slices


def plans(df):
    return df._jdf.queryExecution().toString()


@pytest.mark.parametrize("bound", [0, 10**6])
def test_quantiles_of_one_endpoint_with_most_rows(spark, bound):
    rng = random.Random(3)
    rows = [("hot", k, True, rng.choice([12.5, round(rng.expovariate(0.01), 3), -1.0])) for k in range(6000)]
    rows += [(f"e{k % 40}", k, rng.random() < 0.7, rng.choice([None, round(rng.random() * 900, 2)])) for k in range(500)]
    rows += [("none", 1, False, 5.0), ("nan", 1, True, float("nan")), ("nan", 2, True, 1.0), ("nan", 3, True, 2.0), (None, 1, True, 7.0)]
    df = spark.createDataFrame(rows, "endpoint string, seq int, ok boolean, latency_ms double").repartition(5)
    got = {r["endpoint"]: r for r in metrics.latency_stats(df, ["endpoint"], bound=bound).collect()}
    good = defaultdict(list)
    for e, _, ok, x in rows:
        good[e] += [x] if ok and x is not None else []
    assert set(got) == set(good)
    for e, values in good.items():
        n = len(values)
        assert got[e]["latency_sample_count"] == n
        if e == "nan":
            continue
        values.sort()
        if not n:
            assert got[e]["p50_latency_ms"] is None and got[e]["jitter_ms"] is None
            continue
        p50 = (values[n // 2 - 1] + values[n // 2]) / 2 if n % 2 == 0 else values[n // 2]
        p95 = values[min(n * 95 // 100, n - 1)]
        assert (got[e]["p50_latency_ms"], got[e]["p95_latency_ms"], got[e]["jitter_ms"]) == (p50, p95, max(0.0, p95 - p50))
    assert got["nan"]["p50_latency_ms"] == 2.0
    assert "collect_list" not in plans(metrics.latency_stats(df, ["endpoint"], bound=bound))


def test_quantiles_of_nothing(spark):
    df = spark.createDataFrame([], "endpoint string, seq int, ok boolean, latency_ms double")
    assert metrics.latency_stats(df, ["endpoint"]).collect() == []


def slow_parts(sizes, limit):
    out, used = [], 0
    for k, x in enumerate(sizes):
        fits = k and used + 1 + x <= limit
        used = used + 1 + x if fits else 2 + x
        out.append(out[-1] if fits else (out[-1] if out else 0) + 1)
    return out


@pytest.mark.parametrize("limit", [20, 60, 1000, 10**6])
def test_parts_of_one_source_with_most_rows(spark, limit):
    rng = random.Random(limit)
    rows = [("hot" if k % 20 else rng.choice(["a", "b", None]), k, rng.choice([1, 5, 18, 40, 200])) for k in range(3000)]
    df = spark.createDataFrame(rows, "source string, pos int, size int").withColumns({"fill": F.lit("x"), "parts": F.lit(1)}).repartition(6)
    got = {(r["source"], r["pos"]): r["part"] for r in export.pack_by_bytes(df, ["source"], [F.col("pos")], limit).collect()}
    by = defaultdict(list)
    for source, pos, size in rows:
        by[source].append((pos, size))
    want = {(source, pos): part for source, found in by.items() for (pos, _), part in zip(sorted(found), slow_parts([s for _, s in sorted(found)], limit))}
    assert got == want
    assert export.pack_by_bytes(df.limit(0), ["source"], [F.col("pos")], limit).count() == 0


def test_written_parts_keep_to_their_bytes(spark, tmp_path):
    """Quotes, line breaks and backslashes count as JSON writes them."""
    rng = random.Random(2)
    texts = ['"quoted"', "line\nbreak", "back\\slash", "plain", "é汉😀", "\t\x01"]
    rows = [("accepted" if k % 9 else "rejected", "dns-udp", None, f"10.0.{k // 250}.{k % 250}", 53, None, rng.choice(texts) * rng.randint(0, 9)) for k in range(700)]
    df = spark.createDataFrame(rows, "status string, transport string, endpoint_url string, host string, port int, path string, note string")
    export.write_results(df, str(tmp_path / "out"), ("accepted", "rejected"), max_bytes=2000)
    seen = 0
    for status in ("accepted", "rejected"):
        parts = [p for p in (tmp_path / "out" / f"status={status}").glob("part=*")]
        order = []
        for part in sorted(parts, key=lambda p: int(p.name.split("=")[1])):
            lines = [line for f in part.glob("*.txt") for line in f.read_text().splitlines()]
            assert 0 < len(("[" + ",".join(lines) + "]").encode()) <= 2000
            order += [json.loads(line)["host"] for line in lines]
        assert order == sorted(order)
        seen += len(order)
    assert seen == 700


@pytest.mark.parametrize("bound", [0, 10**6])
def test_sums_ahead(spark, bound):
    rng = random.Random(8)
    rows = [(rng.choice(["hot"] * 9 + ["b", None]), rng.choice([1, None]), k, rng.randint(0, 5)) for k in range(2000)]
    df = spark.createDataFrame(rows, "k string, j int, pos int, n int").repartition(4)
    got = {r["pos"]: r["before"] for r in ahead(df, ["k", "j"], ["pos"], slices(F.col("pos"), 64), F.col("n"), bound).collect()}
    sums, want = defaultdict(int), {}
    for k, j, pos, n in rows:
        want[pos] = sums[k, j]
        sums[k, j] += n
    assert got == want
    numbered = ahead(df, ["k", "j"], ["pos"], slices(F.col("pos"), 64), bound=bound).groupBy("k", "j").agg(F.max("before").alias("m"), F.count("*").alias("n")).collect()
    assert all(r["m"] == r["n"] - 1 for r in numbered)


@pytest.mark.parametrize("bound", [0, 10**6])
def test_first_in_first_out_of_one_hot_question(spark, bound):
    rng = random.Random(5)
    probes = [(rng.choice(["r1"] * 8 + ["r2", "r3"]), rng.choice([0] * 9 + [1]), k) for k in range(1500)]
    answers = [(rng.choice(["r1"] * 5 + ["r2", "r4", None]), rng.choice([0] * 9 + [1, None]), k, k * 10) for k in range(1600)]
    p = spark.createDataFrame(probes, "resolver string, question int, probe int")
    r = spark.createDataFrame(answers, "resolver string, question int, response int, ms int")
    matched, left = evaluate.fifo_match(p, r, ["resolver"], ["question"], "probe", "response", width=100, bound=bound)
    pending, over = defaultdict(list), []
    for resolver, question, k in sorted(probes, key=lambda x: x[2]):
        pending[resolver, question].append(k)
    found, late = {}, []
    for resolver, question, k, _ in answers:
        if resolver is None:
            late.append((question, k))
        elif pending[resolver, question]:
            found[pending[resolver, question].pop(0)] = k
        else:
            over.append(k)
    rest = defaultdict(list)
    for (_, question), ks in pending.items():
        rest[question] += ks
    for question, k in late:
        rest[question].sort()
        if rest[question]:
            found[rest[question].pop(0)] = k
        else:
            over.append(k)
    got = {x["probe"]: (x["response"], x["ms"]) for x in matched.collect()}
    assert len(got) == len(probes) == matched.count()
    assert {k: v[0] for k, v in got.items() if v[0] is not None} == found
    assert all(v[1] == v[0] * 10 for v in got.values() if v[0] is not None)
    assert sorted(x["response"] for x in left.collect()) == sorted(over)


def test_keep_first_of_one_hot_key(spark):
    rng = random.Random(6)
    rows = [(rng.choice(["hot"] * 9 + ["b", "c", None]), rng.choice([53, None]), k, f"x{k}") for k in range(900)]
    df = spark.createDataFrame(rows, "host string, port int, ordinal int, note string").repartition(4)
    kept, later = dedup.keep_first(df, ["host", "port"], ["ordinal"])
    first = {}
    for host, port, k, _ in rows:
        first.setdefault((host, port), k)
    assert sorted(r["ordinal"] for r in kept.collect()) == sorted(first.values())
    assert sorted(r["ordinal"] for r in later.collect()) == sorted({r[2] for r in rows} - set(first.values()))
    assert kept.columns == later.columns == df.columns and "Window" not in plans(kept)


def slow_quota(items, zone_cap, family_cap):
    zones, families, out = defaultdict(int), defaultdict(int), {}
    for ordinal, zone, family, want in sorted(items):
        take = min(want, max(0, zone_cap - zones[zone])) if families[family] < family_cap else 0
        zones[zone] += take
        families[family] += take > 0
        out[ordinal] = take
    return out


def test_quota_of_a_chain_of_ten_thousand_hosts(spark):
    """Every host shares its zone with the one before and its family with the one behind; under caps of one each waits for the last."""
    items = [(k, f"z{(k + 1) // 2}", f"f{k // 2}", 1) for k in range(10_000)]
    df = spark.createDataFrame(items, "ordinal int, zone string, family string, want int").repartition(5)
    from endpointlens.operators.corpus import greedy_quota

    got = {r["ordinal"]: r["takes"] for r in greedy_quota(df, 1, 1).collect()}
    assert got == slow_quota(items, 1, 1) and sum(got.values()) == 5_000


@pytest.mark.parametrize("seed", range(3))
def test_quota_of_random_items(spark, seed):
    from endpointlens.operators.corpus import greedy_quota

    rng = random.Random(seed)
    items = [(k, f"z{rng.randint(0, 60)}", f"f{rng.randint(0, 60)}", rng.randint(0, 2)) for k in range(400)] + [(1000 + k, "hot", f"f{k % 90}", 2) for k in range(200)]
    df = spark.createDataFrame(items, "ordinal int, zone string, family string, want int").repartition(5)
    caps = rng.randint(1, 6), rng.randint(1, 4)
    assert {r["ordinal"]: r["takes"] for r in greedy_quota(df, *caps).collect()} == slow_quota(items, *caps)
    assert greedy_quota(df.limit(0), *caps).count() == 0


def test_components(spark):
    from endpointlens.operators.components import components

    rng = random.Random(1)
    links = [(rng.randint(0, 400), rng.randint(0, 400)) for _ in range(260)] + [(1000 + k, 1001 + k) for k in range(300)] + [(5000, 5000)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(links, "u int, v int")).collect()}
    at = {n: n for link in links for n in link}
    for _ in range(400):
        for u, v in links:
            at[u] = at[v] = min(at[u], at[v])
    assert got == at
