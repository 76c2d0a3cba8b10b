"""Operators against plain sequential rules, on rows of their own."""

import random
from datetime import date, timedelta

import pytest
from endpointlens.functions import text as t
from endpointlens.operators import corpus, dedup, evaluate, export, history
from endpointlens.operators.score import score_probes
from endpointlens.plans import pipelines
from endpointlens.sources import readers
from pyspark.sql import functions as F


def one(spark, column, value, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(column(F.col("v")).alias("r")).first()["r"]


@pytest.mark.parametrize(
    "url, want",
    [
        ("HTTPS://Dns.Example.COM:443/dns-query/", "https://dns.example.com/dns-query"), (" https://u:p@h/a/?x=1#f ", "https://h/a/?x=1"), ("https://h:8443", "https://h:8443/dns-query"), ("https://h/", "https://h/"),
        ("http://h/dns-query", None), ("https:///x", None), ("https://h:99999/x", None), ("https://h:x/", None), ("", None), (None, None), ("https://[2001:DB8::1]:853/q", "https://[2001:db8::1]:853/q"), ("https://h/Path//", "https://h/Path"),
    ],
)
def test_canonical_url(spark, url, want):
    assert one(spark, t.canonical_url, url) == want


@pytest.mark.parametrize("host, want", [(" 192.0.2.1 ", "192.0.2.1"), ("192.0.2.256", None), ("01.2.3.4", None), ("2001:DB8:0:0::1", "2001:db8::1"), ("::g", None), ("name", None), (None, None)])
def test_addresses(spark, host, want):
    assert one(spark, t.normalize_ip, host) == want


def test_small_columns(spark):
    assert one(spark, t.parse_key, "dns-udp|192.0.2.1|x") == ("dns-udp", "192.0.2.1", 53)
    assert one(spark, t.parse_key, "doh|https://a/b|c")[1] == "https://a/b|c" and one(spark, t.parse_key, "k")[0] == "unknown"
    assert one(spark, t.parse_endpoint, "h:5353") == ("h", 5353) and one(spark, t.parse_endpoint, "2001:db8::1") == ("2001:db8::1", 53)
    assert one(spark, t.reasons_signature, ["b", "", "a", "b"], "array<string>") == "a|b"
    assert one(spark, lambda c: t.normalize_answers(c, F.lit("NS")), ["B.Example..", "a"], "array<string>") == ["a.", "b.example."]
    assert one(spark, lambda c: t.probe_id(F.lit("p"), c, F.lit("AAAA")), "A.Root.") == "p-a-root-aaaa"
    assert [one(spark, t.classify_error, e) for e in ("timeout_or_error:x", "unexpected_rcode:REFUSED", "unexpected_rcode:NOTIMP", "x tls_error", "?")] == ["timeout_or_error", "unexpected_rcode_suspicious", "unexpected_rcode", "tls_error", "error"]


def scored(spark, probes, **columns):
    rows = [(1, k, ok, lat, err) for k, (ok, lat, err) in enumerate(probes)]
    df = spark.createDataFrame(rows, "id int, seq int, ok boolean, latency_ms double, error string")
    return score_probes(df, ["id"]).first()


def test_scores(spark):
    good = scored(spark, [(True, 10.0, None)] * 20)
    assert (good["score"], good["status"], good["confidence_score"]) == (90, "accepted", 55)
    hard = scored(spark, [(True, 10.0, None)] * 19 + [(False, None, "answer_mismatch")])
    assert (hard["score"], hard["status"]) == (59, "rejected") and "hard_fail_cap" in hard["score_caps_applied"]
    slow = scored(spark, [(True, 1600.0, None)] * 4)
    assert slow["performance_score"] == 11 and slow["reasons"] == ["latency_very_high", "latency_p95_high"]
    dead = scored(spark, [(False, None, "timeout_or_error:t")] * 4)
    assert dead["reasons"] == ["timeout_or_error", "timeout_rate_high", "no_latency_samples"] and dead["correctness_score"] == 30


def sequential_quarantine(days, streak, keep):
    """days: (date, status, signature) in order."""
    record, run, last = None, 0, None
    for d, status, sig in days:
        run = (run + 1 if last == d - timedelta(days=1) else 1) if status == "rejected" else 0
        last = d
        if record and record["retry"] <= d:
            record = {**record, "last": d, "retry": d + timedelta(days=keep), "cycles": record["cycles"] + 1} if status == "rejected" and sig == record["sig"] else None
        elif not record and run >= streak:
            record = {"first": d, "last": d, "retry": d + timedelta(days=keep), "sig": sig, "cycles": 1}
    return record


def host_rows(seed, hosts=40, days=60):
    rng = random.Random(seed)
    start = date(2024, 1, 1)
    return [(f"h{h}", start + timedelta(days=k), rng.choices(["rejected", "accepted", "candidate"], [8, 1, 1])[0], rng.choice("ab" if h % 2 else "a")) for h in range(hosts) for k in range(days) if rng.random() < 0.93]


def test_quarantine_fold_and_steps_agree_with_a_loop(spark):
    rows = host_rows(1)
    df = spark.createDataFrame([(h, d, s, g, [g]) for h, d, s, g in rows], "host string, run_date date, status string, reasons_signature string, reasons array<string>").repartition(3)
    want = {}
    for h in {r[0] for r in rows}:
        record = sequential_quarantine([r[1:] for r in rows if r[0] == h], 4, 6)
        if record:
            want[h] = (record["first"], record["last"], record["retry"], record["sig"], record["cycles"])
    shape = lambda q: {r["host"]: (r["first_quarantined_on"], r["last_quarantined_on"], r["retry_after"], r["reasons_signature"], r["cycles"]) for r in q.collect()}
    assert shape(history.quarantine_fold(df, 4, 6)) == want
    few = df.where("run_date <= date'2024-01-12'")
    marked = history.rejected_streak(few, 4).cache()
    state = spark.createDataFrame([], "host string, first_quarantined_on date, last_quarantined_on date, retry_after date, reasons_signature string, reasons array<string>, cycles int")
    for k in range(12):
        day = F.lit(f"2024-01-{k + 1:02d}").cast("date")
        state = spark.createDataFrame(history.quarantine_step(marked.where(F.col("run_date") == day), state, day, 6).collect(), state.schema)
    assert shape(state) == shape(history.quarantine_fold(few, 4, 6))


def test_stability_against_a_loop(spark):
    rng = random.Random(2)
    end = date(2024, 3, 1)
    rows = [(f"k{k}", end - timedelta(days=d), rng.choices(["accepted", "rejected", "candidate"], [6, 3, 1])[0], rng.random() < 0.2) for k in range(60) for d in range(45) if rng.random() < (0.99 if k % 2 else 0.7)]
    df = spark.createDataFrame(rows, "resolver_key string, run_date date, day_status string, flapped_within_day boolean")
    for r in history.stability_metrics(df, F.lit("2024-03-01").cast("date")).collect():
        own = sorted((x for x in rows if x[0] == r["resolver_key"]), key=lambda x: x[1], reverse=True)
        good = bad = 0
        for i, x in enumerate(own):
            if x[1] != end - timedelta(days=i) or x[2] == "candidate" or (x[2] == "accepted" and bad) or (x[2] == "rejected" and good):
                break
            good, bad = good + (x[2] == "accepted"), bad + (x[2] == "rejected")
        assert (r["consecutive_success_days"], r["consecutive_fail_days"]) == (good, bad)
        assert r["status_flaps_30d"] == sum(a[2] != b[2] for a, b in zip(own[:30], own[1:30]))
        assert r["runs_seen_30d"] == sum((end - x[1]).days < 30 for x in own)


def test_greedy_quota_against_a_loop(spark):
    rng = random.Random(3)
    items = [(k, f"z{rng.randrange(5)}", f"f{rng.randrange(7)}", rng.randrange(3)) for k in range(150)]
    zones, families, want = {}, {}, {}
    for k, z, f, n in items:
        take = 0 if families.get(f, 0) >= 4 else min(n, 9 - zones.get(z, 0))
        zones[z] = zones.get(z, 0) + take
        families[f] = families.get(f, 0) + (take > 0)
        want[k] = take
    df = spark.createDataFrame(items, "ordinal long, zone string, family string, want long").repartition(3)
    assert {r["ordinal"]: r["takes"] for r in corpus.greedy_quota(df, 9, 4).collect()} == want


def test_byte_parts_against_a_loop(spark):
    rng = random.Random(4)
    rows = [(g, k, rng.randint(1, 60) if rng.random() < 0.95 else 300) for g in "ab" for k in range(150)]
    want = {}
    for g in "ab":
        part, used = 1, None
        for _, k, n in (r for r in rows if r[0] == g):
            if used is None:
                used = 2 + n
            elif used + 1 + n <= 200:
                used += 1 + n
            else:
                part, used = part + 1, 2 + n
            want[g, k] = part
    df = spark.createDataFrame(rows, "g string, pos long, size long").repartition(3)
    assert {(r["g"], r["pos"]): r["part"] for r in export.pack_by_bytes(df, ["g"], [F.col("pos")], 200).collect()} == want


def test_shards_lists_and_pruning(spark):
    df = spark.createDataFrame([(k,) for k in range(5)], "k long").repartition(3)
    assert sorted(r["shard"] for r in export.assign_shards(df, 3, ["k"]).collect()) == [0, 0, 1, 1, 2]
    rows = [("accepted", "dns-udp", "192.0.2.1", 53, 1), ("accepted", "dns-tcp", "192.0.2.1", 5353, 2), ("rejected", "dns-udp", "192.0.2.2", 53, 3), ("accepted", "dns-tcp", "192.0.2.1", 53, 4)]
    r = spark.createDataFrame(rows, "status string, transport string, host string, port int, ordinal int")
    assert [x["line"] for x in export.plain_list(r).collect()] == ["192.0.2.1:53", "192.0.2.1:5353"]
    assert [x["line"] for x in export.forwarder_lines(r).collect()] == ["    forward-addr: 192.0.2.1"]
    p = spark.createDataFrame([("rejected", [(False,), (True,)]), ("rejected", [(False,)]), ("accepted", [(True,)])], "status string, probes array<struct<ok:boolean>>")
    assert [(x["all_probes_failed"], x["probes"] and len(x["probes"])) for x in export.failed_only(p).collect()] == [(None, 1), (True, None), (None, 1)]


def test_sources(spark):
    csv = spark.createDataFrame([("192.0.2.1", "0.9", "Org", "DE", 0), ("192.0.2.2", "bad", "", "", 1), ("", "1", "", "", 2)], "ip_address string, reliability string, as_org string, country_id string, ordinal int")
    kept, out = readers.read_csv_list(csv)
    assert sorted((r["host"], r["transport"]) for r in kept.collect()) == [("192.0.2.1", "dns-tcp"), ("192.0.2.1", "dns-udp")]
    assert {r["reason"] for r in out.collect()} == {"source_reliability_below_min"} and out.count() == 2
    lines = spark.createDataFrame([(0, "# note"), (1, "192.0.2.1"), (2, "192.0.2.2:5353 # x"), (3, "2001:db8::1"), (4, " ")], "ordinal int, value string")
    hosts = {(r["host"], r["port"]) for r in readers.read_line_list(lines)[0].collect()}
    assert hosts == {("192.0.2.1", 53), ("192.0.2.2", 5353), ("2001:db8::1", 53)}
    page = spark.createDataFrame([(0, "see https://a.example/dns-query, and (https://b.example/dns-query) https://a.example/dns-query.")], "page int, value string")
    assert [r["endpoint_url"] for r in readers.scrape_urls(page).orderBy("ordinal").collect()] == ["https://a.example/dns-query", "https://b.example/dns-query"]
    nd = ['{"name":"A.","resolver":"r","type":"a","status":"noerror","answers":["a. 60 IN A 192.0.2.1"]}', "broken", '{"qname":"b.","rcode":"NXDOMAIN"}']
    good, bad = readers.read_responses(spark.createDataFrame(list(enumerate(nd)), "line_no int, value string"))
    assert [(r["qname"], r["rdtype"], r["rcode"], r["answers"]) for r in good.orderBy("line_no").collect()] == [("a.", "A", "NOERROR", ["192.0.2.1"]), ("b.", "A", "NXDOMAIN", [])]
    assert [r["line_no"] for r in bad.collect()] == [1]


def test_discover_and_reject_trail(spark):
    lines = spark.createDataFrame([(0, "192.0.2.1"), (1, "192.0.2.1"), (2, "nonsense")], "ordinal int, value string")
    records = spark.createDataFrame([(0, "https://D.example/"), (1, "https://d.example/"), (2, "ftp://x/")], "ordinal int, url string")
    kept, out = pipelines.discover([readers.read_line_list(lines), (readers.read_endpoint_records(records), None)])
    assert sorted((r["transport"], r["endpoint_url"] or r["host"]) for r in kept.collect()) == [("dns-tcp", "192.0.2.1"), ("dns-udp", "192.0.2.1"), ("doh", "https://d.example/")]
    reasons = sorted(r["reason"] for r in out.collect())
    assert reasons == ["duplicate_dns_candidate"] * 2 + ["duplicate_doh_candidate"] + ["invalid_dns_host"] * 2 + ["invalid_doh_url"]


def test_discover_keeps_the_first_by_number(spark):
    """Ordinals of sources are ordered as numbers: row 9 comes before row 10."""
    hosts = spark.createDataFrame([(10, "b", " 192.0.2.1"), (9, "a", "192.0.2.1")], "ordinal long, provider string, host string").selectExpr("*", "53 AS port", "'dns-udp' AS transport")
    urls = spark.createDataFrame([((10, 1), "HTTPS://d.example"), ((9, 2), "https://D.example/dns-query")], "ordinal struct<page:int,at:int>, endpoint_url string").selectExpr("*", "'doh' AS transport")
    kept, out = pipelines.discover([(hosts, None), (urls, None), (hosts, None)])
    assert [(r["provider"], r["ordinal"]["source_no"]) for r in kept.where("transport = 'dns-udp'").collect()] == [("a", 0)]
    assert [r["endpoint_url"] for r in out.where("transport = 'doh'").collect()] == ["HTTPS://d.example"]


def test_baseline_sorts_no_observation(spark):
    """Only the few sets of a question are sorted, not all observations, and resolvers are counted where there is one set."""
    kind = "qname string, rdtype string, resolver string, answers array<string>, error string"
    rows = [("a", "A", r, ["x", "y"] if r == "1" else ["y", "x"], None) for r in "12" for _ in range(50)] + [("b", "A", r, [r], None) for r in "12"] + [("c", "A", "1", ["x"], None), ("c", "A", None, ["x"], None)]
    rows += [(None, "A", r, ["n"], None) for r in "12"] + [("e", "A", "1", None, None), ("e", "A", "2", ["x"], None), ("f", "A", "1", ["x"], "late")]
    seen = spark.createDataFrame(rows, kind)
    out = evaluate.baseline_consensus(seen, 2)
    assert {r["qname"]: r["agreed"] for r in out.collect()} == {"a": ["x", "y"], "b": None, "c": None, None: ["n"], "e": ["x"]}
    assert "SortAggregate" not in out._jdf.queryExecution().sparkPlan().toString()


def test_rollup_takes_one_aggregate(spark):
    """Kinds of status are counted in the aggregate of the day, without a round of their own."""
    from endpointlens.operators import history

    runs = spark.createDataFrame([("r1", "2024-01-01"), ("r2", "2024-01-01")], "run_id string, run_date string").selectExpr("run_id", "date(run_date) AS run_date")
    kind = "run_id string, resolver_key string, host string, transport string, status string, reasons array<string>, p50_latency_ms double, p95_latency_ms double, jitter_ms double"
    rows = [("r1", "k", "h", "doh", "accepted", [], 1.0, 1.0, 0.0), ("r2", "k", "h", "doh", "candidate", [], 1.0, 1.0, 0.0), ("r1", "l", "h", "doh", "accepted", [], 1.0, 1.0, 0.0), ("r2", "l", "h", "doh", None, [], 1.0, 1.0, 0.0)]
    out = history.daily_rollup(runs, spark.createDataFrame(rows, kind))
    assert {r["resolver_key"]: r["flapped_within_day"] for r in out.collect()} == {"k": True, "l": False}
    assert out._jdf.queryExecution().sparkPlan().toString().count("Aggregate(") == 2  # partial and final


def test_votes(spark):
    kind = "id string, seq int, check_no int, rcode string, answers array<string>, error string"
    rows = [("m", 1, 0, "NXDOMAIN", [], None), ("m", 2, 1, "NOERROR", ["x"], None), ("i", 1, 0, "SERVFAIL", [], None), ("n", 1, 0, "NXDOMAIN", [], None), ("n", 2, 0, "NXDOMAIN", [], None), ("f", 1, 0, None, None, "t")]
    got = {r["id"]: r["rejection_reason"] for r in evaluate.vote_negative(spark.createDataFrame(rows, kind), ["id"], quorum=1).collect()}
    assert got == {"m": "negative_parent_wildcard_like", "i": "negative_parent_inconsistent", "n": None, "f": "insufficient_baseline_consensus"}
    rows = [("a", 1, 0, "NOERROR", ["x", "y"], None), ("a", 2, 0, "NOERROR", ["y", "x"], None), ("d", 1, 0, "NOERROR", ["x"], None), ("d", 2, 0, "NOERROR", ["x"], None), ("d", 3, 0, "NOERROR", ["y"], None), ("t", 1, 0, None, None, "t")]
    got = {r["id"]: (r["rejection_reason"], r["agreed"]) for r in evaluate.vote_consensus(spark.createDataFrame(rows, kind), ["id"]).collect()}
    assert got == {"a": (None, "x,y"), "d": ("baseline_disagreement", None), "t": ("timeout_rate_high", None)}


def test_corpus_checks(spark):
    with pytest.raises(ValueError, match="negative_generated: 1 of 3"):
        corpus.check_minimums({"positive_exact": 6, "positive_consensus": 3, "negative_generated": 1})
    probes = spark.createDataFrame(
        [("a", "positive_exact", "exact_rrset", None), ("a", "negative_generated", "nxdomain", None), ("b", "other", "x", "z.")], "id string, kind string, expected_mode string, parent_zone string"
    )
    errors = sorted((r["id"], tuple(r["errors"])) for r in corpus.logic_errors(probes).collect())
    assert errors == [("a", ("duplicate id",)), ("a", ("negative probe without parent_zone", "duplicate id")), ("b", ("unknown kind",))]
    assert corpus.build_corpus(spark, "controlled", "z.example.").count() == 5 and corpus.build_corpus(spark, "fallback").count() == 8
    assert dedup.duplicate_ids(probes, "id").count() == 1
