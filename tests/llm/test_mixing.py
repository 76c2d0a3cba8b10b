import random
import re
from collections import defaultdict

from endpointlens.llm.mixing import mix, word_count
from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, source string, size string"


def targets(sizes, cycle=(3, 1, 2), share=1.5, limit=2.0):
    """Reshare the excess by weight until no source is above its cap, as the rule reads."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + [None] * (None in sizes)
    weight = {s: cycle[k % len(cycle)] for k, s in enumerate(names)}
    cap = {s: limit * sizes[s] for s in names}
    total, capped = share * sum(sizes.values()), set()
    while True:
        free = [s for s in names if s not in capped]
        left = total - sum(cap[s] for s in capped)
        want = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = {s for s in free if want[s] > cap[s]}
        if not over:
            return {**{s: cap[s] for s in capped}, **want}
        capped |= over


def made(seed, n=200):
    rng = random.Random(seed)
    sources = ["b", "a", None, "é", "Z", "tiny"]
    weights = [60, 20, 5, 10, 4, 1]
    return [(i, rng.choice([None, "", "w " * rng.randint(1, 60)]) if rng.random() < 0.2 else "x " * rng.randint(1, 90), rng.choices(sources, weights)[0], "clash") for i in range(n)] + [(999, "one", "tiny", "")]


def check(rows, docs):
    count = {d[0]: len(re.findall(r"[^\x20\x09-\x0D]+", d[1] or "")) for d in docs}
    sizes = defaultdict(int)
    for d in docs:
        sizes[d[2]] += count[d[0]]
    want, got = targets(sizes), defaultdict(int)
    for r in rows:
        assert r["size"] == count[r["doc_id"]] and r["source_size"] == sizes[r["source"]]
        assert abs(r["target"] - want[r["source"]]) < 1e-6
        assert 0 <= r["taken"] <= 2 * r["size"]
        got[r["source"]] += r["taken"]
    assert len(rows) == len(docs)
    for s in sizes:
        assert abs(got[s] - want[s]) <= 1, s


def test_targets_and_taken(spark):
    for seed, block in ((1, 8), (2, 64), (3, 2048)):
        docs = made(seed)
        df = spark.createDataFrame(docs, SCHEMA).repartition(5)
        decisions, pieces = mix(df, block=block)
        rows = decisions.collect()
        check(rows, docs)
        again = mix(spark.createDataFrame(docs, SCHEMA).repartition(2), block=block)[0].collect()
        assert sorted((r["doc_id"], r["taken"]) for r in rows) == sorted((r["doc_id"], r["taken"]) for r in again)
        taken = defaultdict(int)
        for p in pieces.collect():
            assert 0 <= p["first"] < p["last"] <= p["size"]
            taken[p["doc_id"]] += p["last"] - p["first"]
        assert all(taken[r["doc_id"]] == r["taken"] for r in rows)


def test_every_stretch_is_near_the_weights(spark):
    docs = [(i, "w " * 50, "abc"[i % 3], "") for i in range(600)]
    decisions, pieces = mix(spark.createDataFrame(docs, SCHEMA), block=50)
    slots = pieces.groupBy("slot").agg(F.min("source").alias("s")).orderBy("slot").collect()
    n = len(slots)
    share = lambda part: sum(x["s"] == "a" for x in part) / len(part)
    assert all(abs(share(slots[k : k + 100]) - share(slots)) < 0.06 for k in range(0, n - 100, 100))


def test_empty_and_repeated(spark):
    assert mix(spark.createDataFrame([], SCHEMA))[0].count() == 0
    nothing = spark.createDataFrame([(1, None, "a", ""), (2, "", None, "")], SCHEMA)
    assert [r["taken"] for r in mix(nothing)[0].collect()] == [0, 0]
    twice = spark.createDataFrame([(1, "a b c", "s", ""), (1, "a b c", "s", "")], SCHEMA)
    rows = mix(twice)[0].collect()
    assert [r["size"] for r in rows] == [3, 3] and sum(r["taken"] for r in rows) == 9


def test_words(spark):
    df = spark.createDataFrame([(" a\tb\x0bc\n", 3), (None, 0), ("", 0), ("x\x1cy z", 2)], "t string, n long")
    assert all(r["n"] == r["w"] for r in df.withColumn("w", word_count(F.col("t"))).collect())
