"""Stages keep the columns of documents, each judged on its own input by a plain rule."""

import random

import pytest

pipeline = pytest.importorskip("corpus_pipeline")


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rng = random.Random(6)
    word = lambda: "".join(rng.choice(["ka", "lo", "mi", "ren", "tu", "sol"]) for _ in range(rng.randint(1, 4)))
    rows, labels = [], []
    for i in range(240):
        text = "\n".join(" ".join(word() for _ in range(rng.randint(3, 40))) for _ in range(rng.randint(1, 4)))
        if i % 6 == 0:
            text = " ".join(f"{w.upper()}##!!" for w in text.split())
        elif i % 9 == 1 and i > 9:
            text = rows[i - 9][1]
        if i % 5 == 0:
            text += "\nall rights are reserved by us"
        rows.append((i, text, "en", f"s{i % 4}" if i % 11 else None, len(text)))
        labels.append((i, int(i % 6 > 0), 0))
    rows += [(900, None, None, None, None), (901, "", "en", "s0", 0)]
    base = str(tmp_path_factory.mktemp("sf"))
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{base}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{base}/labels.parquet")
    return base


def sets_of(text, n=5):
    w = (text or "").lower().split()
    return {tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))}


def test_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns = docs.columns
    seen = {}
    for name, stage in pipeline.STAGES[:-1]:
        before = {r["doc_id"]: r["text"] for r in docs.collect()}
        docs = stage(spark, docs, folder).cache()
        assert docs.columns == columns, name
        seen[name] = (before, docs.collect())
    before, after = seen["quality classifier"]
    kept = {r["doc_id"] for r in after}
    known = [i for i in before if i < 900]
    assert sum((i in kept) == bool(i % 6) for i in known) / len(known) > 0.95
    before, after = seen["line dedup"]
    assert {r["doc_id"] for r in after} == set(before)
    shared = "all rights are reserved by us"
    holder = min(i for i, t in before.items() if shared in (t or ""))
    assert {r["doc_id"] for r in after if shared in r["text"]} == {holder}
    assert all(r["n_chars"] == len(r["text"]) for r in after)
    before, after = seen["near-dedup"]
    left = sorted(before)
    root = {i: i for i in left}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    sets = {i: sets_of(t) for i, t in before.items()}
    for a in left:
        for b in left:
            if a < b and 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    assert sorted(r["doc_id"] for r in after) == [i for i in left if find(i) == i]
    before, after = seen["source mixing"]
    words = sum(len((t or "").split()) for t in before.values())
    assert abs(sum(len(r["text"].split()) for r in after) - 1.5 * words) < 0.02 * words
    for r in after:  # whole texts, or beginnings of them with their line breaks
        assert (before[r["doc_id"]] or "").startswith(r["text"] or "")
    out = pipeline.STAGES[-1][1](spark, docs, folder)
    assert {r["doc_id"] for r in out.select("doc_id").distinct().collect()} == {r["doc_id"] for r in docs.select("doc_id").distinct().collect()}


def test_stages_with_nulls_repeats_and_empty_tables(spark, folder):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    words = " ".join(f"w{k}" for k in range(50))
    rows = [(1, "a b c d e f g\nh", "en", "s", 15), (1, "a b c d e f g\nh", "en", "s", 15), (1, words, None, None, None), (None, words + " x", None, None, None), (None, None, None, None, None), (2, "", "", "", 0), (None, "solo text", None, "s", 9)]
    docs = spark.createDataFrame(rows, schema)
    for name, stage in pipeline.STAGES:
        stage(spark, docs.limit(0), folder).collect()
        assert stage(spark, docs, folder).count() > 0, name
    kept = pipeline.keep_one_of_near_copies(spark, docs, folder).collect()
    assert sorted((r["doc_id"] or 0, len(r["text"] or "")) for r in kept) == [(0, 9), (1, 15), (1, len(words)), (2, 0)]
    mixed = pipeline.mix_sources(spark, docs, folder).collect()
    assert sum(len((r["text"] or "").split()) for r in mixed) <= 2 * sum(len((r[1] or "").split()) for r in rows)


def test_run(spark, folder):
    assert pipeline.run(spark, folder).count() > 0
