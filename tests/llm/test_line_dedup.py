import random

import numpy as np
import pytest

from endpointlens.llm.line_dedup import CuckooFilter, LineIndex, dedup_lines

STRIP = " \t\n\x0b\x0c\r"
SCHEMA = "doc_id long, text string, kept_text string"


def brute(docs, least=10):
    """docs: (doc_id, text). {doc_id: (n_lines, n_dropped, kept)} by the rule as it reads."""
    key = lambda line: "".join(c.lower() if c.isascii() else c for c in line.strip(STRIP))
    holders = {}
    for i, text in docs:
        for line in (text or "").split("\n"):
            if len(key(line)) >= least:
                holders.setdefault(key(line), set()).add(i)
    out = {}
    for i, text in docs:
        lines = (text or "").split("\n")
        stay = [x for x in lines if not (len(holders.get(key(x), ())) > 1 and min(holders[key(x)]) != i)]
        out[i] = (len(lines), len(lines) - len(stay), "\n".join(stay))
    return out


def made(n, seed):
    rng = random.Random(seed)
    pool = ["A shared line of text", "  a SHARED line of text\t", "short", "", "ÄÖ ümlaut zeile lang", "äö ümlaut zeile lang", "another common line", "\x0banother common line "]
    return [(i, None if rng.random() < 0.05 else "\n".join(rng.choice(pool) if rng.random() < 0.6 else f"own line number {i} {rng.random()}" for _ in range(rng.randint(1, 6)))) for i in range(n)]


def result(df):
    return {r["doc_id"]: (r["n_lines"], r["n_dropped"], r["kept_text"]) for r in df.collect()}


def test_against_brute_force(spark):
    docs = [*made(120, 1), (1000, ""), (1001, "x" * 200_000 + "\nA shared line of text"), (1002, "A shared line of text\nA shared line of text")]
    df = spark.createDataFrame([(*d, "clash") for d in docs], SCHEMA)
    assert result(dedup_lines(df)) == brute(docs)
    assert result(dedup_lines(df, keys_a_shard=1, lines_a_task=5)) == brute(docs)  # many filters, each in slices
    assert result(dedup_lines(df, lines_a_task=3)) == brute(docs)


def test_extra_columns_of_any_name(spark):
    names = ["drops", "_id", "_th", "row", "own", "new", "text_hash", "h1", "shard", "k"]
    rows = [(1, "the very same line", *range(10)), (2, "the very same line", *range(10)), (None, "the very same line", *range(10))]
    df = spark.createDataFrame(rows, ", ".join(["doc_id long", "text string", *(f"{n} int" for n in names)]))
    out = sorted(dedup_lines(df).collect(), key=lambda r: (r["doc_id"] is None, r["doc_id"]))
    assert [(r["doc_id"], r["n_dropped"], r["kept_text"]) for r in out] == [(1, 0, "the very same line"), (2, 1, ""), (None, 0, "the very same line")]
    assert all([r[n] for n in names] == list(range(10)) for r in out)


def test_empty_and_repeated(spark):
    assert dedup_lines(spark.createDataFrame([], SCHEMA)).count() == 0
    twice = spark.createDataFrame([(5, "the very same line", ""), (5, "the very same line", ""), (7, "the very same line", "")], SCHEMA)
    rows = sorted((r["doc_id"], r["n_dropped"]) for r in dedup_lines(twice).collect())
    assert rows == [(5, 0), (5, 0), (7, 1)]


def test_index_is_reversible(spark):
    docs = made(90, 2)
    frame = lambda part: spark.createDataFrame([(*d, "") for d in part], SCHEMA)
    index = LineIndex(spark, shards=3)
    index.insert(frame(docs[:40]))
    index.insert(frame(docs[40:]))
    with pytest.raises(ValueError):
        index.insert(frame([(1, "some line that the index has not seen")]))
    assert result(index.decide(frame(docs))) == brute(docs)
    gone = [d for d in docs if d[0] % 3 == 0]
    left = [d for d in docs if d[0] % 3]
    index.delete(frame(gone))
    index.delete(spark.createDataFrame([(999_999,)], "doc_id long"))
    assert result(index.decide(frame(left))) == brute(left)
    index.insert(frame(gone))
    assert result(index.decide(frame(docs))) == brute(docs)


@pytest.mark.parametrize("n", [0, 1, 7, 5000])
def test_cuckoo_filter(n):
    rng = np.random.default_rng(n)
    h1, h2 = (rng.integers(-(2**63), 2**63 - 1, n, dtype=np.int64) for _ in range(2))
    made = CuckooFilter.load(CuckooFilter.of(h1, h2).dump())
    assert made.contains(h1, h2).all()
    o1, o2 = (rng.integers(-(2**63), 2**63 - 1, 20_000, dtype=np.int64) for _ in range(2))
    assert made.contains(o1, o2).mean() < 0.002
    half = n // 2
    made.delete(h1[:half], h2[:half])
    assert made.contains(h1[half:], h2[half:]).all()
    assert made.contains(h1[:half], h2[:half]).sum() <= max(2, 0.01 * n)
