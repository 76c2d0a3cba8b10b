import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from endpointlens.llm.resampling import drawn_documents, resample, run_buckets

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def features(text, buckets):
    words = WORD.findall((text or "").translate(LOWER))
    return len(words), [zlib.crc32(" ".join(words[i : i + k]).encode()) % buckets for k in (1, 2, 3) for i in range(len(words) - k + 1)]


def slow(docs, target, buckets=10_000, least=20, percent=5):
    s, t = (Counter(b for text in texts for b in features(text, buckets)[1]) for texts in ([d[1] for d in docs], target))
    n_s, n_t = s.total(), t.total()
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (n_s + buckets) / ((s[b] + 1) * (n_t + buckets))))
    rows = []
    for doc_id, text in docs:
        words, found = features(text, buckets)
        h = int(hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        weight = sum(map(gain, found))
        rows.append([doc_id, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), words])
    part = sorted((r for r in rows if r[4] >= least), key=lambda r: (-r[3], r[0] is not None, r[0] or 0, r[1]))
    rank = {id(r): k + 1 for k, r in enumerate(part[: percent * len(part) // 100])}
    return [(*r[:4], rank.get(id(r))) for r in rows]


def ordered(rows):
    return sorted(rows, key=lambda r: tuple((x is not None, x or 0) for x in r))


def made(seed, n):
    rng = random.Random(seed)
    words = [f"w{k}" for k in range(60)] + ["Élan", "ÉLAN", "汉字", "x_y", "a`b", "O'Neil", "UPPER", "\x85", "1st", "naïve-ish", "\x00", "{}", "ß"]
    return [(k, rng.choice([" ", "\n", "--"]).join(rng.choices(words, k=rng.choice([0, 1, 2, 19, 20, 21, 90])))) for k in range(n)]


def test_equals_plain_python(spark):
    docs = made(3, 700)
    docs += [(None, docs[5][1]), (None, "one two"), (5000, None), (5001, ""), (5002, docs[9][1] * 300), (7, docs[7][1]), (7, docs[7][1]), (8, docs[11][1])]
    target = [t for _, t in made(4, 30)] + [None, ""]
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumns({"weight": F.lit("mine"), "_at": F.lit(1), "part": F.lit(2)}).repartition(7)
    goal = spark.createDataFrame([(t,) for t in target], "text string")
    got = [tuple(r) for r in resample(df, goal).collect()]
    assert ordered(got) == ordered(slow(docs, target))
    few = [tuple(r) for r in resample(df, goal, buckets=50, percent=60).collect()]
    assert ordered(few) == ordered(slow(docs, target, buckets=50, percent=60))


@pytest.mark.parametrize("step", [1, 2, 7, 50, 10_000])
def test_pieces_of_a_text_give_the_same_runs(step):
    for _, text in made(6, 120):
        got = list(run_buckets(text, 3, 1000, step))
        words, want = features(text, 1000)
        assert sum(n for n, _ in got) == words
        assert Counter(b for _, found in got for b in found.tolist()) == Counter(want)


def test_empty_tables(spark):
    docs, none = spark.createDataFrame([(1, "a b " * 30)], "doc_id int, text string"), spark.createDataFrame([], "doc_id int, text string")
    assert [tuple(r) for r in resample(docs, none).collect()] == slow([(1, "a b " * 30)], [])
    assert resample(none, docs).collect() == []
    assert resample(docs, docs).schema.simpleString() == "struct<doc_id:int,n_features:bigint,weight:bigint,score:bigint,rank:bigint>"


def test_draws_what_resembles_the_target(spark):
    rng = random.Random(9)
    near, far = [f"near{k}" for k in range(40)], [f"far{k}" for k in range(40)]
    docs = [(k, " ".join(rng.choices(near if k % 10 == 0 else far, k=60))) for k in range(400)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    goal = spark.createDataFrame([(" ".join(rng.choices(near, k=60)),) for _ in range(20)], "text string")
    taken = drawn_documents(df, resample(df, goal)).collect()
    assert len(taken) == 20 and all(r["doc_id"] % 10 == 0 for r in taken)
