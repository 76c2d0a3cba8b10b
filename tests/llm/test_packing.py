import bisect
import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from endpointlens.llm.packing import WordTokenizer, best_fit_plan, pack

PATH = public_tokenizers.path("word_bpe_49k.json")


def test_plan_is_best_fit_decreasing():
    rng = random.Random(5)
    for _ in range(120):
        window = rng.choice([16, 50, 97])
        histogram = {n: rng.randint(1, 40) for n in rng.sample(range(1, window + 1), rng.randint(1, window))}
        fills = defaultdict(list)
        for length, _, count, first, per, offset in best_fit_plan(histogram, window):
            for i in range(count):
                fills[first + i // per].append((offset + length * (i % per), length))
        open_ = []
        for length in sorted(histogram, reverse=True):
            for _ in range(histogram[length]):
                k = bisect.bisect_left(open_, length)
                bisect.insort(open_, (window if k == len(open_) else open_.pop(k)) - length)
        for pieces in fills.values():
            at = 0
            for offset, length in sorted(pieces):
                assert offset == at
                at += length
        assert sorted(window - sum(n for _, n in p) for p in fills.values()) == open_
    assert best_fit_plan({}, 10) == []


@pytest.mark.parametrize("text", ["", "The quick, brown fox's 12 jumps!!\n\nIt'll", "Élève «ñandú» ß Übung", "İstanbul ＡＢＣ ﬁ é \x1c\x85 汉字 a<|endoftext|>b", "x" * 5000, " \t ", "don't 'S 'll'll 3.14"])
def test_ids_are_the_tokenizers(text):
    want = Tokenizer.from_file(PATH).encode(text, add_special_tokens=False).ids
    assert np.frombuffer(WordTokenizer(PATH).encode(text), "<u4").tolist() == want


def test_round_trip(spark):
    rng = random.Random(2)
    words = ["alpha", "Beta,", "gamma!", "delta", "über", "42"]
    docs = [(i, " ".join(rng.choice(words) for _ in range(rng.choice([0, 3, 40, 300])))) for i in range(80)]
    docs += [(900, None), (901, ""), (902, "same text here"), (902, "same text here")]
    df = spark.createDataFrame([(*d, 1) for d in docs], "doc_id long, text string, length long")
    rows = pack(df, PATH, window=64, with_ids=True).collect()
    encode = lambda t: [*Tokenizer.from_file(PATH).encode(t or "", add_special_tokens=False).ids, 1]
    by_row, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        assert zlib.crc32(np.array(r["ids"], "<u4").tobytes()) == r["ids_crc32"] and len(r["ids"]) == r["length"]
        by_row[r["row"]].append(r)
        sequences[r["sequence_id"]].append(r)
    got = sorted((p[0]["doc_id"], [x for r in sorted(p, key=lambda r: r["start"]) for x in r["ids"]]) for p in by_row.values())
    assert got == sorted((i, encode(t)) for i, t in docs)
    assert all(r["doc_tokens"] == len(encode(dict(docs)[r["doc_id"]])) for r in rows)
    for pieces in sequences.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= 64
    assert pack(df.limit(0), PATH).count() == 0
