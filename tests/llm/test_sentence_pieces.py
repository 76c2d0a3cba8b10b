import random

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor

from endpointlens.llm.queries import op12_sentence_pieces
from endpointlens.llm.sentence_pieces import CUTS, PieceTable, decode, encode

PATH = public_tokenizers.path("piece_bpe_32k.model")
LIBRARY = SentencePieceProcessor(model_file=PATH)
BITS = ["a", "b", "the", " ", "  ", "\n", "\t", "é", "汉", "字", "的", "😀", "▁", "1", "23", "ing", "tion", "ß", "\x00", "<s>", "x" * 9, "    ", "Ａ", "ﬁ", "́", "н", "ов", "ا", "...", "==", "//", "힣", "\r\n", " " * 17, "***", "O'N"]


@pytest.fixture(scope="module")
def pieces():
    return PieceTable(PATH)


def ids(pieces, text):
    return np.frombuffer(pieces.encode(text), np.int32).tolist()


def wanted(text):
    return [*LIBRARY.encode(text or ""), LIBRARY.eos_id()]


def test_random_texts(pieces):
    rng = random.Random(1)
    for _ in range(4000):
        text = "".join(rng.choices(BITS, k=rng.randint(0, 40)))
        assert ids(pieces, text) == wanted(text), text
    for _ in range(100):
        code = lambda: rng.choice([rng.randint(0, 127), rng.randint(0, 0x2FFF), rng.randint(0x10000, 0x1FFFF), rng.randint(97, 122)])
        text = "".join(chr(code()) for _ in range(300))
        assert ids(pieces, text) == wanted(text)


@pytest.mark.parametrize("text", [None, "", " ", "x" * 30_000, " " * 30_000, "ab" * 20_000, "-" * 30_001, "aaaa bbb" * 5_000, "汉字" * 9_000, "\n" * 5_000, "a▁b▁▁c"])
def test_long_runs(pieces, text):
    assert ids(pieces, text) == wanted(text)


def test_random_letters_without_a_space(pieces):
    text = "".join(random.Random(2).choices("abcdefghijklmnopqrstuvwxyz", k=40_000))
    assert ids(pieces, text) == wanted(text)


def test_coarser_cuts_and_short_stretches_change_nothing(pieces):
    import re

    rng = random.Random(5)
    texts = ["".join(rng.choices(BITS, k=60)) for _ in range(150)]
    for cut in CUTS:
        other = PieceTable(PATH)
        other.cut = re.compile(cut)
        assert [ids(other, t) for t in texts] == [wanted(t) for t in texts]
    for step in (1, 3, 10):
        other = PieceTable(PATH, most=20, longest=4)
        other.end_of_stretch = lambda text, at, s=step: PieceTable.end_of_stretch(other, text, at, s)
        assert [ids(other, t) for t in texts] == [wanted(t) for t in texts]


def test_touching_pieces_are_judged_like_greedy_merging(pieces):
    rng = random.Random(3)
    known = [k for k in pieces.text if pieces.history(k)[0]]
    parts = lambda t: pieces.merges(t)[0]
    for _ in range(20_000):
        a, b = rng.choice(known), rng.choice(known)
        assert pieces.stay_apart(a, b) == (parts(pieces.text[a] + pieces.text[b]) == [pieces.text[a], pieces.text[b]])


def test_tables(spark):
    rows = [(1, "The quick  brown\nfox"), (2, None), (3, ""), (3, ""), (None, "é😀 汉"), (5, "long words " * 20_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"ids": F.lit("mine"), "_source": F.lit(1)}).repartition(3)
    got = decode(encode(df, PATH), PATH)
    assert got.columns == ["doc_id", "text", "_source", "ids", "decoded"]
    found = sorted(((r["doc_id"] or 0, r["ids"], r["decoded"]) for r in got.collect()))
    assert found == sorted((k or 0, wanted(t), LIBRARY.decode(wanted(t))) for k, t in rows)
    assert decode(encode(df.limit(0), PATH), PATH).collect() == []
    empty = decode(df.select(F.lit(None).cast("array<int>").alias("ids")), PATH).distinct().collect()
    assert [r["decoded"] for r in empty] == [""]


def test_digests(spark):
    import hashlib

    folder = "/root/testdata/sf0.001"
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    got = {r["doc_id"]: r for r in op12_sentence_pieces(spark, folder).collect()}
    for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect():
        want = wanted(r["text"])
        assert got[r["doc_id"]][1:] == (len(want), sha(" ".join(map(str, want))), sha(LIBRARY.decode(want)))
