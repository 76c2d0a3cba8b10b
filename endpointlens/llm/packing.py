"""Best-fit decreasing packing of tokenised documents into fixed windows.

A document longer than a window is first cut into full windows; what is left of it is one piece. Pieces go into
windows by best-fit decreasing: longest first, each into the tightest window that still takes it. Only the number
of pieces of each length matters to that rule, so it is run once on the histogram of lengths - at most `window`
rows, however large the corpus - with a segment tree indexed by remaining capacity that holds how many windows are
open at each. Windows of equal contents are runs, so the plan has a bounded number of rows too. Tasks then look up
where the r-th piece of a length goes. Ranks within a length are in two levels (a salt, then the pieces of one
salt) with as many salts as pieces in one, so a length that a third of all documents share is spread over tasks.

Sequences are padded to the window except where their fill is a power of two, which needs no padding.

Defined results: null or empty text is the end id alone. Repeated ids are documents of their own; each has a `row`.
An empty table gives an empty table. Equal lengths are ordered by a hash of the id and row, then id, start and row.
`row` numbers the rows as they are read, so another cut of the files may give other sequences, packed as tightly.
"""

from __future__ import annotations

import re
import zlib
from collections import defaultdict, deque
from collections.abc import Iterator
from math import isqrt

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import written


class WordTokenizer:
    """Ids of whole texts as tokenizers gives them, with each distinct word encoded once per worker.

    The vocabulary cuts at white space and between letters, digits and other signs before it merges anything. Words
    of printable ASCII and Latin-1 letters are cut here by the same pattern and merged by the model; any other
    word takes the tokenizer's whole path.
    """

    #: The contractions and classes of the vocabulary's own cutting pattern, on lower-case text.
    CUT = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^\sa-z0-9ß-öø-ÿ]+")
    PLAIN = re.compile(r"[ \t\n\r!-~À-ÖØ-öø-ÿ]*")
    SPECIAL = "<|"

    def __init__(self, path: str, most: int = 1_000_000):
        from tokenizers import Tokenizer

        self.tokenizer, self.most = Tokenizer.from_file(path), most
        self.words: dict[str, bytes] = {}
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        letters = {b: chr(b) for b in shown} | {b: chr(256 + k) for k, b in enumerate(b for b in range(256) if b not in shown)}
        self.bytes_as_letters = {c: "".join(letters[b] for b in chr(c).encode()) for c in range(33, 256)}

    def _bytes(self, ids: list[int]) -> bytes:
        return np.array(ids, "<u4").tobytes()

    def _plain(self, text: str) -> bytes:
        cut, words = self.CUT.findall(text.lower()), self.words
        try:
            return b"".join([words[w] for w in cut])
        except KeyError:
            pass
        if len(words) > self.most:
            words.clear()
        tokenize, table = self.tokenizer.model.tokenize, self.bytes_as_letters
        for w in set(cut).difference(words):
            words[w] = self._bytes([t.id for t in tokenize(w.translate(table))])
        return b"".join([words[w] for w in cut])

    def encode(self, text: str | None) -> bytes:
        """Little-endian unsigned 32-bit ids."""
        if not text:
            return b""
        if self.SPECIAL not in text and self.PLAIN.fullmatch(text):
            return self._plain(text)
        out = []
        for part in re.split(r"([ \n]+)", text)[::2]:
            if self.SPECIAL not in part and self.PLAIN.fullmatch(part):
                out.append(self._plain(part))
            else:
                out.append(self._bytes(self.tokenizer.encode(part, add_special_tokens=False).ids))
        return b"".join(out)


_LOADED: dict[str, WordTokenizer] = {}


def tokenizer(path: str) -> WordTokenizer:
    """One per worker process."""
    if path not in _LOADED:
        _LOADED[path] = WordTokenizer(path)
    return _LOADED[path]


def cut_pieces(docs: DataFrame, path: str, window: int, end_id: int, doc_id: str, text: str, with_ids: bool) -> DataFrame:
    """(row, doc_id, start, length, ids_crc32, doc_tokens[, ids]): full windows of each document, then the rest."""
    schema = f"row long, doc_id {docs.schema[doc_id].dataType.simpleString()}, start long, length long, ids_crc32 long, doc_tokens long" + ", ids array<int>" * with_ids

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end = tokenizer(path).encode, np.array([end_id], "<u4").tobytes()
        for batch in batches:
            rows, at = batch.column(0).to_pylist(), batch.column(1)
            out: dict[str, list] = defaultdict(list)
            source = []
            for k, t in enumerate(batch.column(2).to_pylist()):
                ids = encode(t) + end
                n = len(ids) // 4
                for start in range(0, n, window):
                    piece = ids[4 * start : 4 * (start + window)]
                    source.append(k)
                    out["row"].append(rows[k])
                    out["start"].append(start)
                    out["length"].append(len(piece) // 4)
                    out["ids_crc32"].append(zlib.crc32(piece))
                    out["doc_tokens"].append(n)
                    if with_ids:
                        out["ids"].append(np.frombuffer(piece, "<i4"))
            arrays = {"row": pa.array(out["row"], pa.int64()), "doc_id": at.take(pa.array(source, pa.int64()))}
            arrays |= {c: pa.array(out[c], pa.int64()) for c in ("start", "length", "ids_crc32", "doc_tokens")}
            if with_ids:
                arrays["ids"] = pa.array(out["ids"], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_pydict(arrays)

    return docs.select(F.monotonically_increasing_id().alias("row"), doc_id, text).mapInArrow(cut, schema)


class OpenWindows:
    """How many windows are open at each remaining capacity, as a segment tree: the tightest fit is a walk down."""

    def __init__(self, window: int):
        self.size = 1 << window.bit_length()
        self.tree = [0] * (2 * self.size)

    def add(self, capacity: int, count: int) -> None:
        k = capacity + self.size
        while k:
            self.tree[k] += count
            k >>= 1

    def tightest(self, least: int) -> int | None:
        """The smallest capacity >= least with an open window."""
        k = least + self.size
        if self.tree[k]:
            return least
        while k > 1:
            if k % 2 == 0 and self.tree[k + 1]:
                k += 1
                while k < self.size:
                    k = 2 * k if self.tree[2 * k] else 2 * k + 1
                return k - self.size
            k >>= 1
        return None


def best_fit_plan(histogram: dict[int, int], window: int) -> list[tuple[int, int, int, int, int, int]]:
    """Runs (length, first rank, pieces, first window, pieces per window, offset) in the order BFD places them.

    Piece `first + i` of a length, i < pieces, goes to window `first window + i // per` at `offset + length * (i % per)`.
    A window that takes a piece becomes tighter, so it takes all that it can of one length before any other does:
    runs of equal windows are filled together.
    """
    tree, runs, plan, windows = OpenWindows(window), defaultdict(deque), [], 0
    for length in sorted(histogram, reverse=True):
        rank, left = 0, histogram[length]
        while left:
            room = tree.tightest(length)
            if room is None:
                room = window
                count = -(-left // (window // length))
                runs[room].append((windows, count))
                tree.add(room, count)
                windows += count
            first, count = runs[room].popleft()
            per = room // length
            full = min(count, left // per)
            if full:
                take, used = full * per, full
            else:
                take, used, per = left, 1, left
            plan.append((length, rank, take, first, per, window - room))
            tree.add(room, -count)
            for at, n, capacity in ((first, used, room - per * length), (first + used, count - used, room)):
                if n:
                    runs[capacity].appendleft((at, n)) if capacity == room else runs[capacity].append((at, n))
                    tree.add(capacity, n)
            rank, left = rank + take, left - take
    return plan


def ranked(pieces: DataFrame, salts: int, order: list) -> DataFrame:
    """Adds `_rank` within a length, from 0, without one window over all pieces of a length."""
    salted = pieces.withColumn("_salt", F.pmod(F.xxhash64("doc_id", "row", "start"), F.lit(salts)))
    counts = salted.groupBy("length", "_salt").agg(F.count("*").alias("_n"))
    ahead = Window.partitionBy("length").orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select("length", "_salt", F.coalesce(F.sum("_n").over(ahead), F.lit(0)).alias("_base"))
    inside = F.row_number().over(Window.partitionBy("length", "_salt").orderBy(*order)) - 1
    return salted.withColumn("_in", inside).join(bases, ["length", "_salt"]).withColumn("_rank", F.col("_base") + F.col("_in")).drop("_salt", "_in", "_base")


def pack(
    docs: DataFrame,
    tokenizer_path: str,
    window: int = 2048,
    end_id: int = 1,
    doc_id: str = "doc_id",
    text: str = "text",
    with_ids: bool = False,
) -> DataFrame:
    """row, doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset[, ids] - one row per piece."""
    pieces = written(cut_pieces(docs, tokenizer_path, window, end_id, doc_id, text, with_ids).withColumnRenamed(doc_id, "doc_id"), "pieces")
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}  # at most `window` rows
    plan = best_fit_plan(histogram, window)
    spark = docs.sparkSession
    # pieces of full windows need no rank within a plan run beyond their number; they are ranked like the others
    largest = max(histogram.values(), default=0)
    placed = ranked(pieces.drop("ids"), isqrt(largest) + 1, ["doc_id", "start", "row"])
    columns = ["_length", "_first", "_count", "_window", "_per", "_offset"]
    runs = spark.createDataFrame(pd.DataFrame(plan, columns=columns, dtype="int64"), ", ".join(f"{c} long" for c in columns))
    grouped = runs.groupBy("_length").agg(F.array_sort(F.collect_list(F.struct("_first", "_count", "_window", "_per", "_offset"))).alias("_runs"))
    run = F.filter("_runs", lambda r: (F.col("_rank") >= r["_first"]) & (F.col("_rank") < r["_first"] + r["_count"]))[0]
    out = placed.join(F.broadcast(grouped), F.col("length") == F.col("_length")).withColumn("_run", run)
    inside = F.col("_rank") - F.col("_run._first")
    out = out.select(
        "row", "doc_id", "start", "length", "ids_crc32", "doc_tokens",
        (F.col("_run._window") + F.floor(inside / F.col("_run._per"))).alias("sequence_id"),
        (F.col("_run._offset") + F.col("length") * (inside % F.col("_run._per"))).alias("offset"),
    )
    return out.join(pieces.select("row", "start", "ids"), ["row", "start"]) if with_ids else out
