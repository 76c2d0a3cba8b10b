"""Importance resampling of documents towards a target distribution, by hashed n-grams.

Features are runs of 1 to `longest` consecutive words. A text's UTF-8 bytes pass one 256-byte table that lower-cases
A-Z and blanks every separator, bytes.split gives the words, and the checksum of a run is that of the run one word
shorter, used as the seed of the next word's, so no run is ever put together as text. Buckets are checksums modulo
their number; a Counter per task adds them up, and Spark adds up the tasks' rows, at most `buckets` each.

A bucket's gain is the scaled log ratio of its share in the target to its share in the documents, a document's weight
the sum of its features' gains. Its score adds a Gumbel number drawn from the hash of its id, so the highest scores
are a draw without replacement in proportion to the weights. Ranks come from one range shuffle of (score, id) and the
row counts of its partitions; no task sees all rows.

Texts are worked through in pieces of `step` bytes cut at a separator, with the last words carried over, so a very
long text takes little more memory than it has itself.

Defined results: null or empty text has no features, weight 0 and no rank unless it has `least` words. Equal scores
are ordered by id, nulls first, then by features; equal rows are drawn like any others. A null id is hashed as empty
text. Without target texts, or without documents, the counts are 0 and the smoothed gains still defined. An empty
table gives an empty table. Only the id and text are read, so other columns can't clash.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import written

#: Digits, small letters and all bytes of other scripts are parts of words; capitals become small; the rest separates.
TABLE = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))


def word_pieces(text: str, step: int) -> Iterator[list[bytes]]:
    """The words of a text, a list for each piece of about `step` bytes."""
    raw = text.encode().translate(TABLE)
    at = 0
    while at < len(raw):
        end = raw.find(b" ", at + step)
        end = len(raw) if end < 0 else end
        yield raw[at:end].split()
        at = end


def run_buckets(text: str | None, longest: int, buckets: int, step: int = 1 << 20) -> Iterator[tuple[int, np.ndarray]]:
    """(words, buckets of the runs that end in them) of each piece."""
    carried: list[bytes] = []
    for words in word_pieces(text or "", step):
        old, words = len(carried), carried + words
        tails = [b" " + w for w in words]
        sums = list(map(crc32, words))
        found = sums[old:]
        for k in range(1, longest):
            sums = list(map(crc32, tails[k:], sums))
            found += sums[max(0, old - k) :]
        yield len(words) - old, np.array(found, np.int64) % buckets
        carried = words[max(0, len(words) - longest + 1) :] if longest > 1 else []


def bucket_counts(texts: DataFrame, text: str, longest: int, buckets: int) -> np.ndarray:
    """How many features of all texts fall into each bucket; `buckets` numbers reach the driver."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[int] = Counter()
        for batch in batches:
            for t in batch.column(0):
                for _, found in run_buckets(t.as_py(), longest, buckets):
                    counts.update(found.tolist())
        yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.int64()), pa.array(list(counts.values()), pa.int64())], names=["bucket", "n"])

    summed = texts.select(F.col(text).cast("string").alias("text")).mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    totals = np.zeros(buckets, np.int64)
    for r in summed.collect():
        totals[r["bucket"]] = r["n"]
    return totals


def gains(documents: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln(share in the target / share in the documents)) of each bucket, shares smoothed by one."""
    n, s_all, t_all = len(documents), int(documents.sum()), int(target.sum())
    ratio = lambda s, t: float((t + 1) * (s_all + n)) / float((s + 1) * (t_all + n))
    return np.array([math.floor(1000 * math.log(ratio(s, t))) for s, t in zip(documents.tolist(), target.tolist())], np.int64)


def weights(docs: DataFrame, gain: np.ndarray, doc_id: str, text: str, longest: int) -> DataFrame:
    """(doc_id, n_features, n_words, weight) of each document."""
    given = docs.sparkSession.sparkContext.broadcast(gain)

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gain = given.value
        for batch in batches:
            out: list[tuple[int, int, int]] = []
            for t in batch.column(1):
                features = words = weight = 0
                for n, found in run_buckets(t.as_py(), longest, len(gain)):
                    words, features, weight = words + n, features + len(found), weight + int(gain[found].sum())
                out.append((features, words, weight))
            columns = [pa.array([r[k] for r in out], pa.int64()) for k in range(3)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=["doc_id", "n_features", "n_words", "weight"])

    schema = f"doc_id {docs.schema[doc_id].dataType.simpleString()}, n_features long, n_words long, weight long"
    return docs.select(F.col(doc_id), F.col(text).cast("string")).mapInArrow(weigh, schema)


def gumbel(doc_id: Column, seed: int) -> Column:
    """floor(-1000 ln(-ln u)) of the u that the id's hash stands for."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"), 256)
    u = (F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") + 0.5) / 4294967296.0
    return F.floor(-1000 * F.log(-F.log(u))).cast("long")


def ranked(rows: DataFrame, order: list[Column], drawn: int) -> DataFrame:
    """rows with `rank`: 1 to `drawn` in this order, null behind it."""
    placed = written(rows.orderBy(*order).withColumn("_at", F.monotonically_increasing_id()), "ranked")
    part = F.shiftright("_at", 33)
    before = F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    #: a row for each partition of the range shuffle
    counts = placed.groupBy(part.alias("part")).agg(F.count("*").alias("n")).select("part", before.alias("before"))
    rank = F.col("before") + F.col("_at").bitwiseAND((1 << 33) - 1) + 1
    numbered = placed.join(F.broadcast(counts), part == F.col("part"))
    return numbered.withColumn("rank", F.when(rank <= drawn, rank)).drop("_at", "part", "before")


def resample(
    docs: DataFrame, target: DataFrame, doc_id: str = "doc_id", text: str = "text", target_text: str = "text",
    longest: int = 3, buckets: int = 10_000, least: int = 20, percent: int = 5, seed: int = 42,
) -> DataFrame:
    """(doc_id, n_features, weight, score, rank) of every document; `percent` of those with `least` words are drawn."""
    gain = gains(bucket_counts(docs, text, longest, buckets), bucket_counts(target, target_text, longest, buckets))
    weighed = weights(docs, gain, doc_id, text, longest)
    scored = written(weighed.withColumn("score", F.col("weight") + gumbel(F.col("doc_id"), seed)), "weights")
    takes_part = scored.where(F.col("n_words") >= least)
    found = ranked(takes_part, [F.desc("score"), F.asc("doc_id"), F.asc("n_features")], percent * takes_part.count() // 100)
    rest = scored.where(F.col("n_words") < least).withColumn("rank", F.lit(None).cast("long"))
    return found.unionByName(rest).select("doc_id", "n_features", "weight", "score", "rank")


def drawn_documents(docs: DataFrame, decisions: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """The drawn documents with all their columns; ids must be unique."""
    return docs.join(decisions.where("rank IS NOT NULL").select(F.col("doc_id").alias(doc_id)), doc_id, "left_semi")
