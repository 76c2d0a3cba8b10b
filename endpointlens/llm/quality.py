"""Quality by compression: two zstandard dictionaries, one built from good and one from bad labelled text.

A text is cut into blocks of `block` bytes, and each block is compressed with either dictionary. The difference of
the compressed sizes, divided by the text's size (plus a constant that keeps very short texts near zero), is the
single feature; a logistic curve fitted on labelled rows that the dictionaries never saw turns it into a
probability.

The fit uses a bounded sample of labelled rows, the same at every size of the corpus: `sample` rows of each class, in
the order of a hash of their id, with their whole texts. Scoring is one pass over whole texts without a shuffle.

Defined results: null or empty text has difference 0 and gets the curve's value there. If labelled rows of a class
are missing, every text scores the share of good labels (0.5 without labels). Repeated ids are scored row by row.
Extra columns of any name are kept; `score` is replaced. Ids of any type do. A row of a null id is scored, but is never
learned from. A very long text is scored block by block; in the sample it takes driver memory in proportion.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LEVEL = 3
PADDING = 200


def blocks_of(text: str | None, block: int) -> list[bytes]:
    data = (text or "").encode("utf-8", "surrogatepass")
    return [data[k : k + block] for k in range(0, len(data), block)]


def compressor(dictionary: bytes) -> zstandard.ZstdCompressor:
    made = zstandard.ZstdCompressionDict(dictionary)
    made.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(level=LEVEL, dict_data=made, write_content_size=False, write_checksum=False, write_dict_id=False)


def difference(text: str | None, good: zstandard.ZstdCompressor, bad: zstandard.ZstdCompressor, block: int) -> float:
    """How many bytes per byte of text the good dictionary saves over the bad one."""
    parts = blocks_of(text, block)
    saved = sum(len(bad.compress(p)) - len(good.compress(p)) for p in parts)
    return saved / (sum(map(len, parts)) + PADDING)


def fit_curve(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1e-3) -> tuple[float, float]:
    """Weighted logistic regression of y on x by Newton steps: (slope, intercept)."""
    scale = max(float(np.abs(x).max(initial=0.0)), 1e-9)
    design, beta = np.stack([x / scale, np.ones_like(x)], 1), np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        gradient = design.T @ (weight * (y - p)) - ridge * beta
        hessian = (design * (weight * p * (1 - p))[:, None]).T @ design + ridge * np.eye(2)
        step = np.linalg.solve(hessian, gradient)
        beta = beta + np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-9:
            break
    return float(beta[0] / scale), float(beta[1])


def labelled_sample(labels: DataFrame, label: str, doc_id: str, sample: int, seed: int) -> DataFrame:
    """(doc_id, y, part) of at most `sample` rows of each class, in hash order; part 0..9 is a random tenth."""
    at = F.xxhash64(F.lit(seed), F.col(doc_id))
    rows = labels.select(F.col(doc_id).alias("_id"), F.col(label).cast("int").alias("y"), at.alias("_at")).where(F.col(doc_id).isNotNull())
    classes = [rows.where(F.col("y") == k).dropDuplicates(["_id"]).orderBy("_at", "_id").limit(sample) for k in (1, 0)]
    return classes[0].unionByName(classes[1]).select("_id", "y", F.pmod(F.xxhash64("_at"), F.lit(10)).cast("int").alias("part"), "_at")


class CompressionClassifier:
    """The fitted model: two dictionaries and a curve, a bounded number of bytes that tasks get by broadcast."""

    def __init__(self, good: bytes, bad: bytes, slope: float, intercept: float, block: int):
        self.good, self.bad, self.slope, self.intercept, self.block = good, bad, slope, intercept, block

    def differences(self, spark) -> Column:
        sent, block = spark.sparkContext.broadcast((self.good, self.bad)), self.block

        @F.pandas_udf("double")
        def saved(texts: pd.Series) -> pd.Series:
            good, bad = map(compressor, sent.value)
            return pd.Series([difference(t, good, bad, block) for t in texts], dtype="float64")

        return saved

    def score(self, docs: DataFrame, text: str = "text") -> DataFrame:
        if not self.good:
            return docs.withColumn("score", F.lit(1 / (1 + math.exp(-self.intercept))))
        logit = F.lit(self.slope) * self.differences(docs.sparkSession)(F.col(text)) + F.lit(self.intercept)
        return docs.withColumn("score", 1 / (1 + F.exp(-logit)))


def fit(
    docs: DataFrame,
    labels: DataFrame,
    label: str = "quality",
    doc_id: str = "doc_id",
    text: str = "text",
    sample: int = 3000,
    block: int = 1024,
    size: int = 1 << 18,
    seed: int = 11,
) -> CompressionClassifier:
    """Learn from the labelled rows given (doc_id, label in 0/1); label is null: the row is left out."""
    counts = {r["y"]: r["n"] for r in labels.groupBy(F.col(label).cast("int").alias("y")).agg(F.count("*").alias("n")).where("y in (0, 1)").collect()}
    share = (counts.get(1, 0) + 0.5) / (sum(counts.values()) + 1)
    nothing = CompressionClassifier(b"", b"", 0.0, math.log(share / (1 - share)), block)
    if len(counts) < 2:
        return nothing
    chosen = F.broadcast(labelled_sample(labels, label, doc_id, sample, seed))
    rows = docs.select(F.col(doc_id).alias("_id"), F.col(text).alias("_text")).join(chosen, "_id")

    whole = rows.where("part < 7").select("y", "_at", "_text").toPandas()  # at most 2 * sample rows
    dictionaries = []
    for y in (1, 0):
        texts = whole[whole["y"] == y].sort_values(["_at", "_text"], kind="stable")["_text"]
        own = [p for t in texts for p in blocks_of(t, block)]
        np.random.default_rng(seed).shuffle(own)
        try:
            dictionaries.append(zstandard.train_dictionary(min(size, sum(map(len, own))), own).as_bytes())
        except (zstandard.ZstdError, ValueError):  # too little text to find repeats in: the text itself is the dictionary
            dictionaries.append(b"".join(own)[-size:] or b"\0" * 8)
    model = CompressionClassifier(*dictionaries, 0.0, 0.0, block)
    seen = rows.where("part >= 7").select("y", model.differences(docs.sparkSession)("_text").alias("d")).toPandas()
    n1, n0 = int((seen["y"] == 1).sum()), int((seen["y"] == 0).sum())
    if not n1 or not n0:
        return nothing
    y = seen["y"].to_numpy(float)
    weight = np.where(y == 1, share / n1, (1 - share) / n0) * len(y)
    model.slope, model.intercept = fit_curve(seen["d"].to_numpy(float), y, weight)
    return model


def judge(docs: DataFrame, labels: DataFrame, label: str = "quality", doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """docs with `score`, the probability of label 1, learned from `labels`."""
    return fit(docs, labels, label, doc_id, text, **options).score(docs, text)
