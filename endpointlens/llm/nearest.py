"""Nearest neighbours with randomly rotated one-bit codes.

A vector is centred, normalised and rotated by a random orthogonal matrix; the signs are its code, packed to one bit
a dimension, with two correction scalars: the vector's length and the inner product of the code with the direction
it stands for. From these a task estimates the inner product of a query with every vector, and a bound of the
estimate's error: sqrt((1 - f^2) / (f^2 (D - 1))) times `width`. Vectors whose distance can't be above the k-th best
found so far, by that bound, are reranked with the original vectors in double precision.

Centre and rotation come from a bounded sample (documented by `sample`) and a seed; every vector is coded. Queries
are sent in blocks of bounded size; each block is compared with all codes, one pass over the index. A task keeps k
rows for a query, so nothing gathers the rows of a key.

Defined results: vectors that are null, all zero, of another length than most, or hold null or non-finite components
take no part, as queries or as candidates. Equal distances are ordered by id; a query never finds its own id.
Fewer than k candidates: all of them. No vectors: no rows. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import written


def usable(vectors: DataFrame, vec_id: str, embedding: str) -> tuple[DataFrame, int]:
    """(vec_id, v) of the vectors that take part, and their length."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    good = vectors.select(F.col(vec_id).alias("vec_id"), F.col(embedding).alias("v")).where(
        F.col("vec_id").isNotNull() & F.col("v").isNotNull() & F.forall("v", finite) & F.exists("v", lambda x: x != 0)
    )
    common = good.groupBy(F.size("v").alias("d")).agg(F.count("*").alias("n")).orderBy(F.col("n").desc(), "d").first()
    dim = common["d"] if common else 0
    return good.where(F.size("v") == dim), dim


def rows_of(column: pa.Array, dim: int, kind: type) -> np.ndarray:
    flat = column.flatten() if isinstance(column, (pa.ListArray, pa.LargeListArray)) else column
    return np.asarray(flat, kind).reshape(-1, dim)


class OneBitCodes:
    """Centre and rotation; makes codes and estimates distances from them."""

    def __init__(self, centre: np.ndarray, seed: int = 3, width: float = 1.9):
        self.centre, self.dim, self.width = centre.astype(np.float64), len(centre), width
        q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((self.dim, self.dim)))
        self.rotation = q * np.sign(np.diag(r))

    def turned(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rotated unit directions from the centre, and lengths."""
        moved = vectors.astype(np.float64) - self.centre
        length = np.sqrt((moved**2).sum(1))
        return (moved / np.maximum(length, 1e-300)[:, None]) @ self.rotation, length

    def encode(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(packed bits, length, code . direction)."""
        turned, length = self.turned(vectors)
        return np.packbits(turned > 0, axis=1), length, np.abs(turned).sum(1) / np.sqrt(self.dim)

    def lower_bounds(self, bits: np.ndarray, length: np.ndarray, fit: np.ndarray, turned: np.ndarray, query_length: np.ndarray) -> np.ndarray:
        """Squared distances (vectors x queries) that the true ones are above, but for the bound's rare failures."""
        signs = np.unpackbits(bits, axis=1, count=self.dim).astype(np.float32) * 2 - 1
        fit = np.maximum(fit, 1e-6)[:, None]
        estimate = (signs @ turned.T.astype(np.float32)) / (np.sqrt(self.dim) * fit)
        error = self.width * np.sqrt(np.maximum(1 - fit**2, 0) / (fit**2 * max(1, self.dim - 1)))
        inner = np.minimum(estimate + error, 1)
        return (length**2)[:, None] + (query_length**2)[None, :] - 2 * np.outer(length, query_length) * inner


def build_index(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", sample: int = 4096, seed: int = 3) -> tuple[DataFrame, OneBitCodes | None]:
    """(vec_id, v, code, length, fit) of every usable vector, written to the shared folder, and the coder."""
    good, dim = usable(vectors, vec_id, embedding)
    if not dim:
        return good.limit(0), None
    drawn = good.orderBy(F.xxhash64(F.lit(seed), "vec_id"), "vec_id").limit(sample).select("v").toPandas()
    coder = OneBitCodes(np.stack(drawn["v"].to_numpy()).astype(np.float64).mean(0), seed)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            bits, length, fit = coder.encode(rows_of(b.column(1), dim, np.float64))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array([x.tobytes() for x in bits], pa.binary()), pa.array(length), pa.array(fit)],
                names=["vec_id", "v", "code", "length", "fit"],
            )

    kind = good.schema["v"].dataType.simpleString()
    return written(good.mapInArrow(encode, f"vec_id long, v {kind}, code binary, length double, fit double"), "codes"), coder


def search_block(index: DataFrame, coder: OneBitCodes, ids: np.ndarray, queries: np.ndarray, k: int) -> DataFrame:
    """(query_id, vec_id, score): k nearest of each query within each task of the index."""
    turned, query_length = coder.turned(queries)
    sent = index.sparkSession.sparkContext.broadcast((coder, ids, queries.astype(np.float64), turned, query_length))
    dim = coder.dim

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, ids, queries, turned, query_length = sent.value
        best = [(np.empty(0), np.empty(0, np.int64)) for _ in ids]
        limit = np.full(len(ids), np.inf)

        def merge(q: int, rows: np.ndarray, at: np.ndarray, vectors: np.ndarray) -> None:
            near = np.append(best[q][0], ((vectors[rows] - queries[q]) ** 2).sum(1))
            who = np.append(best[q][1], at[rows])
            order = np.lexsort((who, near))[:k]
            best[q] = near[order], who[order]
            if len(order) == k:
                limit[q] = near[order[-1]]

        for b in batches:
            at, vectors = np.asarray(b.column(0), np.int64), rows_of(b.column(1), dim, np.float64)
            bits = np.frombuffer(b"".join(b.column(2).to_pylist()), np.uint8).reshape(len(at), -1)
            low = coder.lower_bounds(bits, np.asarray(b.column(3)), np.asarray(b.column(4)), turned, query_length)
            slack = 1e-9 + 1e-6 * np.abs(low)
            for q in range(len(ids)):
                bound = low[:, q] - slack[:, q]
                rows = np.flatnonzero((bound <= limit[q]) & (at != ids[q]))
                if len(rows) > 4 * k:  # the likeliest first: they lower the limit for the rest
                    rows = rows[np.argsort(bound[rows], kind="stable")]
                    merge(q, rows[: 4 * k], at, vectors)
                    rows = rows[4 * k :]
                    rows = rows[bound[rows] <= limit[q]]
                if len(rows):
                    merge(q, rows, at, vectors)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.repeat(ids, [len(b[1]) for b in best])),
                pa.array(np.concatenate([b[1] for b in best]) if len(best) else np.empty(0, np.int64)),
                pa.array(np.sqrt(np.concatenate([b[0] for b in best])) if len(best) else np.empty(0)),
            ],
            names=["query_id", "vec_id", "score"],
        )

    return index.select("vec_id", "v", "code", "length", "fit").mapInArrow(scan, "query_id long, vec_id long, score double")


def nearest(
    vectors: DataFrame, queries: DataFrame, k: int = 10, vec_id: str = "vec_id", embedding: str = "embedding", block: int = 2000, sample: int = 4096
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest of each row of queries among all rows of vectors.

    Queries go in blocks of about `block` rows, chosen by a hash of the id; the number of blocks grows with them.
    """
    index, coder = build_index(vectors, vec_id, embedding, sample)
    spark = vectors.sparkSession
    if coder is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    asked = written(usable(queries, vec_id, embedding)[0].where(F.size("v") == coder.dim).dropDuplicates(["vec_id"]), "queries")
    blocks = max(1, -(-asked.count() // block))
    found = None
    for j in range(blocks):
        own = asked.where(F.pmod(F.xxhash64("vec_id"), F.lit(blocks)) == j).toPandas().sort_values("vec_id")  # about `block` rows
        if len(own):
            part = search_block(index, coder, own["vec_id"].to_numpy(np.int64), np.stack(own["v"].to_numpy()), k)
            found = part if found is None else found.unionByName(part)
        if found is not None and j % 8 == 7:
            found = written(found, "found")
    if found is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
