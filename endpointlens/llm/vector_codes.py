"""Codes of vectors: one small number per part of a vector, from codebooks learned by Lloyd's rounds.

Every component becomes the integer floor(scale * x) and every vector is cut into `parts` equal consecutive parts.
Each part position has a codebook of its own. The parts live at owners: an owner is (position, entry, salt) and holds
the parts that are nearest to that entry. In a round the owners add up their resident members, the sums of an entry's
owners become its new value, and the owners hold their members against the new codebook. Only members whose nearest
entry has changed are sent to another owner; all others stay in the partition they are in, since the union of the
residents with the newcomers is between equally partitioned data and shuffles nothing.

Only the codebooks reach the driver: `parts` x `entries` rows, whatever the input. The salt spreads the members of an
entry over as many owners as it takes to have about `resident` members in each if they all chose that entry, so one
frequent vector is no hot owner. Lost executors are made up for by lineage down to a written table of whole rows.

Defined results: rows of a null vector, or of one that holds null or non-finite components, are dropped, and so are
vectors of another length than most have (ties: the longer). That length must be a multiple of `parts`. Repeated ids
are rows of their own; the first codebook takes them by id, then content, nulls last; with fewer rows than entries
the codebooks are shorter. Entries that no part is nearest to stay as they are. Components are exact up to 2^28 in
size, larger ones raise. Null labels are one label. An empty table gives an empty table. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written

#: Members of an owner: their row numbers and their parts, a row of the matrix each.
Block = tuple[np.ndarray, np.ndarray]
LARGEST = 2**28


def whole_rows(vectors: DataFrame, vec_id: str, vector: str, label: str, scale: int) -> DataFrame:
    """(row, vec_id, label, whole): the rows that take part, with integer components."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    v = F.col(vector).cast("array<double>")
    kept = vectors.where(v.isNotNull() & F.forall(v, finite))
    whole = F.transform(v, lambda x: F.floor(x * scale).cast("long"))
    rows = written(kept.select(F.monotonically_increasing_id().alias("row"), F.col(vec_id).alias("vec_id"), F.col(label).alias("label"), whole.alias("whole")), "vectors")
    lengths = rows.groupBy(F.size("whole").alias("n")).agg(F.count("*").alias("rows"), F.max(F.array_max(F.transform("whole", F.abs))).alias("most"))
    usual = lengths.orderBy(F.desc("rows"), F.desc("n")).first()
    if usual and (usual["most"] or 0) > LARGEST:
        raise ValueError(f"components of more than 2^28 / {scale} can't be coded exactly")
    return rows.where(F.size("whole") == (usual["n"] if usual else 0))


def nearest(parts: np.ndarray, book: np.ndarray, step: int = 8192) -> tuple[np.ndarray, np.ndarray]:
    """(entry, squared distance) of each part; the lower entry of ties."""
    chosen, error = np.empty(len(parts), np.int64), np.empty(len(parts), np.int64)
    for k in range(0, len(parts), step):
        d = np.square(parts[k : k + step, None, :] - book[None]).sum(2)
        chosen[k : k + step] = d.argmin(1)
        error[k : k + step] = d.min(1)
    return chosen, error


def owners(rows: np.ndarray, position: int, entries: np.ndarray, most: int, salts: int) -> np.ndarray:
    """The owner's number of each member; a row keeps its salt."""
    mixed = (rows.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(20)
    return (position * most + entries) * salts + (mixed % np.uint64(salts)).astype(np.int64)


def home(owner: int) -> int:
    """Which partition an owner is in, modulo their number."""
    return (owner * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF) >> 24


def split(block: Block, owner: np.ndarray) -> Iterator[tuple[int, Block]]:
    order = np.argsort(owner, kind="stable")
    rows, parts, owner = block[0][order], block[1][order], owner[order]
    edges = [0, *(np.flatnonzero(np.diff(owner)) + 1), len(owner)]
    for a, b in zip(edges, edges[1:]):
        if a < b:
            yield int(owner[a]), (rows[a:b], parts[a:b])


def gathered(blocks: Iterator[tuple[int, Block]]) -> Iterator[tuple[int, Block]]:
    """One block an owner: what stayed and what came."""
    held = defaultdict(list)
    for owner, block in blocks:
        held[owner].append(block)
    for owner, found in held.items():
        yield owner, (np.concatenate([b[0] for b in found]), np.concatenate([b[1] for b in found]))


class Codebooks:
    """The books of all positions and the rule that numbers owners; small, sent to every task."""

    def __init__(self, books: np.ndarray, salts: int):
        self.books, self.salts = books, salts

    @property
    def most(self) -> int:
        return self.books.shape[1]

    def place(self, owner: int) -> tuple[int, int]:
        """(position, entry) of an owner."""
        return divmod(owner // self.salts, self.most)

    def first(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Cuts whole rows and sends each part to the owner of its nearest entry."""
        for batch in batches:
            rows = batch.column(0).to_numpy()
            values = batch.column(1).flatten().to_numpy().reshape(len(rows), self.books.shape[0], -1)
            found = []
            for position in range(len(self.books)):
                parts = np.ascontiguousarray(values[:, position])
                entries, _ = nearest(parts, self.books[position])
                found += split((rows, parts), owners(rows, position, entries, self.most, self.salts))
            yield pa.RecordBatch.from_arrays(
                [pa.array([o for o, _ in found], pa.int64()), pa.array([b[0].tobytes() for _, b in found], pa.binary()), pa.array([b[1].tobytes() for _, b in found], pa.binary())],
                names=["owner", "rows", "parts"],
            )

    def sums(self, blocks: Iterator[tuple[int, Block]]) -> Iterator[tuple[tuple[int, int], np.ndarray]]:
        """Per (position, entry) of this task: count, then the sum of each component."""
        held: dict[tuple[int, int], np.ndarray] = {}
        for owner, (rows, parts) in blocks:
            at = self.place(owner)
            held[at] = held.get(at, 0) + np.concatenate([[len(rows)], parts.sum(0)])
        return iter(held.items())

    def updated(self, totals: list[tuple[tuple[int, int], np.ndarray]]) -> Codebooks:
        books = self.books.copy()
        for at, total in totals:
            books[at] = total[1:] // total[0]
        return Codebooks(books, self.salts)

    def sorted_out(self, blocks: Iterator[tuple[int, Block]], moving: bool) -> Iterator[tuple[int, Block]]:
        """The members that leave their owner under these books, by new owner; or those that stay."""
        for owner, (rows, parts) in blocks:
            position, entry = self.place(owner)
            entries, _ = nearest(parts, self.books[position])
            chosen = (entries != entry) if moving else (entries == entry)
            if chosen.any():
                block = rows[chosen], parts[chosen]
                if moving:
                    yield from split(block, owners(block[0], position, entries[chosen], self.most, self.salts))
                else:
                    yield owner, block

    def coded(self, blocks: Iterator[tuple[int, Block]]) -> Iterator[tuple[bytes, int, bytes, bytes]]:
        for owner, (rows, parts) in blocks:
            position, _ = self.place(owner)
            entries, error = nearest(parts, self.books[position])
            yield rows.tobytes(), position, entries.tobytes(), error.tobytes()


def expanded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    whole = lambda b: pa.array(np.frombuffer(b, np.int64))
    for batch in batches:
        for r in batch.to_pylist():
            rows = whole(r["rows"])
            yield pa.RecordBatch.from_arrays([rows, pa.array([r["position"]] * len(rows), pa.int32()), whole(r["entries"]), whole(r["error"])], names=["row", "position", "entry", "error"])


def compress(
    vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label", parts: int = 8, entries: int = 16, rounds: int = 6, scale: int = 4096, resident: int = 512
) -> tuple[DataFrame, np.ndarray]:
    """(rows, codebooks): vec_id, label, code (two hex digits a part) and error of each vector; an array (position, entry, component)."""
    spark = vectors.sparkSession
    sc = spark.sparkContext
    rows = whole_rows(vectors, vec_id, vector, label, scale)
    starters = [r["whole"] for r in rows.orderBy(F.col("vec_id").asc_nulls_last(), "whole").limit(entries).collect()]
    shape = rows.select("vec_id", "label", F.lit("").alias("code"), F.lit(0).cast("long").alias("error"))
    if not starters:
        return shape.limit(0), np.empty((parts, 0, 0), np.int64)
    if not starters[0] or len(starters[0]) % parts:
        raise ValueError(f"vectors of {len(starters[0])} components have no {parts} equal parts")
    n = rows.count()
    books = Codebooks(np.array(starters, np.int64).reshape(len(starters), parts, -1).transpose(1, 0, 2).copy(), -(-n // resident))
    n_parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-n * parts // 500_000))

    given = sc.broadcast(books)
    cut = rows.select("row", "whole").mapInArrow(lambda batches: given.value.first(batches), "owner long, rows binary, parts binary")
    width = books.books.shape[2]
    sent = cut.rdd.map(lambda r: (r[0], (np.frombuffer(r[1], np.int64), np.frombuffer(r[2], np.int64).reshape(-1, width))))
    residents, left = held(sent.partitionBy(n_parts, home)), None
    for k in range(rounds):
        totals = residents.mapPartitions(lambda blocks, b=given: b.value.sums(blocks)).reduceByKey(np.add).collect()
        if left:
            left.unpersist()
        books = books.updated(totals)
        given = sc.broadcast(books)
        if k < rounds - 1:
            stay = residents.mapPartitions(lambda blocks, b=given: b.value.sorted_out(blocks, False), preservesPartitioning=True)
            move = residents.mapPartitions(lambda blocks, b=given: b.value.sorted_out(blocks, True))
            left, residents = residents, held(stay.union(move.partitionBy(stay.getNumPartitions(), home)))
    coded = spark.createDataFrame(residents.mapPartitions(lambda blocks, b=given: b.value.coded(blocks)), "rows binary, position int, entries binary, error binary")
    of_parts = coded.mapInArrow(expanded, "row long, position int, entry long, error long")
    digits = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("position", "entry"))), lambda x: F.lower(F.lpad(F.hex(x["entry"]), 2, "0"))), "")
    codes = written(of_parts.groupBy("row").agg(digits.alias("code"), F.sum("error").alias("error")), "codes")
    residents.unpersist()
    return rows.select("row", "vec_id", "label").join(codes, "row").select("vec_id", "label", "code", "error"), books.books


def held(sent: RDD) -> RDD:
    """One block an owner, kept by the executors; what a lost one held is computed again."""
    return sent.mapPartitions(gathered, preservesPartitioning=True).persist(StorageLevel.MEMORY_AND_DISK)


def with_label_errors(coded: DataFrame) -> DataFrame:
    """Adds the errors summed over the rows of equal label."""
    sums = coded.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error"))
    return coded.join(sums, F.col("label").eqNullSafe(F.col("of"))).drop("of")


def digest(books: np.ndarray) -> str:
    """sha256 of all entries' components as decimal text."""
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()
