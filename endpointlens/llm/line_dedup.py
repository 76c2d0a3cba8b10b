"""Reversible line deduplication: exact reference-count tables behind sharded cuckoo filters.

A line's key is the line stripped of ASCII white space at both ends with A-Z lower-cased, held as two independent
64-bit hashes. The reference table has one row per key: how many documents hold it and the smallest id among them.
Keys that two or more documents hold are also in the cuckoo filter of their shard. A filter answers "surely not
shared" without a look at the table, so only lines that may be shared go on to the exact join, which alone decides.
Lines travel to the filter of their shard; no filter is sent to all tasks. A cuckoo filter can forget: when documents are deleted, keys held by fewer than two documents are taken
out again, and later decisions are those of a corpus that never had the deleted documents.

Hot lines are counted by partial aggregates (one row per task and key) and joined with a unique side, which Spark
may split; nothing gathers the lines of one key.

Defined results: null or empty text is one empty line; lines with keys under `least` code points always stay.
Repeated rows with one id are one document: they never make a line shared, and each row keeps its lines. A row of a
null id shares no line and keeps all. An empty table gives an empty table. A long text takes memory in proportion.
Extra columns of any name are kept; only `n_lines`, `n_dropped` and `kept_text` are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, shared_dir, written

STRIP = " \t\n\x0b\x0c\r"
SLOTS = 4


class CuckooFilter:
    """Buckets of four 16-bit fingerprints; a key has two buckets, each found from the other and the fingerprint.

    Inserting places whole arrays at once while slots are free and moves fingerprints one by one after that.
    A filter that can't place a key doubles its buckets, so an inserted key is always found.
    """

    def __init__(self, keys: int = 0, table: np.ndarray | None = None):
        self.table = np.zeros((self._buckets(keys), SLOTS), np.uint16) if table is None else table

    @staticmethod
    def _buckets(keys: int) -> int:
        return 1 << max(2, int(np.ceil(np.log2(max(1, keys) / (SLOTS * 0.85)))))

    @staticmethod
    def _mix(x: np.ndarray) -> np.ndarray:
        x = x.astype(np.uint64)
        x ^= x >> np.uint64(31)
        x *= np.uint64(0x9E3779B97F4A7C15)
        return x ^ (x >> np.uint64(29))

    def places(self, h1: np.ndarray, h2: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(fingerprint, first bucket, second bucket); h1 also chose the shard, so buckets come from h2."""
        mask = np.uint64(len(self.table) - 1)
        tag = ((self._mix(h1.view(np.uint64)) >> np.uint64(40)) & np.uint64(0xFFFF)).astype(np.uint16)
        tag[tag == 0] = 1
        one = self._mix(h2.view(np.uint64)) & mask
        return tag, one.astype(np.int64), self.other(one, tag)

    def other(self, bucket: np.ndarray, tag: np.ndarray) -> np.ndarray:
        mask = np.uint64(len(self.table) - 1)
        return ((np.asarray(bucket, np.uint64) ^ self._mix(np.asarray(tag, np.uint64))) & mask).astype(np.int64)

    def contains(self, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        tag, one, two = self.places(h1, h2)
        return (self.table[one] == tag[:, None]).any(1) | (self.table[two] == tag[:, None]).any(1)

    def _place(self, h1: np.ndarray, h2: np.ndarray) -> bool:
        tag, one, two = self.places(h1, h2)
        left = np.arange(len(tag))
        for bucket in (one, two) * SLOTS:  # each round gives every bucket one newcomer at most
            if not len(left):
                return True
            at = bucket[left]
            free = self.table[at] == 0
            _, first = np.unique(at, return_index=True)
            first = first[free[first].any(1)]
            self.table[at[first], free[first].argmax(1)] = tag[left[first]]
            left = np.delete(left, first)
        rng = np.random.default_rng(len(tag))
        for i in left:
            t, b = tag[i], int(two[i])
            for _ in range(500):
                row = self.table[b]
                empty = np.flatnonzero(row == 0)
                if len(empty):
                    row[empty[0]] = t
                    break
                k = int(rng.integers(SLOTS))
                t, row[k] = row[k], t
                b = int(self.other(np.array([b]), np.array([t]))[0])
            else:
                return False
        return True

    def delete(self, h1: np.ndarray, h2: np.ndarray) -> None:
        """Keys that were inserted; one copy of each fingerprint goes."""
        for t, a, b in zip(*self.places(h1, h2)):
            for bucket in (a, b):
                hit = np.flatnonzero(self.table[bucket] == t)
                if len(hit):
                    self.table[bucket, hit[0]] = 0
                    break

    @classmethod
    def of(cls, h1: np.ndarray, h2: np.ndarray) -> "CuckooFilter":
        size = len(h1)
        while True:
            made = cls(size)
            if made._place(h1, h2):
                return made
            size = 2 * size + 8

    def dump(self) -> bytes:
        return self.table.tobytes()

    @classmethod
    def load(cls, blob: bytes) -> "CuckooFilter":
        return cls(table=np.frombuffer(blob, np.uint16).reshape(-1, SLOTS).copy())


def line_keys(text: Column) -> Column:
    """Array of the keys of all lines of a text."""
    return F.transform(
        F.split(F.coalesce(text, F.lit("")), "\n", -1),
        lambda line: F.regexp_replace(ascii_lower(line), r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$", ""),
    )


def own_keys(text: str, least: int) -> tuple[list[str], list[int]]:
    """The lines of a text and, for each, the place of its key among the text's distinct keys (-1: too short).

    The same order as array_distinct over line_keys gives; bytes.lower() touches A-Z alone.
    """
    lines, seen, places = text.split("\n"), {}, []
    for line in lines:
        key = line.strip(STRIP)
        places.append(seen.setdefault(key.encode().lower(), len(seen)) if len(key) >= least else -1)
    return lines, places


def holders(docs: DataFrame, least: int, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(h1, h2, doc_id, text_hash, k): the distinct keys of each row of docs; k is a key's place among them."""
    keys = F.array_distinct(F.filter(line_keys(F.col(text)), lambda k: F.char_length(k) >= least))
    return docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(text).alias("text_hash"), F.posexplode(keys).alias("k", "_key")).select(
        F.xxhash64("_key").alias("h1"), F.xxhash64(F.lit(1), "_key").alias("h2"), "doc_id", "text_hash", "k"
    )


def references(held: DataFrame) -> DataFrame:
    """The exact table: (h1, h2, n_docs, first_doc, last_doc). A key is shared when two different ids hold it."""
    return held.groupBy("h1", "h2").agg(
        F.count("*").alias("n_docs"), F.min("doc_id").alias("first_doc"), F.max("doc_id").alias("last_doc")
    )


SHARED = "first_doc < last_doc"


def build_filters(refs: DataFrame, shards: int) -> DataFrame:
    """(shard, blob): a cuckoo filter of the shared keys of each shard. Keys are distinct, so shards are even."""

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        made = CuckooFilter.of(pdf["h1"].to_numpy(np.int64), pdf["h2"].to_numpy(np.int64))
        return pd.DataFrame({"shard": pdf["shard"].iloc[:1], "blob": [made.dump()]})

    shared = refs.where(SHARED).select(F.pmod("h1", F.lit(shards)).alias("shard"), "h1", "h2")
    return shared.groupBy("shard").applyInPandas(build, "shard long, blob binary")


def maybe_shared(lines: DataFrame, filters: DataFrame, shards: int, lines_a_task: int) -> DataFrame:
    """Rows of lines (h1, h2, ...) whose key may be shared: all that are, and about one in 8000 of the others.

    Lines go to the filter of their shard, whatever the filters' size: rows of (shard, slice) are sorted behind the
    shard's filter, so a task holds one filter at a time and streams the lines. A shard of many lines, as that of a hot
    line, is cut into slices of about `lines_a_task`, each with its own copy of the filter.
    """
    of = F.pmod("h1", F.lit(shards)).alias("shard")
    sizes = lines.groupBy(of).agg(F.ceil(F.count("*") / lines_a_task).cast("int").alias("slices"))
    sizes = written(sizes, "shard-sizes")  # a row per shard, of half a million keys each
    names = lines.columns
    cut = lines.select(of, "*").join(F.broadcast(sizes) if shards <= 100_000 else sizes, "shard")
    cut = cut.select("shard", F.pmod(F.xxhash64("doc_id", "text_hash", "k"), F.col("slices")).cast("int").alias("slice"), F.lit(1).alias("kind"), F.lit(None).cast("binary").alias("blob"), *names)
    sent = filters.join(sizes, "shard").select(
        "shard", F.explode(F.sequence(F.lit(0), F.col("slices") - 1)).alias("slice"), F.lit(0).alias("kind"), "blob", *[F.lit(None).cast(lines.schema[c].dataType).alias(c) for c in names]
    )
    together = cut.unionByName(sent).repartition("shard", "slice").sortWithinPartitions("shard", "slice", "kind")

    def test(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, of = None, None
        for b in batches:
            shard, part, kind = (np.asarray(b.column(k)) for k in range(3))
            keep = np.zeros(b.num_rows, bool)
            starts = np.flatnonzero((kind == 0) | (np.diff(shard, prepend=shard[:1]) != 0) | (np.diff(part, prepend=part[:1]) != 0))
            for a, z in zip([0, *starts], [*starts, b.num_rows]):
                if z > a:
                    if kind[a] == 0:
                        held, of = CuckooFilter.load(b.column(3)[int(a)].as_py()), (shard[a], part[a])
                        a += 1
                    if of == (shard[z - 1], part[z - 1]) and z > a:  # a shard without a filter has no shared key
                        keep[a:z] = held.contains(b.column(4).slice(a, z - a).to_numpy(), b.column(5).slice(a, z - a).to_numpy())
            yield pa.RecordBatch.from_arrays(b.columns[4:], names=names).filter(pa.array(keep))

    return together.mapInArrow(test, lines.schema)


def dropped_keys(held: DataFrame, refs: DataFrame, filters: DataFrame, shards: int, lines_a_task: int) -> DataFrame:
    """(doc_id, text_hash, drops): the places of the keys that a document loses to a smaller id."""
    likely = maybe_shared(held, filters, shards, lines_a_task)
    shared = refs.where(SHARED).select("h1", "h2", "first_doc")
    lost = likely.join(shared, ["h1", "h2"]).where(F.col("doc_id") > F.col("first_doc"))
    return lost.groupBy("doc_id", "text_hash").agg(F.collect_set("k").alias("drops"))


def rebuilt(text: pd.Series, drops: pd.Series, least: int) -> pd.DataFrame:
    """(n_dropped, kept) of texts without the lines whose key's place is in drops; null for null."""
    n, kept = [], []
    for t, d in zip(text, drops):
        if d is None:
            n.append(0)
            kept.append(None)
            continue
        lines, places = own_keys(t, least)
        gone = set(d)
        stay = [line for line, k in zip(lines, places) if k not in gone]
        n.append(len(lines) - len(stay))
        kept.append("\n".join(stay))
    return pd.DataFrame({"n_dropped": n, "kept": pd.Series(kept, dtype=object)})


def apply_drops(docs: DataFrame, drops: DataFrame, least: int, doc_id: str, text: str) -> DataFrame:
    """docs with n_lines, n_dropped and kept_text; only texts that lose lines pass through Python."""

    @F.pandas_udf("struct<n_dropped:long,kept:string>")
    def rebuild(texts: pd.Series, gone: pd.Series) -> pd.DataFrame:
        return rebuilt(texts, gone, least)

    own_row = F.struct(*[c for c in docs.columns if c not in ("n_lines", "n_dropped", "kept_text")]).alias("row")
    keyed = docs.select(own_row, F.col(doc_id).alias("doc_id"), F.xxhash64(text).alias("text_hash"), F.coalesce(F.col(text), F.lit("")).alias("own"))
    out = keyed.join(drops, ["doc_id", "text_hash"], "left")
    out = out.withColumn("new", rebuild(F.when(F.col("drops").isNotNull(), F.col("own")), "drops"))
    return out.select(
        "row.*",
        F.size(F.split("own", "\n", -1)).cast("long").alias("n_lines"),
        F.coalesce("new.n_dropped", F.lit(0)).cast("long").alias("n_dropped"),
        F.coalesce("new.kept", "own").alias("kept_text"),
    )


def dedup_lines(
    docs: DataFrame, least: int = 10, doc_id: str = "doc_id", text: str = "text", keys_a_shard: int = 500_000, lines_a_task: int = 4_000_000
) -> DataFrame:
    """docs with n_lines, n_dropped and kept_text, every line shared by several documents kept in the smallest id.

    An index over docs is built and asked at once; LineIndex keeps it for later batches.
    """
    held = written(holders(docs, least, doc_id, text), "lines")
    refs = written(references(held).where(SHARED), "line-refs")
    shards = max(1, -(-refs.count() // keys_a_shard))
    filters = written(build_filters(refs, shards), "line-filters")
    return apply_drops(docs, dropped_keys(held, refs, filters, shards, lines_a_task), least, doc_id, text)


class LineIndex:
    """An index of lines that documents can be put into and taken out of again.

    State: `held` (which document holds which key), `refs` (the exact counts) and `filters` (a cuckoo filter of the
    shared keys per shard), each written anew to the shared folder by a change; a failed job leaves the old state.
    Only keys that a batch touches are counted again, and only they enter or leave the filters.
    """

    def __init__(self, spark, shards: int = 16, least: int = 10, lines_a_task: int = 4_000_000):
        shared_dir(spark)
        self.spark, self.shards, self.least, self.lines_a_task = spark, shards, least, lines_a_task
        self.held = self.refs = self.filters = None

    def insert(self, docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> None:
        """Add documents; an id that the index holds already is refused. What is held is only added to."""
        new = written(holders(docs, self.least, doc_id, text), "held-new")
        if self.held is not None and not new.join(self.held, "doc_id", "left_semi").isEmpty():
            raise ValueError("ids are in the index already; delete them first")
        self._change(new if self.held is None else self.held.unionByName(new), new.select("h1", "h2").distinct())

    def delete(self, ids: DataFrame, doc_id: str = "doc_id") -> None:
        """Take documents out; ids that the index doesn't hold change nothing."""
        if self.held is None:
            return
        gone = ids.select(F.col(doc_id).alias("doc_id")).distinct()
        touched = self.held.join(gone, "doc_id", "left_semi").select("h1", "h2").distinct()
        self._change(written(self.held.join(gone, "doc_id", "left_anti"), "held"), touched)

    def decide(self, docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
        """What docs, all of them in the index, keep at its present state."""
        drops = dropped_keys(holders(docs, self.least, doc_id, text), self.refs, self.filters, self.shards, self.lines_a_task)
        return apply_drops(docs, drops, self.least, doc_id, text)

    def _change(self, held: DataFrame, touched: DataFrame) -> None:
        touched = written(touched, "touched")
        fresh = references(held.join(touched, ["h1", "h2"], "left_semi"))
        if self.refs is None:
            refs = written(fresh, "refs")
            filters = build_filters(refs, self.shards)
        else:
            refs = written(self.refs.join(touched, ["h1", "h2"], "left_anti").unionByName(fresh), "refs")
            was = self.refs.where(SHARED).select("h1", "h2", F.lit(1).alias("was"))
            now = refs.where(SHARED).select("h1", "h2", F.lit(1).alias("now"))
            moves = touched.join(was, ["h1", "h2"], "left").join(now, ["h1", "h2"], "left").where("(was is null) <> (now is null)")
            filters = self._moved(moves, refs)
        self.filters = written(filters, "filters")
        self.held, self.refs = held, refs

    def _moved(self, moves: DataFrame, refs: DataFrame) -> DataFrame:
        """Filters with keys put in (now shared) and taken out (no longer); a full one is built again from refs."""
        shards = self.shards

        def change(old: pd.DataFrame, keys: pd.DataFrame) -> pd.DataFrame:
            shard = (old if len(old) else keys)["shard"].iloc[:1].reset_index(drop=True)
            table = CuckooFilter.load(old["blob"].iloc[0]) if len(old) else CuckooFilter(len(keys))
            out, put = keys[keys["now"].isna()], keys[keys["now"].notna()]
            table.delete(out["h1"].to_numpy(np.int64), out["h2"].to_numpy(np.int64))
            full = not table._place(put["h1"].to_numpy(np.int64), put["h2"].to_numpy(np.int64))
            return pd.DataFrame({"shard": shard, "blob": [None if full else table.dump()]})

        keyed = moves.withColumn("shard", F.pmod("h1", F.lit(shards)))
        changed = written(
            self.filters.groupBy("shard").cogroup(keyed.groupBy("shard")).applyInPandas(change, "shard long, blob binary"), "filters-new"
        )
        again = changed.where("blob is null").select("shard")
        rebuilt = build_filters(refs.withColumn("shard", F.pmod("h1", F.lit(shards))).join(again, "shard", "left_semi"), shards)
        return changed.where("blob is not null").unionByName(rebuilt)
