"""Mixing sources to target weights by a low-discrepancy schedule of equal-token blocks.

The mix is a sequence of slots. Slot i gets the golden-ratio point frac(i * phi); mapped through the cumulative
target weights it names the slot's source, so that every stretch of the mix is close to the weights. The r-th slot
of a source takes block r of its shuffled documents, cut into blocks of equally many tokens; after the last block
a second pass begins. The slot that would exceed the source's target is trimmed to it.

All ranks are in two levels (a salt, then the rows of one salt; a chunk of slots, then the slots of one chunk), with
as many salts as rows in a salt, so a source with any share of the rows is spread over tasks: a window sees the root
of the rows at most. Beside that, one row per source meets in one task.

Defined results: null text counts as size 0 and takes nothing; null is a source of its own, ordered last. Empty
tables give empty tables. Repeated ids are separate rows of the stream. Equal shuffle hashes are ordered by id.
"""

from __future__ import annotations

from math import isqrt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import WORD, checkpointed

GOLDEN = 0.6180339887498949


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, cycle: tuple[int, ...], share: float, limit: float) -> DataFrame:
    """One row per source of `sizes` (source, source_size, docs): its weight, cap and target, lossless in total.

    Sources in code-point order, null last, take the weights of `cycle` in turn. Targets are share * (all sizes) by
    weight; a target stops at limit * size and the rest is shared anew. That process ends at target =
    min(cap, level * weight), and the level is found in one sorted pass over the sources: a source is capped
    exactly when cap / weight is at most the level of what the sources before it leave over.
    """
    order = Window.orderBy(F.col("source").isNull(), "source")
    weights = F.array(*[F.lit(float(w)) for w in cycle])
    ranked = sizes.withColumn("_k", F.row_number().over(order) - 1).withColumns(
        {"weight": F.element_at(weights, (F.col("_k") % len(cycle) + 1).cast("int")), "cap": limit * F.col("source_size")}
    )
    by_cap = Window.orderBy(F.col("cap") / F.col("weight"), "_k")
    before, after = by_cap.rowsBetween(Window.unboundedPreceding, -1), by_cap.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy()
    level = (share * F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("weight").over(after)
    leveled = ranked.withColumn("_level", level)
    # the level that holds is the one found at the first source that isn't capped
    first = F.min(F.when(F.col("cap") > F.col("_level") * F.col("weight"), F.struct(F.col("cap") / F.col("weight"), "_k", "_level"))).over(everything)
    target = F.when(first.isNull(), F.col("cap")).otherwise(F.least("cap", first["_level"] * F.col("weight")))
    return leveled.withColumn("target", target).drop("_level", "_k", "cap")


def stream_positions(docs: DataFrame, doc_id: str, seed: int, salts: int) -> DataFrame:
    """Adds `_start`: where a document begins in its source's shuffled stream of words.

    docs has doc_id, source, size, _row. The order is (salt, hash): a window over (source, salt) is one slice of
    it, and slices are put together by a window over their sums.
    """
    key = F.xxhash64(F.lit(seed), F.col(doc_id))
    salted = docs.withColumns({"_h": key, "_salt": F.pmod(F.shiftrightunsigned(key, 20), F.lit(salts))})
    slices = salted.groupBy("source", "_salt").agg(F.sum("size").alias("_sum"))
    ahead = Window.partitionBy("source").orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)
    slices = slices.select(F.col("source").alias("_src"), "_salt", F.coalesce(F.sum("_sum").over(ahead), F.lit(0)).alias("_base"))
    inside = Window.partitionBy("source", "_salt").orderBy("_h", doc_id, "size", "_row").rowsBetween(Window.unboundedPreceding, -1)
    placed = salted.withColumn("_in", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    joined = placed.join(slices.withColumnRenamed("_salt", "_salt2"), F.col("source").eqNullSafe(F.col("_src")) & (F.col("_salt") == F.col("_salt2")))
    return joined.withColumn("_start", F.col("_base") + F.col("_in")).drop("_h", "_salt", "_salt2", "_src", "_in", "_base")


def schedule(targets: DataFrame, block: int, least_chunk: int = 512) -> DataFrame:
    """Slots (slot, source, pass, block, take): which block of which source the mix takes, in mix order.

    targets: one row per source with source_size and target. Points are drawn until they suffice on average, and
    a source that the points leave short of its target gets its last slots at the end. Ranks within a source: a
    rank within each chunk of consecutive slots plus the counts of the chunks before it.
    """
    spark = targets.sparkSession
    wanted = targets.where(F.col("source_size") > 0).withColumn("_want", F.round("target").cast("long")).where("_want > 0")
    blocks = F.ceil(F.col("source_size") / block)
    whole, rest = F.floor(F.col("_want") / F.col("source_size")), F.col("_want") % F.col("source_size")
    wanted = wanted.withColumns({"_blocks": blocks, "_need": (whole * blocks + F.ceil(rest / block)).cast("long")})
    w = Window.orderBy(F.col("source").isNull(), "source")
    everything = Window.partitionBy()
    wanted = wanted.withColumns(
        {
            "_hi": F.sum("_need").over(w.rowsBetween(Window.unboundedPreceding, 0)) / F.sum("_need").over(everything),
            "_lo": F.coalesce(F.sum("_need").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) / F.sum("_need").over(everything),
            "_sid": F.row_number().over(w),
        }
    )
    wanted = checkpointed(wanted)
    total = wanted.agg(F.sum("_need").alias("n"), F.max("_sid").alias("k")).first()
    n = total.n or 0
    chunk = max(least_chunk, isqrt(n))
    # the interval of each source is cut at a grid finer than the sources, so that points find it by an equi-join
    grid = 4 * max(total.k or 0, 256)
    intervals = wanted.where("_hi > _lo").select(
        "_sid", "_lo", "_hi", F.explode(F.sequence(F.floor(F.col("_lo") * grid), F.least(F.floor(F.col("_hi") * grid), F.lit(grid - 1)))).alias("_cell")
    )
    points = spark.range(0, n, 1, max(1, min(4096, -(-n // (256 * chunk))))).withColumnRenamed("id", "slot")
    u = F.col("slot") * GOLDEN - F.floor(F.col("slot") * GOLDEN)
    drawn = (
        points.withColumn("_u", u).withColumn("_cell", F.floor(F.col("_u") * grid)).join(intervals, "_cell")
        .where((F.col("_u") >= F.col("_lo")) & (F.col("_u") < F.col("_hi")))
        .select("slot", "_sid", F.floor(F.col("slot") / chunk).alias("_chunk"))
    )
    counts = drawn.groupBy("_sid", "_chunk").agg(F.count("*").alias("_c"))
    ahead = Window.partitionBy("_sid").orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("_before", F.coalesce(F.sum("_c").over(ahead), F.lit(0)))
    rank = F.row_number().over(Window.partitionBy("_sid", "_chunk").orderBy("slot")) - 1
    ranked = drawn.withColumn("_r", rank).join(counts.select("_sid", "_chunk", "_before"), ["_sid", "_chunk"]).select("slot", "_sid", (F.col("_before") + F.col("_r")).alias("_rank"))
    got = counts.groupBy("_sid").agg(F.sum("_c").alias("_got"))
    short = (
        wanted.join(got, "_sid", "left").withColumn("_got", F.coalesce("_got", F.lit(0))).where(F.col("_got") < F.col("_need"))
        .select("_sid", F.explode(F.sequence("_got", F.col("_need") - 1)).alias("_rank"))
        .select((F.lit(n) + F.col("_rank")).alias("slot"), "_sid", "_rank")
    )
    slots = ranked.unionByName(short).join(_small(wanted.select("_sid", "source", "source_size", "_want", "_need", "_blocks"), total.k or 0), "_sid")
    slots = slots.where(F.col("_rank") < F.col("_need")).withColumns({"pass": F.floor(F.col("_rank") / F.col("_blocks")), "block": F.col("_rank") % F.col("_blocks")})
    left = F.least(F.lit(block), F.col("source_size") - F.col("block") * block, F.col("_want") - F.col("pass") * F.col("source_size") - F.col("block") * block)
    return slots.select("slot", "_sid", "source", "pass", "block", left.cast("long").alias("take"))


def _small(sources: DataFrame, rows: int, most: int = 50_000) -> DataFrame:
    """A table with a row per source: broadcast while its counted rows are few, else left to a shuffled join."""
    return F.broadcast(sources) if rows <= most else sources


def mix(
    docs: DataFrame,
    cycle: tuple[int, ...] = (3, 1, 2),
    share: float = 1.5,
    limit: float = 2.0,
    block: int = 2048,
    seed: int = 17,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    row: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(decisions, pieces). row: a column that numbers the rows; without one they are numbered here.

    decisions: _row, doc_id, source, size, source_size, target, taken - one row per document.
    pieces: slot, _row, doc_id, source, size, pass, first, last - the words [first, last) of a document that a slot of the mix takes.
    """
    number = F.col(row) if row else F.monotonically_increasing_id()
    sized = checkpointed(docs.select(number.alias("_row"), F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), word_count(F.col(text)).alias("size")))
    sizes = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("docs"))
    targets = checkpointed(source_targets(sizes, cycle, share, limit))
    n, k = targets.agg(F.coalesce(F.sum("docs"), F.lit(0)), F.count("*")).first()
    placed = stream_positions(sized.where("size > 0"), "doc_id", seed, isqrt(n) + 1)
    slots = schedule(targets, block)
    first, last = F.floor(F.col("_start") / block), F.floor((F.col("_start") + F.col("size") - 1) / block)
    cut = placed.select("_row", "doc_id", "source", "size", "_start", F.explode(F.sequence(first, last)).alias("block"))
    on = cut.alias("c").join(slots.alias("s"), F.col("c.source").eqNullSafe(F.col("s.source")) & (F.col("c.block") == F.col("s.block")))
    lo = F.greatest(F.col("_start") - F.col("c.block") * block, F.lit(0))
    hi = F.least(F.col("_start") + F.col("size") - F.col("c.block") * block, F.lit(block), F.col("take"))
    pieces = on.where(hi > lo).select(
        "slot", "_row", "doc_id", F.col("c.source").alias("source"), "size", "pass",
        (F.col("c.block") * block + lo - F.col("_start")).alias("first"), (F.col("c.block") * block + hi - F.col("_start")).alias("last"),
    )
    taken = pieces.groupBy("_row").agg(F.sum(F.col("last") - F.col("first")).alias("taken"))
    decisions = (
        sized.join(taken, "_row", "left")
        .join(_small(targets.select(F.col("source").alias("_src"), "source_size", "target"), k), F.col("source").eqNullSafe(F.col("_src")), "left")
        .select("_row", "doc_id", "source", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))
    )
    return decisions, pieces
