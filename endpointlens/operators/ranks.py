"""Ranks and running sums within a key that no single task has to sort.

A slice is a number that never falls along the order: a hundred thousand sequence numbers, a hundredth of a
millisecond. The rows of a slice are ordered in one task, the slices of a key are added up first and carried on as one
row each. So a key that most rows share is spread over as many tasks as it has slices. Nulls are keys of their own.

Where no key has more than BOUND rows - one count of the keys tells - a window per key gives the same numbers with
one shuffle.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

UP_TO_HERE = (Window.unboundedPreceding, -1)
#: Most rows of a key that one task orders.
BOUND = 100_000


def largest(df: DataFrame, keys: list[str]) -> int:
    """How many rows the commonest key has."""
    return df.groupBy(*keys).agg(F.count("*").alias("_n")).agg(F.max("_n")).first()[0] or 0


def same(left: list[Column], right: list[Column]) -> Column:
    """Equality of all pairs, nulls being equal."""
    return reduce(Column.__and__, [a.eqNullSafe(b) for a, b in zip(left, right)])


def slices(order: Column, width: int = 100_000) -> Column:
    """Slices of a numeric order."""
    return F.floor(order / width)


def carried(totals: DataFrame, keys: list[str], slice_: str, amount: str) -> DataFrame:
    """totals (keys, slice, amount), a row each, with `before` and `total` of the amounts of the key."""
    w = Window.partitionBy(*keys)
    ahead = F.coalesce(F.sum(amount).over(w.orderBy(slice_).rowsBetween(*UP_TO_HERE)), F.lit(0))
    return totals.withColumns({"before": ahead, "total": F.sum(amount).over(w)})


def ahead(df: DataFrame, keys: list[str], order: list, slice_: Column, amount: Column | None = None, bound: int | None = None, most: int | None = None) -> DataFrame:
    """df with `before`: the sum of the amount over the rows of its key that come earlier in the order, by default their number.

    most: the rows of the commonest key, if the caller knows them.
    """
    one = F.lit(1) if amount is None else amount
    if (largest(df, keys) if most is None else most) <= (BOUND if bound is None else bound):
        w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(*UP_TO_HERE)
        return df.withColumn("before", F.coalesce(F.sum(one.cast("long")).over(w), F.lit(0)))
    sliced = df.withColumns({"_slice": slice_, "_amount": one.cast("long")})
    sums = carried(sliced.groupBy(*keys, "_slice").agg(F.sum("_amount").alias("_sum")), keys, "_slice", "_sum")
    names = [*keys, "_slice"]
    base = sums.select(*[F.col(c).alias(f"_of_{k}") for k, c in enumerate(names)], F.col("before").alias("_base"))
    inside = Window.partitionBy(*names).orderBy(*order).rowsBetween(*UP_TO_HERE)
    placed = sliced.withColumn("_inside", F.coalesce(F.sum("_amount").over(inside), F.lit(0)))
    met = placed.join(base, same([F.col(c) for c in names], [F.col(f"_of_{k}") for k in range(len(names))]))
    return met.withColumn("before", F.col("_base") + F.col("_inside")).drop("_slice", "_amount", "_inside", "_base", *[f"_of_{k}" for k in range(len(names))])
