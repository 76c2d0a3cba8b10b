"""Aggregates over probe results: counts, error histograms, latency statistics. Partial sums go before every shuffle."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.text import classify_error
from .ranks import BOUND, UP_TO_HERE, carried, largest, same

#: Points a failed probe costs, by reason; any other reason costs DEFAULT_WEIGHT.
WEIGHTS = {
    "nxdomain_spoofing": 50,
    "tls_name_mismatch": 40,
    "tls_error": 30,
    "doh_path_invalid": 25,
    "answer_mismatch": 25,
    "unexpected_nxdomain": 15,
    "unexpected_rcode": 10,
    "http_error": 10,
    "connect_error": 10,
    "timeout_or_error": 5,
    "error": 5,
}
DEFAULT_WEIGHT = 5
#: All reasons of failed probes.
REASONS = (*WEIGHTS, "unexpected_rcode_suspicious")


def failed_reason() -> Column:
    """Reason of a failed probe with an error text, else null."""
    return F.when(~F.col("ok") & (F.coalesce(F.col("error"), F.lit("")) != ""), classify_error(F.col("error")))


def weight_of(reason: Column) -> Column:
    table = F.create_map(*[F.lit(x) for pair in WEIGHTS.items() for x in pair])
    return F.when(reason.isNotNull(), F.coalesce(F.try_element_at(table, reason), F.lit(DEFAULT_WEIGHT))).otherwise(0)


POSITIONS = {
    "_low": lambda n: F.floor((n - 1) / 2),
    "_high": lambda n: F.floor(n / 2),
    "_p95": lambda n: F.least(F.floor(n * 95 / 100), n - 1),
}


def latency_quantiles(probes: DataFrame, keys: list[str], more: dict[str, Column] | None = None, slice_ms: float = 1 / 16, bound: int | None = None) -> DataFrame:
    """keys, p50_latency_ms (mean of the middle two), p95_latency_ms (number min(int(0.95 n), n - 1)), jitter_ms, latency_sample_count.

    Exact, over ok probes with a latency; keys without one have nulls and a count of 0. `more`: further aggregates of
    the probes. Where no key has more than `bound` probes (by default what one task orders), samples are numbered
    within their key and all is one aggregation. Else they are selected in two steps: counts in slices of `slice_ms`
    give the slices of the wanted positions and the samples before them, and only the samples of those slices - three
    at most for a key - are counted by value. No row holds the samples of a key.
    """
    more = {c: more[c].alias(c) for c in more or {}}
    positions = {k: F.max(F.when(holds(at(F.col("total"))), F.col("latency_ms"))).alias(k) for k, at in POSITIONS.items()}
    if largest(probes, keys) <= (BOUND if bound is None else bound):
        w, sample = Window.partitionBy(*keys), F.when(F.col("ok"), F.col("latency_ms"))
        numbered = probes.withColumn("latency_ms", sample).withColumns({"before": F.row_number().over(w.orderBy(F.asc_nulls_last("latency_ms"))) - 1, "_n": F.lit(1), "total": F.count("latency_ms").over(w)})
        found = numbered.groupBy(*keys).agg(F.max("total").alias("latency_sample_count"), *positions.values(), *more.values())
    else:
        good = probes.where(F.col("ok") & F.col("latency_ms").isNotNull()).select(*keys, "latency_ms")
        chosen = selected(good, keys, slice_ms).groupBy(*[F.col(c).alias(f"_of_{k}") for k, c in enumerate(keys)]).agg(F.max("total").alias("latency_sample_count"), *positions.values())
        base = probes.groupBy(*keys).agg(F.count("*").alias("_rows"), *more.values()).drop("_rows")
        found = base.join(chosen, same([F.col(c) for c in keys], [F.col(f"_of_{k}") for k in range(len(keys))]), "left")
    n = F.coalesce("latency_sample_count", F.lit(0)).cast("long")
    p50 = F.when(F.col("latency_sample_count") % 2 == 0, (F.col("_low") + F.col("_high")) / 2).otherwise(F.col("_high"))
    jitter = F.when(n > 0, F.greatest(F.lit(0.0), F.col("_p95") - p50))
    return found.select(*keys, *more, p50.alias("p50_latency_ms"), F.col("_p95").alias("p95_latency_ms"), jitter.alias("jitter_ms"), n.alias("latency_sample_count"))


def holds(position: Column) -> Column:
    """Whether a row of `_n` samples behind `before` others holds a position."""
    return (F.col("before") <= position) & (position < F.col("before") + F.col("_n"))


def selected(good: DataFrame, keys: list[str], slice_ms: float) -> DataFrame:
    """(keys, latency_ms, before, _n, total) of the samples in the slices of the wanted positions, counted by value."""
    slice_ = F.when(F.isnan("latency_ms"), F.lit(2**63 - 1)).otherwise(F.floor(F.col("latency_ms") / slice_ms)).cast("long")
    sliced = good.withColumn("_slice", slice_)
    counted = carried(sliced.groupBy(*keys, "_slice").agg(F.count("*").alias("_n")), keys, "_slice", "_n")
    names = [*keys, "_slice"]
    some = reduce(Column.__or__, [holds(at(F.col("total"))) for at in POSITIONS.values()])
    wanted = counted.where(some).select(*[F.col(c).alias(f"_of_{k}") for k, c in enumerate(names)], F.col("before").alias("_base"), "total")
    met = sliced.join(wanted, same([F.col(c) for c in names], [F.col(f"_of_{k}") for k in range(len(names))]))
    values = met.groupBy(*names, "latency_ms").agg(F.count("*").alias("_n"), F.first("_base").alias("_base"), F.first("total").alias("total"))
    inside = Window.partitionBy(*names).orderBy("latency_ms").rowsBetween(*UP_TO_HERE)
    return values.withColumn("before", F.col("_base") + F.coalesce(F.sum("_n").over(inside), F.lit(0)))


def latency_stats(probes: DataFrame, keys: list[str], bound: int | None = None) -> DataFrame:
    """keys, p50_latency_ms, p95_latency_ms, jitter_ms, latency_sample_count of every key."""
    return latency_quantiles(probes, keys, bound=bound)


def error_histogram(probes: DataFrame, keys: list[str]) -> DataFrame:
    """keys, reason, n, penalty."""
    counted = probes.withColumn("reason", failed_reason()).where("reason is not null").groupBy(*keys, "reason").agg(F.count("*").alias("n"))
    return counted.withColumn("penalty", (weight_of(F.col("reason")) * F.col("n")).cast("long"))


def probe_counts(probes: DataFrame, keys: list[str]) -> DataFrame:
    """keys, ok_count, failed_count, total."""
    return probes.groupBy(*keys).agg(F.count_if("ok").alias("ok_count"), F.count_if(~F.col("ok")).alias("failed_count"), F.count("*").alias("total"))


def availability_points(ok: Column, total: Column) -> Column:
    """20 for 99 % and more, one point less per 5 % from 95 % to 50 %, below in proportion. Integer arithmetic."""
    steps = [(99, 20), (95, 19), (90, 18), (85, 17), (80, 16), (75, 15), (70, 14), (65, 13), (60, 12), (55, 11), (50, 10)]
    out = F.when(total == 0, 0)
    for share, points in steps:
        out = out.when(100 * ok >= share * total, points)
    return out.otherwise(F.expr("0") + F.floor(20 * ok / total)).cast("int")


def endpoint_metrics(probes: DataFrame, keys: list[str], bound: int | None = None) -> DataFrame:
    """All that scoring needs of the probes of an endpoint. Reasons are in order of the first probe that gave them.

    The reasons are a fixed list, so the first probe of each is an aggregate of its own and no list is gathered.
    """
    marked = probes.withColumn("_reason", failed_reason())
    reason, error = F.col("_reason"), F.coalesce(F.col("error"), F.lit(""))
    firsts = F.array(*[F.struct(F.min(F.when(reason == r, F.col("seq"))).alias("first"), F.lit(r).alias("reason")) for r in REASONS])
    more = {
        "total": F.count("*"), "ok_count": F.count_if("ok"), "penalty": F.coalesce(F.sum(weight_of(reason)), F.lit(0)).cast("long"),
        "timeouts": F.count_if(~F.col("ok") & error.contains("timeout")),
        "error_reasons": F.transform(F.array_sort(F.filter(firsts, lambda x: x["first"].isNotNull())), lambda x: x["reason"]),
    }
    return latency_quantiles(marked, keys, more, bound=bound)
