"""Quality and confidence of an endpoint from its metrics: one projection, no shuffle after the joins.

Integer arithmetic stands in for truncated products (int(raw * 0.5) and the like), so results are exact.
History is optional: without it the history part is 0 and its caps don't apply.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import has_hard_fail
from .metrics import availability_points, endpoint_metrics

#: Fixed values: (limit, points) tiers, the first that fits counts.
P50_TIERS = [(1500, 30), (700, 18), (300, 8), (100, 3)]
P95_TIERS = [(2500, 20), (1500, 12), (800, 6), (400, 2)]
JITTER_TIERS = [(900, 12), (400, 6), (150, 2)]
RELIABILITY_TIERS = [(0.55, 15), (0.70, 10), (0.85, 5), (0.95, 2)]
HISTORY_CAPS = [(3, 90), (7, 95), (14, 98)]
HISTORY = ["runs_seen_7d", "runs_seen_30d", "success_days_7d", "success_days_30d", "consecutive_success_days", "consecutive_fail_days", "status_flaps_30d"]


def first_tier(value: Column, tiers: list, above: bool = True) -> Column:
    out = None
    for limit, points in tiers:
        fits = value > limit if above else value < limit
        out = F.when(fits, points) if out is None else out.when(fits, points)
    return out.otherwise(0)


def steps(value: Column, table: list, otherwise: int = 0) -> Column:
    """Points of the first step whose limit the value reaches."""
    out = None
    for limit, points in table:
        out = F.when(value >= limit, points) if out is None else out.when(value >= limit, points)
    return out.otherwise(otherwise)


def ratio_steps(part: Column, whole: Column, table: list) -> Column:
    """As steps, for part / whole in per cent, without division."""
    out = F.when(whole <= 0, 0)
    for per_cent, points in table:
        out = out.when(100 * part >= per_cent * whole, points)
    return out.otherwise(0)


def timeout_penalty() -> Column:
    often = F.col("timeouts") * 2 > F.col("total")
    return F.when(often, F.floor(20 * F.col("timeouts") / F.col("total"))).otherwise(0).cast("long")


def correctness_raw() -> Column:
    return F.when(F.col("total") == 0, 0).otherwise(F.greatest(F.lit(0), 100 - F.col("penalty") - timeout_penalty())).cast("int")


def performance_raw() -> Column:
    worst = first_tier(F.col("p50_latency_ms"), P50_TIERS) + first_tier(F.col("p95_latency_ms"), P95_TIERS) + first_tier(F.col("jitter_ms"), JITTER_TIERS)
    return F.when(F.col("latency_sample_count") == 0, 0).otherwise(100 - worst).cast("int")


def history_points() -> Column:
    seen = F.col("runs_seen_30d")
    flaps, fails = F.col("status_flaps_30d"), F.col("consecutive_fail_days")
    total = (
        steps(seen, [(14, 4), (7, 2), (3, 1)])
        + ratio_steps(F.col("success_days_30d"), seen, [(95, 3), (85, 2), (70, 1)])
        + ratio_steps(F.col("success_days_7d"), F.col("runs_seen_7d"), [(95, 2), (80, 1)])
        + F.when(F.col("consecutive_success_days") >= 14, 1).otherwise(0)
        - steps(flaps, [(5, 4), (3, 2)])
        - steps(fails, [(3, 3), (1, 1)])
    )
    return F.when(seen.isNull(), 0).otherwise(F.greatest(F.lit(0), total)).cast("int")


def reliability() -> Column:
    """The source's reliability as a number; null if missing or not a number in text."""
    return F.col("reliability").cast("string").try_cast("double")


def confidence() -> Column:
    rel = reliability()
    known = F.when(F.isnan(rel), 5).otherwise(steps(rel, [(0.95, 15), (0.85, 12), (0.70, 8)], 5))
    history = F.when(F.col("runs_seen_30d").isNull(), 0).otherwise(steps(F.col("runs_seen_30d"), [(21, 35), (14, 30), (7, 20), (3, 10)], 5))
    total = steps(F.col("total"), [(20, 30), (10, 25), (5, 15), (3, 10)], 5) + steps(F.col("latency_sample_count"), [(15, 20), (8, 15), (4, 10), (1, 5)])
    return F.least(F.lit(100), total + history + F.when(rel.isNull(), 5).otherwise(known)).cast("int")


def reliability_penalty() -> Column:
    rel = reliability()
    return F.when(rel.isNull() | F.isnan(rel), 0).otherwise(first_tier(rel, RELIABILITY_TIERS, above=False))


def history_cap(score: Column) -> Column:
    out = F.when(F.col("runs_seen_30d").isNull(), score)
    for runs, most in HISTORY_CAPS:
        out = out.when(F.col("runs_seen_30d") < runs, F.least(score, F.lit(most)))
    return out.otherwise(score)


def perfect_gate() -> Column:
    """The note of the first rule that keeps a score below 100, null if none does."""
    seen = F.col("runs_seen_30d")
    return (
        F.when((F.col("penalty") + timeout_penalty() > 0) | (F.size("error_reasons") > 0), "correctness_issues")
        .when(performance_raw() < 100, "performance_not_perfect")
        .when(seen.isNull(), F.lit(None).cast("string"))
        .when(seen < 14, F.concat(F.lit("insufficient_history_for_100:"), seen.cast("string"), F.lit("_runs")))
        .when(F.col("status_flaps_30d") > 2, F.concat(F.lit("too_much_flapping:"), F.col("status_flaps_30d").cast("string"), F.lit("_flaps")))
        .when(F.col("consecutive_fail_days") > 0, "recent_failures")
        .when(F.col("ok_count") < F.col("total"), "imperfect_availability")
        .when(F.col("confidence_score") < 90, "low_confidence")
    )


def reasons() -> Column:
    """Reasons in the order in which scoring finds them."""
    p50 = F.when(F.col("p50_latency_ms") > 1500, "latency_very_high").when(F.col("p50_latency_ms") > 700, "latency_high").when(F.col("p50_latency_ms") > 100, "latency_moderate")
    found = F.array(
        F.when(F.col("timeouts") * 2 > F.col("total"), "timeout_rate_high"),
        F.when(F.col("latency_sample_count") == 0, "no_latency_samples"),
        p50,
        F.when(F.col("p95_latency_ms") > 1500, "latency_p95_high"),
        F.when(F.col("jitter_ms") > 400, "latency_jitter_high"),
        F.when(F.col("status_flaps_30d") >= 5, "high_flapping").when(F.col("status_flaps_30d") >= 3, "moderate_flapping"),
        F.when(F.col("consecutive_fail_days") >= 3, "recent_failure_streak"),
        F.when(reliability() < 0.55, "reliability_low"),
        F.when(F.col("transport") == "dns-udp", "udp_only"),
    )
    none = F.when(F.col("total") == 0, F.array(F.lit("no_probes"))).otherwise(F.array().cast("array<string>"))
    return F.array_distinct(F.array_compact(F.concat(none, F.col("error_reasons"), found)))


def score(metrics: DataFrame, history: DataFrame | None = None, on: list[str] | None = None, accept_min: int = 80, candidate_min: int = 60) -> DataFrame:
    """metrics (endpoint_metrics, and columns transport and reliability if known) with the parts, score, status and notes.

    history: stability metrics joined on `on`; endpoints without a row have none.
    """
    df = metrics
    for name, kind in (("transport", "string"), ("reliability", "string")):
        if name not in df.columns:
            df = df.withColumn(name, F.lit(None).cast(kind))
    if history is not None:
        df = df.join(history.select(*on, *HISTORY), on, "left")
    else:
        df = df.withColumns({c: F.lit(None).cast("long") for c in HISTORY})
    parts = {
        "correctness_score": F.floor(correctness_raw() / 2).cast("int"),
        "availability_score": availability_points(F.col("ok_count"), F.col("total")),
        "performance_score": F.floor(performance_raw() / 5).cast("int"),
        "history_score": history_points(),
        "confidence_score": confidence(),
        "reasons": reasons(),
    }
    df = df.withColumns(parts)
    whole = F.col("correctness_score") + F.col("availability_score") + F.col("performance_score") + F.col("history_score")
    df = df.withColumn("_penal", F.greatest(F.lit(0), whole - reliability_penalty()))
    df = df.withColumns({"_capped": history_cap(F.col("_penal")), "_hard": has_hard_fail(F.col("reasons"))})
    df = df.withColumn("_gate", F.when(F.col("_capped") >= 100, perfect_gate()))
    df = df.withColumn("_open", F.when(F.col("_gate").isNotNull(), 99).otherwise(F.least(F.col("_capped"), F.lit(100))))
    final = F.when(F.col("_hard") & (F.col("_open") > 59), 59).otherwise(F.col("_open")).cast("int")
    bite = F.when(F.col("_capped") < F.col("_penal"), F.concat(F.lit("insufficient_history:"), F.col("runs_seen_30d").cast("string"), F.lit("_runs")))
    notes = F.array_compact(
        F.array(F.when(reliability().isNull() & F.col("reliability").isNull(), "source_reliability_unknown"), bite, F.col("_gate"), F.when(F.col("_hard") & (F.col("_open") > 59), "hard_fail_cap"))
    )
    df = df.withColumns({"score": final, "score_caps_applied": notes})
    status = F.when(~F.col("_hard") & (F.col("score") >= accept_min), "accepted").when(~F.col("_hard") & (F.col("score") >= candidate_min), "candidate").otherwise("rejected")
    return df.withColumns({"status": status, "accepted": status == "accepted"}).drop("_penal", "_capped", "_hard", "_gate", "_open")


def score_probes(probes: DataFrame, keys: list[str], history: DataFrame | None = None, **limits) -> DataFrame:
    return score(endpoint_metrics(probes, keys), history, keys, **limits)
