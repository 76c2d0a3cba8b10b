"""Reports over scored results and daily history."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Lower limits of the score bands, highest first.
BANDS = [(100, "100"), (95, "95-99"), (85, "85-94"), (70, "70-84"), (None, "<70")]
WIDE_BANDS = [(95, "95-100"), (85, "85-94"), (70, "70-84"), (None, "0-69")]


def band_of(score: Column, bands: list = BANDS) -> Column:
    out = None
    for limit, name in bands[:-1]:
        out = F.when(score >= limit, name) if out is None else out.when(score >= limit, name)
    return out.otherwise(bands[-1][1])


def _names(df: DataFrame, bands: list) -> DataFrame:
    return df.sparkSession.createDataFrame([(b[1],) for b in bands], "band string")


def score_histogram(results: DataFrame) -> DataFrame:
    return results.groupBy("score").agg(F.count("*").alias("n"))


def score_bands(results: DataFrame) -> DataFrame:
    """(band, n, accepted, candidate, rejected) for every band, zero-filled."""
    n = {s: F.count_if(F.col("status") == s).alias(s) for s in ("accepted", "candidate", "rejected")}
    found = results.groupBy(band_of(F.col("score")).alias("band")).agg(F.count("*").alias("n"), *n.values())
    return _names(results, BANDS).join(found, "band", "left").fillna(0)


def share_at_100(results: DataFrame) -> DataFrame:
    accepted = F.count_if(F.col("status") == "accepted")
    return results.agg(F.when(accepted > 0, F.count_if((F.col("status") == "accepted") & (F.col("score") == 100)) / accepted).otherwise(0.0).alias("share_at_100"))


def band_reasons(results: DataFrame, k: int = 5) -> DataFrame:
    """(band, reason, n): the k commonest reasons of each band below 100. Counted before they are ranked."""
    # a filter on the score would be pushed down and compute every part of the score a second time
    rows = results.select(band_of(F.col("score")).alias("band"), F.explode(F.when(F.col("score") < 100, F.col("reasons"))).alias("reason"))
    order = Window.partitionBy("band").orderBy(F.col("n").desc(), "reason")
    return rows.groupBy("band", "reason").agg(F.count("*").alias("n")).withColumn("_rn", F.row_number().over(order)).where(F.col("_rn") <= k).drop("_rn")


def band_averages(results: DataFrame) -> DataFrame:
    """(band, avg_p50, avg_p95, avg_jitter, avg_runs_seen_30d), 0.0 where a band has no values."""
    found = results.groupBy(band_of(F.col("score"), WIDE_BANDS).alias("band")).agg(
        F.avg("p50_latency_ms").alias("avg_p50"), F.avg("p95_latency_ms").alias("avg_p95"), F.avg("jitter_ms").alias("avg_jitter"), F.avg("runs_seen_30d").alias("avg_runs_seen_30d")
    )
    return _names(results, WIDE_BANDS).join(found, "band", "left").fillna(0.0)


def confidence_stats(results: DataFrame) -> DataFrame:
    return results.agg(F.coalesce(F.avg("confidence_score"), F.lit(0.0)).alias("mean_confidence"), F.count_if(F.col("confidence_score") > 0).alias("with_confidence"))


def top_caps(results: DataFrame, k: int = 10) -> DataFrame:
    caps = results.select(F.explode("score_caps_applied").alias("cap")).groupBy("cap").agg(F.count("*").alias("n"))
    return caps.orderBy(F.col("n").desc(), "cap").limit(k)


def compare_bands(old: DataFrame, new: DataFrame) -> DataFrame:
    """(band, old_n, new_n, delta, delta_pct of the old total)."""
    a, b = score_bands(old).select("band", F.col("n").alias("old_n")), score_bands(new).select("band", F.col("n").alias("new_n"))
    total = F.sum("old_n").over(Window.partitionBy())
    both = a.join(b, "band", "full_outer").fillna(0).withColumn("delta", F.col("new_n") - F.col("old_n"))
    return both.withColumn("delta_pct", F.when(total > 0, F.col("delta") * 100.0 / total).otherwise(0.0))


def compare_shares(old: DataFrame, new: DataFrame) -> DataFrame:
    """One row: the share of accepted results with a full score in both, and its change."""
    one = lambda df, name: share_at_100(df).select(F.col("share_at_100").alias(name), F.lit(1).alias("_one"))
    return one(old, "old_share").join(one(new, "new_share"), "_one").select("old_share", "new_share", (F.col("new_share") - F.col("old_share")).alias("change"))


def status_totals(results: DataFrame) -> DataFrame:
    return results.groupBy("status").agg(F.count("*").alias("n"))


def run_summary(runs: DataFrame, run_status: DataFrame, daily: DataFrame, quarantine: DataFrame, k: int = 5) -> DataFrame:
    """One row: latest run, runs tracked, its status counts, active quarantines, top reasons of rejected days."""
    latest = runs.orderBy(F.col("run_date").desc(), F.col("run_started_at").desc()).limit(1).select("run_date", "run_id")
    counted = run_status.join(F.broadcast(latest.select("run_id")), "run_id").agg(*[F.count_if(F.col("status") == s).alias(f"{s}_count") for s in ("accepted", "candidate", "rejected")])
    active = quarantine.where(F.col("retry_after") > latest.select("run_date").scalar()).agg(F.count("*").alias("quarantined_count"))
    reasons = daily.where("day_status = 'rejected'").select(F.explode("reasons").alias("reason")).groupBy("reason").agg(F.count("*").alias("n"))
    top = reasons.orderBy(F.col("n").desc(), "reason").limit(k).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("m"), "reason"))), lambda r: F.concat(r["reason"], F.lit("="), (-r["m"]).cast("string"))), ",").alias("top_reasons")
    )
    one = lambda df: df.withColumn("_one", F.lit(1))
    tracked = runs.agg(F.count("*").alias("runs_tracked"))
    out = one(latest.withColumnsRenamed({"run_date": "latest_run_date", "run_id": "latest_run_id"}))
    for part in (tracked, counted, active, top):
        out = out.join(one(part), "_one")
    return out.drop("_one")


def transport_breakdown(daily: DataFrame) -> DataFrame:
    return daily.groupBy("transport").agg(F.count_distinct("resolver_key").alias("n_keys"))


def seen_in_last_n(daily: DataFrame, days: tuple[int, ...] = (7, 14, 30)) -> DataFrame:
    """(days, n_keys): keys with any row in the last n days up to the newest; a key is reduced to its newest day first."""
    last = daily.groupBy("resolver_key").agg(F.max("run_date").alias("d"))
    newest = last.agg(F.max("d").alias("m"))
    age = last.select(F.datediff(newest.scalar(), "d").alias("age"))
    counts = age.agg(*[F.count_if(F.col("age") < n).alias(f"d{n}") for n in days])
    return counts.select(F.explode(F.array(*[F.struct(F.lit(n).alias("days"), F.col(f"d{n}").alias("n_keys")) for n in days])).alias("r")).select("r.*")


def key_sketches(daily: DataFrame, lg_k: int = 12) -> DataFrame:
    """(run_date, transport, keys): a mergeable sketch of the resolver keys of each day and transport, a few KB each.

    Stored once a day, they answer distinct counts of any window without reading the days again. The standard error
    of a merged count is 1.04 / sqrt(2^lg_k) or less, 1.6 % at 12.
    """
    return daily.groupBy("run_date", "transport").agg(F.hll_sketch_agg("resolver_key", lg_k).alias("keys"))


def approximate_keys(sketches: DataFrame, run_date: Column, days: int) -> DataFrame:
    """(transport, n_keys): about how many keys each transport had in the last `days` days up to run_date."""
    window = sketches.where((F.col("run_date") <= run_date) & (F.col("run_date") > F.date_sub(run_date, days)))
    return window.groupBy("transport").agg(F.hll_sketch_estimate(F.hll_union_agg("keys")).alias("n_keys"))


def capped_count(daily: DataFrame, metrics: DataFrame, run_date: Column, least: int = 14) -> DataFrame:
    """How many keys accepted on run_date have been seen on fewer than `least` of the last 30 days."""
    accepted = daily.where((F.col("run_date") == run_date) & (F.col("day_status") == "accepted")).select("resolver_key")
    return accepted.join(metrics.where(F.col("runs_seen_30d") < least), "resolver_key").agg(F.count("*").alias("capped"))
