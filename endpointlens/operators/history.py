"""Daily rollups, stability over days, quarantine and retention, for all endpoints at once.

All windows of stability share one partitioning by resolver_key, so an endpoint's days are sorted once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.text import PLAIN_TRANSPORTS, is_severe, quarantine_detail, reasons_signature, union_reasons


def daily_rollup(runs: DataFrame, run_status: DataFrame) -> DataFrame:
    """One row per (run_date, resolver_key) of all runs of the day."""
    rows = runs.select("run_id", "run_date").join(run_status.drop("run_date"), "run_id")
    accepted, failed, total = F.count_if(F.col("status") == "accepted"), F.count_if(F.col("status") == "rejected"), F.count("*")
    day = rows.groupBy("run_date", "resolver_key").agg(
        F.min("host").alias("host"), F.min("transport").alias("transport"), union_reasons(F.col("reasons")).alias("reasons"),
        total.alias("runs"), accepted.alias("successful_runs"), failed.alias("failed_runs"), F.size(F.collect_set("status")).alias("_kinds"),
        F.max(is_severe(F.col("reasons"))).alias("_severe"), F.avg("p50_latency_ms").alias("avg_p50"), F.avg("p95_latency_ms").alias("avg_p95"), F.avg("jitter_ms").alias("avg_jitter"),
    )
    status = (
        F.when(F.col("_severe"), "rejected")
        .when((F.col("successful_runs") > 0) & (F.col("failed_runs") == 0), "accepted")
        .when(F.col("failed_runs") == F.col("runs"), "rejected")
        .otherwise("candidate")
    )
    return day.withColumns({"day_status": status, "reasons_signature": reasons_signature(F.col("reasons")), "flapped_within_day": F.col("_kinds") > 1}).drop("_kinds", "_severe")


def host_day(daily: DataFrame) -> DataFrame:
    """One row per (host, run_date) over the plain transports: the best status of the host's endpoints."""
    return _best(daily.where(F.col("transport").isin(*PLAIN_TRANSPORTS)), ["host", "run_date"], "day_status")


def host_outcomes(results: DataFrame) -> DataFrame:
    """One row per host of scored results, sorted by host, with the first udp and tcp status in input order."""
    plain = results.where(F.col("transport").isin(*PLAIN_TRANSPORTS))
    first = lambda t: F.min_by(F.when(F.col("transport") == t, F.col("status")), F.when(F.col("transport") == t, F.col("ordinal")))
    return _best(plain, ["host"], "status", udp_status=first("dns-udp"), tcp_status=first("dns-tcp")).orderBy("host")


def _best(df: DataFrame, keys: list[str], status: str, **more: Column) -> DataFrame:
    n = {s: F.count_if(F.col(status) == s).alias(f"{s}_count") for s in ("accepted", "candidate", "rejected")}
    out = df.groupBy(*keys).agg(*n.values(), union_reasons(F.col("reasons")).alias("reasons"), *[c.alias(k) for k, c in more.items()])
    best = F.when(F.col("accepted_count") > 0, "accepted").when(F.col("candidate_count") > 0, "candidate").otherwise("rejected")
    return out.withColumns({"status": best, "reasons_signature": reasons_signature(F.col("reasons"))})


def stability_metrics(daily: DataFrame, run_date: Column) -> DataFrame:
    """Metrics of every resolver_key as of run_date; keys without a row in the last 30 days have none.

    Streaks end exactly on run_date and are ended by a gap, a candidate day or the other status. Flaps are counted
    over the newest 30 rows, whatever their dates.
    """
    newest = Window.partitionBy("resolver_key").orderBy(F.col("run_date").desc())
    rows = daily.where(F.col("run_date") <= run_date).withColumns(
        {
            "_rn": F.row_number().over(newest), "_newer": F.lag("day_status").over(newest),
            "_first": F.first("day_status").over(newest.rowsBetween(Window.unboundedPreceding, Window.currentRow)),
            "_age": F.datediff(run_date, "run_date"),
        }
    )
    ends = (F.col("_age") != F.col("_rn") - 1) | (F.col("day_status") != F.col("_first")) | (F.col("day_status") == "candidate")
    good, recent = F.col("day_status") == "accepted", F.col("_rn") <= 30
    out = rows.groupBy("resolver_key").agg(
        F.count_if(F.col("_age") < 7).alias("runs_seen_7d"), F.count_if(F.col("_age") < 30).alias("runs_seen_30d"),
        F.count_if((F.col("_age") < 7) & good).alias("success_days_7d"), F.count_if((F.col("_age") < 30) & good).alias("success_days_30d"),
        F.coalesce(F.min(F.when(ends, F.col("_rn"))) - 1, F.count("*")).alias("_streak"), F.max_by("day_status", "run_date").alias("latest_status"),
        F.count_if(recent & F.col("_newer").isNotNull() & (F.col("_newer") != F.col("day_status"))).alias("status_flaps_30d"),
        F.count_if(recent & F.col("flapped_within_day")).alias("flapped_within_day_30d"),
        F.count_if(recent & F.col("flapped_within_day") & (F.col("_age") < 7)).alias("flapped_within_day_7d"),
    )
    streak = lambda s: F.when(F.col("latest_status") == s, F.col("_streak")).otherwise(0).cast("long")
    return out.where("runs_seen_30d > 0").withColumns({"consecutive_success_days": streak("accepted"), "consecutive_fail_days": streak("rejected")}).drop("_streak")


def stability_panel(daily: DataFrame) -> DataFrame:
    """7- and 30-day counts as of every day of every key, in one pass of range windows."""
    day = F.datediff("run_date", F.lit("1970-01-01").cast("date"))
    w = Window.partitionBy("resolver_key").orderBy("_day")
    out = daily.withColumn("_day", day)
    good = F.when(F.col("day_status") == "accepted", 1)
    cols = {}
    for n in (7, 30):
        cols[f"runs_seen_{n}d"] = F.count("*").over(w.rangeBetween(-(n - 1), 0))
        cols[f"success_days_{n}d"] = F.count(good).over(w.rangeBetween(-(n - 1), 0))
    return out.withColumns(cols).select("resolver_key", "run_date", *cols)


def rejected_streak(host_days: DataFrame, n: int = 14) -> DataFrame:
    """host_days with `streak`: the n newest days up to this one are n days in a row, all rejected."""
    w = Window.partitionBy("host").orderBy("run_date").rowsBetween(-(n - 1), 0)
    full = (F.count("*").over(w) == n) & (F.min("run_date").over(w) == F.date_sub("run_date", n - 1)) & (F.count(F.when(F.col("status") != "rejected", 1)).over(w) == 0)
    return host_days.withColumn("streak", full)


def quarantine_fold(host_days: DataFrame, streak: int = 14, days: int = 90) -> DataFrame:
    """Quarantine after all days of each host, from no state: the daily step folded over the host's sorted days.

    A host's days are bounded by the history that is kept. Rules of a day, in order: an expired record is renewed if
    the host is still rejected for the same reasons, else it goes (and isn't put back that day); without a record a
    full streak makes one; an active record stays.
    """
    marked = rejected_streak(host_days, streak)
    each = F.array_sort(F.collect_list(F.struct("run_date", "status", F.col("reasons_signature").alias("sig"), "reasons", "streak")))
    record = "struct<first:date,last:date,retry:date,sig:string,reasons:array<string>,cycles:int>"
    none = F.lit(None).cast(record)

    def step(state: Column, day: Column) -> Column:
        until = F.date_add(day["run_date"], days)
        fresh = F.struct(day["run_date"].alias("first"), day["run_date"].alias("last"), until.alias("retry"), day["sig"].alias("sig"), day["reasons"].alias("reasons"), F.lit(1).alias("cycles"))
        again = F.struct(state["first"].alias("first"), day["run_date"].alias("last"), until.alias("retry"), state["sig"].alias("sig"), state["reasons"].alias("reasons"), (state["cycles"] + 1).cast("int").alias("cycles"))
        expired = state.isNotNull() & (state["retry"] <= day["run_date"])
        same = (day["status"] == "rejected") & (day["sig"] == state["sig"])
        return F.when(expired & same, again.cast(record)).when(expired, none).when(state.isNull() & day["streak"], fresh.cast(record)).otherwise(state)

    folded = marked.groupBy("host").agg(each.alias("_days")).withColumn("_q", F.aggregate("_days", none, step))
    return folded.where("_q is not null").select(
        "host", F.col("_q.first").alias("first_quarantined_on"), F.col("_q.last").alias("last_quarantined_on"), F.col("_q.retry").alias("retry_after"),
        F.col("_q.sig").alias("reasons_signature"), F.col("_q.reasons").alias("reasons"), F.col("_q.cycles").alias("cycles"),
    )


def quarantine_step(outcomes: DataFrame, state: DataFrame, run_date: Column, days: int = 90) -> DataFrame:
    """The state after one day: outcomes (host, status, reasons, reasons_signature, streak) meet yesterday's records."""
    s = state.select("host", *[F.col(c).alias(f"_{c}") for c in ("first_quarantined_on", "last_quarantined_on", "retry_after", "reasons_signature", "reasons", "cycles")])
    both = outcomes.join(s, "host", "full_outer")
    known, present = F.col("_retry_after").isNotNull(), F.col("status").isNotNull()
    expired = known & present & (F.col("_retry_after") <= run_date)
    renew = expired & (F.col("status") == "rejected") & (F.col("reasons_signature") == F.col("_reasons_signature"))
    new = ~known & F.coalesce("streak", F.lit(False))
    kept = both.where((known & ~expired) | renew | new)
    moved, fresh = renew | new, F.coalesce(new, F.lit(False))
    return kept.select(
        "host", F.when(fresh, run_date).otherwise(F.col("_first_quarantined_on")).alias("first_quarantined_on"),
        F.when(moved, run_date).otherwise(F.col("_last_quarantined_on")).alias("last_quarantined_on"),
        F.when(moved, F.date_add(run_date, days)).otherwise(F.col("_retry_after")).alias("retry_after"),
        F.when(fresh, F.col("reasons_signature")).otherwise(F.col("_reasons_signature")).alias("reasons_signature"),
        F.when(fresh, F.col("reasons")).otherwise(F.col("_reasons")).alias("reasons"),
        F.when(fresh, 1).otherwise(F.col("_cycles") + F.when(renew, 1).otherwise(0)).cast("int").alias("cycles"),
    )


def active_quarantine(state: DataFrame, run_date: Column) -> DataFrame:
    return state.where(F.col("retry_after") > run_date)


def apply_quarantine(candidates: DataFrame, state: DataFrame, run_date: Column) -> tuple[DataFrame, DataFrame]:
    """(eligible, filtered): plain candidates of an actively quarantined host are filtered, URL candidates never."""
    active = active_quarantine(state, run_date).select("host", "retry_after", F.col("reasons").alias("_why"))
    both = candidates.join(active, "host", "left").withColumn("_out", F.col("retry_after").isNotNull() & F.col("transport").isin(*PLAIN_TRANSPORTS))
    out = both.where("_out").withColumns({"reason": F.lit("historical_dns_quarantine"), "detail": quarantine_detail(F.col("retry_after"), F.col("_why")), "stage": F.lit("history")})
    return both.where("not _out").drop("_out", "_why", "retry_after"), out.drop("_out", "_why", "retry_after")


def retain(df: DataFrame, run_date: Column, days: int = 30) -> DataFrame:
    """Rows of the last `days` days up to run_date; on a table partitioned by run_date this prunes partitions."""
    return df.where(F.col("run_date") >= F.date_sub(run_date, days - 1))


def recent_days(daily: DataFrame, key: str, n: int = 7) -> DataFrame:
    return daily.where(F.col("resolver_key") == key).orderBy(F.col("run_date").desc()).limit(n)


def sample_key(daily: DataFrame, seed: int = 0) -> DataFrame:
    return daily.select("resolver_key").distinct().orderBy(F.rand(seed)).limit(1)
