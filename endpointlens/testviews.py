"""The given tables seen as endpoint data: probes, runs, candidates, answers. Rules only, no rows of their own."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .operators.history import daily_rollup
from .operators.metrics import endpoint_metrics
from .operators.score import score_probes

ERRORS = ("nxdomain_spoofing", "answer_mismatch", "unexpected_rcode:REFUSED", "unexpected_nxdomain", "http_error:503", "connect_error:x", "timeout_or_error:t")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def last_day(spark: SparkSession, sf_dir: str):
    """The newest day of the events."""
    return F.lit(table(spark, sf_dir, "events").agg(F.max(F.to_date("ts"))).first()[0]).cast("date")


def transport_of(key):
    return F.element_at(F.array(F.lit("dns-udp"), F.lit("dns-tcp"), F.lit("doh")), (key % 3 + 1).cast("int"))


def probes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A probe result per event; the endpoint is the user, a run is a quarter of a day."""
    e = table(spark, sf_dir, "events")
    ok = F.col("event_type") != "error"
    k = F.get_json_object("props", "$.k").cast("int")
    return e.select(
        F.col("user_id").alias("endpoint"), F.col("event_id").alias("seq"), F.to_date("ts").alias("day"),
        F.concat_ws("-", F.date_format("ts", "yyyy-MM-dd"), F.floor(F.hour("ts") / 6).cast("string")).alias("run_id"), ok.alias("ok"),
        F.when(ok, F.col("value") * (1 + F.col("user_id") % 8)).alias("latency_ms"),
        F.when(~ok, F.element_at(F.array(*[F.lit(x) for x in ERRORS]), (k % 7 + 1).cast("int"))).alias("error"),
    )


def run_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row per (endpoint, run): accepted without a failure, candidate up to half of them, else rejected."""
    m = endpoint_metrics(probes(spark, sf_dir), ["endpoint", "run_id"])
    failed = F.col("total") - F.col("ok_count")
    return m.select(
        "run_id", F.concat(F.lit("k|"), F.col("endpoint").cast("string")).alias("resolver_key"), F.concat(F.lit("h"), (F.col("endpoint") % 40).cast("string")).alias("host"),
        transport_of(F.col("endpoint")).alias("transport"), F.when(failed == 0, "accepted").when(2 * failed <= F.col("total"), "candidate").otherwise("rejected").alias("status"),
        F.array_sort("error_reasons").alias("reasons"), "p50_latency_ms", "p95_latency_ms", "jitter_ms",
    )


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = probes(spark, sf_dir).groupBy("run_id").agg(F.min("day").alias("run_date"))
    return p.withColumn("run_started_at", F.col("run_id"))


def daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return daily_rollup(runs(spark, sf_dir), run_status(spark, sf_dir))


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A scored endpoint per (user, day), with the identity of its endpoint."""
    s = score_probes(probes(spark, sf_dir), ["endpoint", "day"])
    return s.drop("transport").withColumns(
        {
            "transport": transport_of(F.col("endpoint")), "host": F.concat(F.lit("h"), (F.col("endpoint") % 40).cast("string")),
            "port": F.when(F.col("endpoint") % 5 == 0, 5353).otherwise(53), "ordinal": F.struct("day", "endpoint"), "path": F.lit("/dns-query"), "tls_server_name": F.lit(None).cast("string"),
            "endpoint_url": F.when(F.col("endpoint") % 3 == 2, F.concat(F.lit("https://h"), (F.col("endpoint") % 40).cast("string"), F.lit("/dns-query"))),
        }
    )


def url_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select(F.col("page_id").alias("ordinal"), F.col("url").alias("endpoint_url"))


def host_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Addresses from customers: some repeat, some have a part above 255."""
    c = table(spark, sf_dir, "customer")
    host = F.concat_ws(".", F.lit("10"), F.col("c_nationkey").cast("string"), (F.col("c_custkey") % 37).cast("string"), (F.col("c_custkey") % 300).cast("string"))
    return c.select(F.col("c_custkey").alias("ordinal"), F.concat(F.lit(" "), host).alias("host"), F.lit(53).alias("port"), transport_of(F.col("c_custkey") % 2).alias("transport"))


def answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An observation per line item: the part is the question, the supplier the resolver."""
    li = table(spark, sf_dir, "lineitem")
    key = F.concat_ws("-", *[F.col(c).cast("string") for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")])
    return li.select(
        key.alias("probe_id"), F.col("l_partkey").alias("part"), F.concat(F.lit("q"), F.col("l_partkey").cast("string")).alias("qname"), F.lit("A").alias("rdtype"),
        F.col("l_suppkey").cast("string").alias("resolver"), F.array("l_returnflag").alias("answers"), key.alias("seq"),
        F.when(F.col("l_linestatus") == "O", "NOERROR").when(F.col("l_returnflag") == "A", "NXDOMAIN").otherwise("REFUSED").alias("rcode"),
        F.when(F.col("l_quantity") > 45, "timed out").alias("error"), (F.col("l_linenumber") % 2).alias("check_no"),
        (F.col("l_tax") >= 0.08).alias("lost"),
    )
