"""Keep-first de-duplication with a reject channel, and set operations."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import canonical_url, normalize_ip, url_parts
from .ranks import same


def keep_first(df: DataFrame, keys: list[str], order: list[str]) -> tuple[DataFrame, DataFrame]:
    """(first row of each key, the later rows); the order tells the rows of a key apart. Null keys are keys.

    First rows are an aggregate with partial results, so a key that most rows share is no hot task; later rows are
    found by a join with the first places, whose large partitions Spark splits.
    """
    whole = F.min_by(F.struct(*df.columns), F.struct(*order)).alias("_row")
    kept = df.groupBy(*[F.col(k).alias(f"_of_{n}") for n, k in enumerate(keys)]).agg(whole).select("_row.*")
    places = df.groupBy(*[F.col(k).alias(f"_of_{n}") for n, k in enumerate(keys)]).agg(F.min(F.struct(*order)).alias("_first"))
    met = df.join(places, same([F.col(k) for k in keys], [F.col(f"_of_{n}") for n in range(len(keys))]))
    later = met.where(~F.struct(*order).eqNullSafe(F.col("_first"))).drop("_first", *[f"_of_{n}" for n in range(len(keys))])
    return kept, later


def rejected(df: DataFrame, reason: str, detail: Column, stage: str = "normalize") -> DataFrame:
    return df.withColumns({"reason": F.lit(reason), "detail": detail.cast("string"), "stage": F.lit(stage)})


def normalize_hosts(candidates: DataFrame, normal: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """(kept, rejected) plain candidates: canonical host, then the first of each (host, port, transport)."""
    marked = candidates.withColumn("_host", normalize_ip(F.col("host")) if normal is None else normal)
    bad = rejected(marked.where("_host is null").drop("_host"), "invalid_dns_host", F.col("host"))
    good = marked.where("_host is not null").withColumn("host", F.col("_host")).drop("_host")
    kept, later = keep_first(good, ["host", "port", "transport"], ["ordinal"])
    return kept, bad.unionByName(rejected(later, "duplicate_dns_candidate", F.concat_ws(":", "transport", "host", F.col("port").cast("string"))))


def normalize_urls(candidates: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(kept, rejected) URL candidates: canonical URL, then the first of each; host, port and path come from it."""
    marked = candidates.withColumn("_url", canonical_url(F.col("endpoint_url")))
    bad = rejected(marked.where("_url is null").drop("_url"), "invalid_doh_url", F.col("endpoint_url"))
    good = marked.where("_url is not null")
    kept, later = keep_first(good, ["_url"], ["ordinal"])
    p = url_parts(F.col("_url"))
    parts = {"endpoint_url": F.col("_url"), "host": p["host"], "port": F.coalesce(p["port"], F.lit(443)), "path": p["path"]}
    kept = kept.withColumns(parts)
    if "tls_server_name" in kept.columns:
        kept = kept.withColumn("tls_server_name", F.coalesce("tls_server_name", "host"))
    later = rejected(later, "duplicate_doh_candidate", F.col("_url"))
    return kept.drop("_url"), bad.unionByName(later.drop("_url"))


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def unresolved(plan: DataFrame, results: DataFrame, key: str = "probe_id") -> DataFrame:
    """Planned probes without a result, as failures."""
    return plan.join(results.select(key), key, "left_anti").withColumns({"ok": F.lit(False), "error": F.lit("timeout_or_error:massdns_unmatched")})


def duplicate_ids(df: DataFrame, key: str) -> DataFrame:
    return df.groupBy(key).agg(F.count("*").alias("n")).where("n > 1")


def distinct_resolvers(df: DataFrame, host: str = "host", port: str = "port") -> DataFrame:
    return df.select(F.concat_ws(":", host, F.col(port).cast("string")).alias("resolver")).distinct().orderBy("resolver")


def top_k(df: DataFrame, count: str, name: str, k: int) -> DataFrame:
    return df.orderBy(F.col(count).desc(), F.col(name).asc()).limit(k)
