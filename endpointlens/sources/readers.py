"""Lists, pages, records and documents as DataFrames of candidates, results, responses and corpora.

Order matters downstream (keep-first), so every reader gives an `ordinal` from the input's own line or row number.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .. import schemas
from ..functions.text import PLAIN_TRANSPORTS, parse_endpoint, url_parts
from ..operators.dedup import keep_first, rejected, union_all
from . import documents, history_store


def _plain(transport: Column | str) -> Column:
    return F.explode(F.array(*[F.lit(t) for t in PLAIN_TRANSPORTS])).alias("transport")


def read_csv_list(rows: DataFrame, min_reliability: float = 0.5, source: str = "csv") -> tuple[DataFrame, DataFrame]:
    """(kept, rejected) from rows ip_address, reliability, as_org, country_id, ordinal; a row gives both plain transports.

    Reliability that isn't a number counts as 0. Kept rows drop empty metadata, rejected rows keep it.
    """
    some = rows.where(F.coalesce(F.trim("ip_address"), F.lit("")) != "")
    rel = F.coalesce(F.col("reliability").try_cast("double"), F.lit(0.0))
    meta = F.create_map(F.lit("reliability"), F.col("reliability").cast("string"), F.lit("country"), F.col("country_id").cast("string"))
    base = some.select(
        F.when(F.trim("as_org") != "", F.col("as_org")).alias("provider"), F.lit(source).alias("source"), F.trim("ip_address").alias("host"), F.lit(53).alias("port"),
        meta.alias("metadata"), rel.alias("_rel"), "ordinal", _plain("transport"),
    )
    kept = base.where(F.col("_rel") >= min_reliability).withColumn("metadata", F.map_filter("metadata", lambda k, v: v.isNotNull() & (v != "")))
    out = rejected(
        base.where(F.col("_rel") < min_reliability), "source_reliability_below_min", F.format_string("reliability %.2f is below %.2f", F.col("_rel"), F.lit(min_reliability)), "source"
    )
    return kept.drop("_rel"), out.drop("_rel")


def scrape_urls(pages: DataFrame, pattern: str = r"(https://[^\s\"'<>|]*/dns-query[^\s\"'<>|]*)", text: str = "value", keep: Column | None = None) -> DataFrame:
    """(ordinal struct, endpoint_url): matches of the pattern's first group in order, right-stripped of `.,;)`, each once.

    pages has `page` (its order) and the text. keep: a condition on endpoint_url; by default https, a host, no fragment.
    """
    found = pages.select("page", F.posexplode(F.regexp_extract_all(F.col(text), F.lit(pattern), 1)).alias("at", "raw"))
    urls = found.select(F.struct("page", "at").alias("ordinal"), F.regexp_replace("raw", r"[.,;)]+$", "").alias("endpoint_url"))
    p = url_parts(F.col("endpoint_url"))
    fits = (p["scheme"] == "https") & p["host"].isNotNull() & ~F.col("endpoint_url").contains("#") if keep is None else keep
    return keep_first(urls.where(fits), ["endpoint_url"], ["ordinal"])[0]


def markdown_table_endpoints(lines: DataFrame, heading: str = r"^###\s+(.*)$", row: str = r"DNS-over-HTTPS.*?(https://[^\s`|]+)") -> DataFrame:
    """(provider, endpoint_url, ordinal): rows take the heading above them. lines: file, line_no, value."""
    title = F.regexp_replace(F.regexp_extract("value", heading, 1), r"^[* ]+|[* ]+$", "")
    w = Window.partitionBy("file").orderBy("line_no").rowsBetween(Window.unboundedPreceding, 0)
    filled = lines.withColumn("provider", F.last(F.when(F.col("value").rlike(heading), title), ignorenulls=True).over(w))
    urls = filled.withColumn("endpoint_url", F.regexp_extract("value", row, 1)).where("endpoint_url <> ''").withColumn("ordinal", F.struct("file", "line_no"))
    return keep_first(urls, ["endpoint_url"], ["ordinal"])[0].select("provider", "endpoint_url", "ordinal")


def read_line_list(lines: DataFrame, source: str = "manual") -> tuple[DataFrame, DataFrame]:
    """(kept, rejected) from lines (ordinal, value) of `host` or `host:port`; # comments and blanks are skipped."""
    text = F.trim(F.regexp_replace("value", "#.*$", ""))
    rows = lines.withColumn("_t", text).where("_t <> ''").withColumn("_e", parse_endpoint(F.col("_t")))
    fan = rows.select("ordinal", F.col("_e.host").alias("host"), F.col("_e.port").alias("port"), F.lit(source).alias("source"), "_t", _plain("transport"))
    bad = (F.col("host") == "") | F.col("host").rlike(r"\s")
    return fan.where(~bad).drop("_t"), rejected(fan.where(bad), "invalid_dns_host", F.col("_t"), "source").drop("_t")


def read_endpoint_records(rows: DataFrame, source: str = "manual") -> DataFrame:
    """Candidates from rows with url and optional provider, bootstrap lists and tls_server_name; other columns become metadata."""
    known = ("url", "provider", "bootstrap_ipv4", "bootstrap_ipv6", "tls_server_name", "ordinal")
    p = url_parts(F.col("url"))
    has = lambda c, kind: F.col(c).cast(kind) if c in rows.columns else F.lit(None).cast(kind)
    rest = [x for c in rows.columns if c not in known for x in (F.lit(c), F.col(c).cast("string"))]
    meta = F.map_filter(F.create_map(*rest), lambda k, v: v.isNotNull()) if rest else F.create_map().cast("map<string,string>")
    return rows.where("url is not null").select(
        has("provider", "string").alias("provider"), F.lit(source).alias("source"), F.lit("doh").alias("transport"), F.col("url").alias("endpoint_url"), p["host"].alias("host"),
        F.coalesce(p["port"], F.when(p["scheme"] == "https", 443).otherwise(80)).alias("port"), F.when(p["path"] == "", "/dns-query").otherwise(p["path"]).alias("path"),
        has("bootstrap_ipv4", "array<string>").alias("bootstrap_ipv4"), has("bootstrap_ipv6", "array<string>").alias("bootstrap_ipv6"),
        F.coalesce(has("tls_server_name", "string"), p["host"]).alias("tls_server_name"), meta.alias("metadata"), "ordinal",
    )


def discover(sources: list[tuple[DataFrame, DataFrame | None]]) -> tuple[DataFrame, DataFrame | None]:
    """(candidates, rejected) of sources in order; the ordinal becomes a struct of the source index and own ordinals.

    A source's own ordinal keeps its type, so it is ordered as the source orders it (10 after 9): sources share one
    field for each type of ordinal that there is, and a row has its value in the field of its source's type.
    """
    columns = ["provider", "source", "transport", "endpoint_url", "host", "port", "path", "tls_server_name", "metadata"]
    kinds = {"port": "int", "metadata": "map<string,string>"}
    frames = [df for pair in sources for df in pair if df is not None]
    own = list(dict.fromkeys(df.schema["ordinal"].dataType.simpleString() for df in frames))

    def shaped(df: DataFrame, k: int, more: list[str]) -> DataFrame:
        has = lambda c: (F.col(c) if c in df.columns else F.lit(None)).cast(kinds.get(c, "string")).alias(c)
        kind = df.schema["ordinal"].dataType.simpleString()
        places = [(F.col("ordinal") if kind == o else F.lit(None)).cast(o).alias(f"own_{n}") for n, o in enumerate(own)]
        return df.select(*[has(c) for c in columns], F.struct(F.lit(k).alias("source_no"), *places).alias("ordinal"), *more)

    kept = union_all([shaped(df, k, []) for k, (df, _) in enumerate(sources)])
    out = [shaped(df, k, ["reason", "detail", "stage"]) for k, (_, df) in enumerate(sources) if df is not None]
    return kept, union_all(out) if out else None


def read_records(spark: SparkSession, path: str | list[str], schema: str, lines: bool = False) -> DataFrame:
    """Records of JSON documents or arrays, a file each; or, with `lines`, of JSON lines in all files below the path.

    The schema is forced and absent fields are nulls. Lines that aren't JSON objects, or have a value of another type,
    are left out here; bad_lines has them.
    """
    if not lines:
        return spark.read.schema(schema).option("multiLine", True).json(path)
    return _parsed(_lines(spark, path), schema).where(~_bad()).select("r.*").drop("_bad")


def bad_lines(spark: SparkSession, path: str | list[str], schema: str) -> DataFrame:
    """(file, value): the lines that read_records leaves out."""
    return _parsed(_lines(spark, path), schema).where(_bad()).select("file", "value")


def _bad() -> Column:
    return F.col("r").isNull() | F.col("r._bad").isNotNull()


def _lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return spark.read.option("recursiveFileLookup", True).text(path).select(F.input_file_name().alias("file"), "value").where(F.trim("value") != "")


def _parsed(lines: DataFrame, schema: str) -> DataFrame:
    return lines.withColumn("r", F.from_json("value", schema + ", _bad string", {"columnNameOfCorruptRecord": "_bad", "mode": "PERMISSIVE"}))


def read_candidates(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """Candidates from JSON arrays or lines, absent fields defaulted."""
    df = read_records(spark, path, schemas.CANDIDATE, lines)
    empty = F.array().cast("array<string>")
    return df.withColumns(
        {
            "source": F.coalesce("source", F.lit("loaded")), "bootstrap_ipv4": F.coalesce("bootstrap_ipv4", empty), "bootstrap_ipv6": F.coalesce("bootstrap_ipv6", empty),
            "metadata": F.coalesce("metadata", F.create_map().cast("map<string,string>")),
        }
    )


def read_filtered(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    return read_records(spark, path, schemas.FILTERED, lines)


def read_results(spark: SparkSession, path: str | list[str], lines: bool = False) -> DataFrame:
    """Scored results with their probes; parts of the score come from the breakdown, else the flat fields, else 0."""
    df = read_records(spark, path, schemas.RESULT, lines)
    part = lambda c: F.coalesce(F.col(f"score_breakdown.{c}"), F.col(f"{c}_score"), F.lit(0))
    return df.withColumns({f"{c}_score": part(c) for c in ("correctness", "availability", "performance", "history")})


def read_results_parts(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """The file itself, or where it is missing its parts `stem.part-*` with the same ending; none is an error."""
    stem, dot, ending = path.rpartition(".")
    return read_results(spark, path if history_store.paths(spark, path) else history_store.paths(spark, f"{stem}.part-*{dot}{ending}") or path, lines)


#: The reader of each source type.
SOURCES = {"csv": read_csv_list, "scrape": scrape_urls, "markdown": markdown_table_endpoints, "lines": read_line_list, "records": read_endpoint_records}


def read_source(kind: str, *args, **options) -> tuple[DataFrame, DataFrame | None]:
    """(candidates, rejected or None) of a source type; an unknown type raises."""
    if kind not in SOURCES:
        raise ValueError(f"unknown source type: {kind}")
    out = SOURCES[kind](*args, **options)
    return out if isinstance(out, tuple) else (out, None)


def read_sources(plain: list[tuple], urls: list[tuple]) -> tuple[DataFrame, DataFrame | None]:
    """(candidates, rejected) of configured sources (type, arguments...): those of hosts first, then those of URLs, each in order."""
    return discover([read_source(kind, *args) for kind, *args in [*plain, *urls]])


def whole_files(spark: SparkSession, path: str) -> DataFrame:
    """(file, value): each file as one text."""
    return spark.read.text(path, wholetext=True).select(F.input_file_name().alias("file"), "value")


def read_corpus(spark: SparkSession, path: str, version: int | None = None, strict: bool = True) -> tuple[DataFrame, DataFrame]:
    """(probes, errors) of corpus documents. errors: (file, path, field, error), none for a valid document."""
    raw = whole_files(spark, path)
    return documents.corpus_probes(raw), documents.corpus_errors(raw, version, strict)


def read_seeds(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(roots, delegations with exact_hosts, errors), the first two with their position."""
    df = spark.read.schema(schemas.SEEDS).option("multiLine", True).json(path)
    roots = df.select(F.posexplode_outer("root_servers").alias("position", "r")).where("r is not null").select("position", "r.*")
    delegations = df.select(F.posexplode_outer("delegations").alias("position", "d")).where("d is not null").select("position", "d.*")
    return roots, delegations, documents.seed_errors(whole_files(spark, path))


def read_responses(lines: DataFrame, default_rdtype: str = "A") -> tuple[DataFrame, DataFrame]:
    """(observations, bad lines) from NDJSON lines (line_no, value) of a responder."""
    parsed = lines.withColumn("r", F.from_json("value", schemas.RESPONSE, {"columnNameOfCorruptRecord": "_bad", "mode": "PERMISSIVE"}))
    name = F.coalesce("r.name", "r.qname")
    good = parsed.where(F.col("r").isNotNull() & F.col("r._bad").isNull() & name.isNotNull())
    rdtype = F.upper(F.coalesce("r.type", "r.qtype", F.lit(default_rdtype)))
    last = F.transform(F.coalesce("r.answers", F.array().cast("array<string>")), lambda a: F.when(a.startswith("{"), F.get_json_object(a, "$.data")).otherwise(F.substring_index(F.trim(a), " ", -1)))
    out = good.select(
        F.coalesce("r.resolver", "r.resolver_ip").alias("resolver"), F.lower(name).alias("qname"), rdtype.alias("rdtype"),
        F.upper(F.coalesce("r.rcode", "r.status", "r.data.rcode")).alias("rcode"), F.array_compact(last).alias("answers"),
        F.coalesce("r.latency_ms", "r.rt").alias("latency_ms"), F.coalesce("r.error", "r.failure").alias("error"), "line_no",
    )
    return out, parsed.where(F.col("r").isNull() | F.col("r._bad").isNotNull() | name.isNull()).select("line_no", "value")


def read_run_metadata(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """A row a run: generated_at in UTC and its date."""
    df = read_records(spark, path, "generated_at string, github_run_id string, repo_sha string, crawler_sha string", lines)
    at = F.to_timestamp(F.regexp_replace("generated_at", "Z$", "+00:00"))
    return df.withColumns({"generated_at": at, "run_date": F.to_date(at), "run_id": F.concat_ws("_", "github_run_id", "generated_at")})


def read_history(spark: SparkSession, base: str, table: str) -> DataFrame:
    """A table of the history as of its newest commit."""
    return history_store.read_table(spark, base, history_store.head(spark, base)[1], table)
