"""The registered queries of the endpoint operators: Spark over the whole given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import job_queries
from . import testviews as v
from .functions import text as t
from .job_oracles import JOB_SQL
from .oracles import ORACLE_SQL as QUERY_SQL
from .operators import analyze, corpus, dedup, evaluate, export, history, metrics
from .operators.score import score_probes
from .sources import readers

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = dict(job_queries.QUERIES)
ORACLE_SQL: dict[str, str] = {**QUERY_SQL, **JOB_SQL}


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[f.__name__] = f
    return f


def text_of(c: str):
    return F.col(c).cast("string").alias(c)


def listed(c: str):
    return F.array_join(F.array_sort(c), "|").alias(c)


@query
def score_endpoints(s, d):
    out = score_probes(v.probes(s, d), ["endpoint", "day"])
    return out.select("endpoint", text_of("day"), "score", "status", "correctness_score", "availability_score", "performance_score", "confidence_score", listed("reasons"), listed("score_caps_applied"))


@query
def latency_stats(s, d):
    return metrics.latency_stats(v.probes(s, d), ["endpoint"])


@query
def error_histogram(s, d):
    return metrics.error_histogram(v.probes(s, d), ["endpoint"])


@query
def availability_tier(s, d):
    c = metrics.probe_counts(v.probes(s, d), ["endpoint"])
    return c.withColumn("points", metrics.availability_points(F.col("ok_count"), F.col("total")))


@query
def url_canonical(s, d):
    return v.url_candidates(s, d).select(F.col("ordinal").alias("page_id"), t.canonical_url(F.col("endpoint_url")).alias("canonical"))


@query
def resolver_key(s, d):
    key = t.resolver_key(F.lit("doh"), F.lit(None).cast("string"), F.lit(None).cast("int"), F.col("endpoint_url"))
    parsed = v.url_candidates(s, d).select(F.col("ordinal").alias("page_id"), key.alias("key")).withColumn("p", t.parse_key(F.col("key")))
    return parsed.select("page_id", "key", F.col("p.transport").alias("transport"), F.col("p.host").alias("host"))


@query
def url_dedup(s, d):
    return dedup.normalize_urls(v.url_candidates(s, d))[0].select("ordinal", "endpoint_url", "host", "port", "path")


@query
def url_rejects(s, d):
    return dedup.normalize_urls(v.url_candidates(s, d))[1].select("ordinal", "reason", "detail", "stage")


@query
def dedup_keep_first(s, d):
    return dedup.normalize_hosts(v.host_candidates(s, d), t.normalize_ip(F.col("host")))[0]


@query
def dedup_rejects(s, d):
    return dedup.normalize_hosts(v.host_candidates(s, d))[1].select("ordinal", "reason", "transport")


@query
def scrape_links(s, d):
    pages = v.table(s, d, "pages").select(F.col("page_id").alias("page"), "html")
    found = readers.scrape_urls(pages, 'href="([^"]+)"', "html", F.col("endpoint_url") != "")
    return found.select(F.col("ordinal.page").alias("page"), F.col("ordinal.at").cast("long").alias("at"), "endpoint_url")


@query
def fill_down(s, d):
    rows = v.table(s, d, "conversations").select(
        F.col("conv_id").alias("file"), F.col("turn").alias("line_no"),
        F.when(F.col("role") == "user", F.concat(F.lit("### "), F.split("text", "\n")[0])).otherwise(F.concat(F.lit("DNS-over-HTTPS https://x/"), F.col("conv_id").cast("string"), F.lit("-"), F.col("turn").cast("string"))).alias("value"),
    )
    out = readers.markdown_table_endpoints(rows, r"(?s)^### (.*)$")
    return out.select(F.col("ordinal.file").alias("conv_id"), F.col("ordinal.line_no").alias("turn"), "provider", "endpoint_url")


@query
def reliability_split(s, d):
    rows = v.table(s, d, "customer").select(
        F.col("c_name").alias("ip_address"), (F.col("c_acctbal") / 10000).cast("string").alias("reliability"), F.col("c_mktsegment").alias("as_org"), F.lit("").alias("country_id"), F.col("c_custkey").alias("ordinal")
    )
    kept, out = readers.read_csv_list(rows, 0.5)
    cols = ["ordinal", "host", "transport", "provider", F.size("metadata").cast("int").alias("n_meta")]
    return kept.select(*cols, F.lit(None).cast("string").alias("reason")).unionByName(out.select(*cols, "reason"))


DAILY = ["run_date", "resolver_key", "host", "transport", "day_status", "runs", "successful_runs", "failed_runs", "flapped_within_day", "reasons_signature"]


def shown(df, columns):
    return df.select(*[text_of(c) if isinstance(c, str) and c == "run_date" else c for c in columns])


@query
def daily_rollup(s, d):
    rounded = [F.round(c, 6).alias(c) for c in ("avg_p50", "avg_p95", "avg_jitter")]
    return shown(v.daily(s, d), [*DAILY, *rounded])


@query
def flapped_days(s, d):
    return shown(v.daily(s, d).where("flapped_within_day"), ["run_date", "resolver_key", "day_status"])


@query
def run_status_join(s, d):
    return v.runs(s, d).join(v.run_status(s, d), "run_id").where(F.col("run_date") == v.last_day(s, d)).select(text_of("run_date"), "run_id", "resolver_key", "status")


@query
def host_day(s, d):
    return shown(history.host_day(v.daily(s, d)), ["host", "run_date", "status", "accepted_count", "candidate_count", "rejected_count", "reasons_signature"])


STABILITY = ["runs_seen_7d", "runs_seen_30d", "success_days_7d", "success_days_30d", "consecutive_success_days", "consecutive_fail_days", "status_flaps_30d", "flapped_within_day_30d", "flapped_within_day_7d", "latest_status"]


@query
def stability_metrics(s, d):
    return history.stability_metrics(v.daily(s, d), v.last_day(s, d)).select("resolver_key", *STABILITY)


@query
def stability_panel(s, d):
    return shown(history.stability_panel(v.daily(s, d)), ["resolver_key", "run_date", "runs_seen_7d", "runs_seen_30d", "success_days_7d", "success_days_30d"])


@query
def rejected_streak(s, d):
    return shown(history.rejected_streak(history.host_day(v.daily(s, d)), 2).where("streak"), ["host", "run_date"])


@query
def history_retention(s, d):
    return shown(history.retain(v.daily(s, d), v.last_day(s, d), 10), ["run_date", "resolver_key"])


@query
def quarantine_state(s, d):
    q = history.quarantine_fold(history.host_day(v.daily(s, d)), streak=2)
    return q.select("host", text_of("first_quarantined_on"), text_of("retry_after"), "reasons_signature", "cycles")


@query
def quarantine_renewal(s, d):
    q = history.quarantine_fold(history.host_day(v.daily(s, d)), streak=1, days=3)
    return q.select("host", text_of("first_quarantined_on"), text_of("last_quarantined_on"), text_of("retry_after"), "reasons_signature", "cycles")


@query
def quarantine_apply(s, d):
    state = history.quarantine_fold(history.host_day(v.daily(s, d)), streak=2)
    kept, out = history.apply_quarantine(v.scored(s, d).select("endpoint", "day", "host", "transport"), state, v.last_day(s, d))
    shape = lambda df, reason: df.select("endpoint", text_of("day"), reason)
    return shape(kept, F.lit(None).cast("string").alias("reason")).unionByName(shape(out, F.col("reason")))


@query
def score_with_history(s, d):
    m = history.stability_metrics(v.daily(s, d), v.last_day(s, d)).withColumn("endpoint", F.substring_index("resolver_key", "|", -1).cast("long"))
    today = v.probes(s, d).where(F.col("day") == v.last_day(s, d))
    return score_probes(today, ["endpoint"], m).select("endpoint", "score", "status", "history_score", "confidence_score", listed("reasons"), listed("score_caps_applied"))


@query
def probe_plan(s, d):
    c = v.table(s, d, "supplier").select(F.col("s_suppkey").alias("candidate_id"), v.transport_of(F.col("s_suppkey")).alias("transport"))
    return evaluate.probe_plan(c, corpus.builtin_corpus(s), 3).select("candidate_id", "round", "seq", "kind", "rdtype", "qname", "probe_name")


@query
def evaluate_positive(s, d):
    a = v.answers(s, d)
    plan = a.select("probe_id", "qname", "rdtype", F.lit("exact_rrset").alias("expected_mode"), F.array(F.lit("N")).alias("expected_answers"))
    return evaluate.evaluate_positive(plan, a.where("not lost")).select("probe_id", "ok", "error")


@query
def evaluate_negative(s, d):
    a = v.answers(s, d)
    return evaluate.evaluate_negative(a.select("probe_id"), a.where("not lost")).select("probe_id", "ok", "error")


@query
def unresolved_probes(s, d):
    a = v.answers(s, d)
    return dedup.unresolved(a.select("probe_id"), a.where("not lost")).select("probe_id", "ok", "error")


@query
def consensus_baseline(s, d):
    return evaluate.baseline_consensus(v.answers(s, d), 4).select("qname", F.array_join("agreed", ",").alias("agreed"))


@query
def quorum_exact(s, d):
    a = v.answers(s, d).withColumn("expected", F.array(F.lit("N")))
    return evaluate.vote_exact(a, ["qname"], 2)


@query
def quorum_consensus(s, d):
    return evaluate.vote_consensus(v.answers(s, d), ["qname"], 2)


@query
def quorum_negative(s, d):
    a = v.answers(s, d).withColumn("answers", F.when(F.col("rcode") == "NXDOMAIN", F.array().cast("array<string>")).otherwise(F.col("answers")))
    return evaluate.vote_negative(a, ["qname"], quorum=1)


@query
def fifo_match(s, d):
    plan = v.table(s, d, "orders").select((F.col("o_custkey") % 50).alias("resolver"), (F.col("o_custkey") % 3).alias("question"), F.col("o_orderkey").alias("probe"))
    named = F.when(F.col("event_type") != "error", F.col("user_id") % 60)
    answers = v.table(s, d, "events").select(named.alias("resolver"), (F.col("event_id") % 3).alias("question"), F.col("event_id").alias("response"))
    matched, left = evaluate.fifo_match(plan, answers, ["resolver"], ["question"], "probe", "response")
    return matched.select("question", "probe", "response").unionByName(left.select("question", F.lit(None).cast("long").alias("probe"), "response"))


@query
def route_batches(s, d):
    c = v.table(s, d, "lineitem").select(
        F.col("l_orderkey").alias("a"), F.col("l_linenumber").alias("b"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("seq"), v.transport_of(F.col("l_suppkey")).alias("transport"),
        F.when(F.col("l_partkey") % 4 == 0, 5353).otherwise(53).alias("port"), F.col("l_returnflag").alias("rdtype"),
    )
    return evaluate.route_batches(c, 500).select("a", "b", "rdtype", "batch")


@query
def recent_days(s, d):
    return shown(history.recent_days(v.daily(s, d), "k|1", 7), ["run_date", "resolver_key", "day_status"])


@query
def host_ports(s, d):
    text = F.concat_ws(":", "c_name", F.when(F.col("c_custkey") % 3 > 0, F.when(F.col("c_custkey") % 3 == 1, F.col("c_nationkey").cast("string")).otherwise("x")))
    return v.table(s, d, "customer").select("c_custkey", t.parse_endpoint(text).alias("p")).select("c_custkey", F.col("p.host").alias("host"), F.col("p.port").alias("port"))


@query
def probe_ids(s, d):
    return v.table(s, d, "part").select("p_partkey", t.probe_id(F.lit("exact"), F.concat(F.replace("p_name", F.lit(" "), F.lit(".")), F.lit("..")), F.col("p_brand")).alias("probe_id"))


@query
def results_payload(s, d):
    probes = v.probes(s, d).groupBy("endpoint").agg(F.collect_list(F.struct("ok", "latency_ms")).alias("probes"))
    return export.with_median_latency(probes).select("endpoint", "median_latency_ms")


@query
def score_bands(s, d):
    return analyze.score_bands(v.scored(s, d))


@query
def score_histogram(s, d):
    return analyze.score_histogram(v.scored(s, d))


@query
def band_reasons(s, d):
    return analyze.band_reasons(v.scored(s, d))


@query
def band_averages(s, d):
    return analyze.band_averages(v.scored(s, d)).select("band", *[F.round(c, 6).alias(c) for c in ("avg_p50", "avg_p95", "avg_jitter", "avg_runs_seen_30d")])


@query
def top_caps(s, d):
    return analyze.top_caps(v.scored(s, d))


@query
def confidence_stats(s, d):
    return analyze.confidence_stats(v.scored(s, d)).select(F.round("mean_confidence", 6).alias("mean_confidence"), "with_confidence")


@query
def compare_bands(s, d):
    r, half = v.scored(s, d), F.date_sub(v.last_day(s, d), 14)
    return analyze.compare_bands(r.where(F.col("day") < half), r.where(F.col("day") >= half)).withColumn("delta_pct", F.round("delta_pct", 6))


@query
def status_totals(s, d):
    return analyze.status_totals(v.scored(s, d))


@query
def run_summary(s, d):
    daily = v.daily(s, d)
    state = history.quarantine_fold(history.host_day(daily), streak=2)
    return analyze.run_summary(v.runs(s, d), v.run_status(s, d), daily, state).withColumn("latest_run_date", F.col("latest_run_date").cast("string"))


@query
def transport_breakdown(s, d):
    return analyze.transport_breakdown(v.daily(s, d))


@query
def history_depth(s, d):
    return analyze.seen_in_last_n(v.daily(s, d))


@query
def capped_count(s, d):
    daily = v.daily(s, d)
    return analyze.capped_count(daily, history.stability_metrics(daily, v.last_day(s, d)), v.last_day(s, d), 29)


@query
def even_shards(s, d):
    return export.assign_shards(v.table(s, d, "customer").select("c_custkey", "c_name"), 7, ["c_name", "c_custkey"]).select("c_custkey", "shard")


@query
def sorted_export(s, d):
    rows = v.table(s, d, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    return export.json_lines(rows, [F.col("s_name")])


@query
def size_bounded_parts(s, d):
    record = F.octet_length(F.to_json(F.struct("doc_id", "text"), {"ignoreNullFields": "false"}))
    docs = v.table(s, d, "documents").select("doc_id", "source", record.cast("long").alias("size"))
    return export.pack_by_bytes(docs, ["source"], [F.col("doc_id")], 20_000).select("doc_id", "part")


@query
def quota_select(s, d):
    items = v.table(s, d, "part").select(F.col("p_partkey").alias("ordinal"), F.col("p_brand").alias("zone"), F.col("p_type").alias("family"), (F.col("p_size") % 3).cast("long").alias("want"))
    return corpus.greedy_quota(items, 40, 25).where("takes > 0").select("ordinal", "takes")


@query
def plain_list(s, d):
    return export.plain_list(v.scored(s, d))


@query
def url_list(s, d):
    return export.plain_list(v.scored(s, d), True)


@query
def forwarder_lines(s, d):
    return export.forwarder_lines(v.scored(s, d))


@query
def backend_lines(s, d):
    return export.backend_lines(v.scored(s, d)).groupBy("line").agg(F.count("*").alias("n"))


@query
def host_outcomes(s, d):
    r = v.scored(s, d).where(F.col("day") == v.last_day(s, d))
    return history.host_outcomes(r).select("host", "status", "accepted_count", "candidate_count", "rejected_count", "udp_status", "tcp_status", "reasons_signature")
