"""Registered queries of whole jobs: tables written through a sink and read back, the history, the corpus."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import schemas
from . import testviews as v
from .functions import text as t
from .operators import analyze, corpus, dedup, evaluate, export, history
from .operators.metrics import endpoint_metrics
from .operators.score import score
from .plans import pipelines
from .plans.lineage import checkpointed, new_folder
from .sources import documents, readers

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[f.__name__] = f
    return f


def text_of(c: str) -> Column:
    return F.col(c).cast("string").alias(c)


def joined(c: str) -> Column:
    return F.array_join(c, "|").alias(c)


@query
def history_upsert(s, d):
    """All runs, then again the first run of each day as one of the next day, with half of its endpoints."""
    base, last = new_folder(s, "history"), v.last_day(s, d)
    runs, status = checkpointed(v.runs(s, d).select("run_id", "run_date")), checkpointed(v.run_status(s, d))  # read by both jobs
    pipelines.update_history(s, base, runs, status, last, cut=True)
    moved = runs.where(F.col("run_id").endswith("-0") & (F.col("run_date") < last)).withColumn("run_date", F.date_add("run_date", 1))
    half = F.substring_index("resolver_key", "|", -1).cast("long") % 2 == 0
    pipelines.update_history(s, base, moved, status.where(half).join(moved.select("run_id"), "run_id", "left_semi"), last, cut=True)
    daily = readers.read_history(s, base, "daily")
    return daily.select(text_of("run_date"), "resolver_key", "host", "transport", "day_status", "runs", "successful_runs", "failed_runs", "flapped_within_day", "reasons_signature")


@query
def quarantine_step(s, d):
    """The state before the newest day, moved on by that day."""
    last = v.last_day(s, d)
    marked = history.rejected_streak(history.host_day(v.daily(s, d)), 1)
    before = history.quarantine_fold(history.host_day(v.daily(s, d).where(F.col("run_date") < last)), streak=1, days=3)
    out = history.quarantine_step(marked.where(F.col("run_date") == last), before, last, days=3)
    return out.select("host", text_of("first_quarantined_on"), text_of("last_quarantined_on"), text_of("retry_after"), "reasons_signature", "cycles")


@query
def candidates_round_trip(s, d):
    """Customers as candidates through the shard writer and back; every 50th line is cut short on its way."""
    path = new_folder(s, "candidates")
    c = v.table(s, d, "customer").select(
        F.col("c_name").alias("provider"), F.when(F.col("c_custkey") % 4 > 0, F.col("c_mktsegment")).alias("source"), v.transport_of(F.col("c_custkey")).alias("transport"),
        F.concat(F.lit("host-"), "c_custkey").alias("host"), F.when(F.col("c_custkey") % 5 > 0, F.col("c_nationkey").cast("int")).alias("port"), F.create_map(F.lit("segment"), "c_mktsegment").alias("metadata"),
    )
    export.write_shards(export.assign_shards(c, 5, ["provider"]), path)
    broken = c.where(F.length("provider") > 0).where(F.substring("provider", -2, 2).isin("00", "50")).select(F.concat(F.lit('{"provider": "'), "provider").alias("value"))
    broken.write.text(f"{path}/broken")
    kept = readers.read_candidates(s, path, lines=True)
    good = kept.select("provider", "source", "transport", "host", "port", F.col("metadata")["segment"].alias("segment"), F.size("bootstrap_ipv4").alias("n_bootstrap"))
    bad = readers.bad_lines(s, path, schemas.CANDIDATE).select(F.substring_index("value", '"', -1).alias("provider"))
    return good.unionByName(bad, allowMissingColumns=True)


@query
def filtered_round_trip(s, d):
    path = new_folder(s, "filtered")
    export.write_filtered(dedup.normalize_hosts(v.host_candidates(s, d))[1], path)
    return readers.read_filtered(s, path, lines=True).select(F.col("candidate.host").alias("host"), F.col("candidate.transport").alias("transport"), "reason", "detail", "stage")


@query
def results_round_trip(s, d):
    path = new_folder(s, "results")
    export.write_results(v.scored(s, d), path, ("accepted", "candidate", "rejected"))
    r = readers.read_results(s, path, lines=True)
    return r.select("host", "transport", "port", "status", "score", "correctness_score", "availability_score", "performance_score", "history_score", F.array_join(F.array_sort("reasons"), "|").alias("reasons"))


@query
def pruned_round_trip(s, d):
    """Probes of each endpoint and day; of rejected ones the failed probes only, and no list where all failed."""
    path, failed = new_folder(s, "pruned"), F.count_if(~F.col("ok"))
    p = v.probes(s, d).groupBy("endpoint", "day").agg(
        F.collect_list(F.struct("ok", F.concat(F.lit("p"), "seq").alias("probe"), "latency_ms", "error")).alias("probes"), failed.alias("_failed"), F.count("*").alias("_n")
    )
    status = F.when(F.col("_failed") == 0, "accepted").when(2 * F.col("_failed") <= F.col("_n"), "candidate").otherwise("rejected")
    key = F.concat_ws("/", F.col("endpoint").cast("string"), F.col("day").cast("string"))
    none = F.lit(None).cast("string")
    rows = p.select(key.alias("provider"), "probes", status.alias("status"), F.lit("dns-udp").alias("transport"), none.alias("endpoint_url"), key.alias("host"), F.lit(53).alias("port"), none.alias("path"))
    export.write_results(rows, path, ("accepted", "candidate", "rejected"), pruned=True)
    r = readers.read_results(s, path, lines=True)
    return r.select("provider", "status", F.size(F.coalesce("probes", F.array().cast(r.schema["probes"].dataType))).alias("n_probes"), F.size(F.filter("probes", lambda x: ~x["ok"])).alias("n_failed"), "all_probes_failed")


@query
def responder_lines(s, d):
    """Line items as lines of a responder, in several spellings; every seventh is broken or has no name."""
    li = v.table(s, d, "lineitem")
    no = F.col("l_orderkey") * 10 + F.col("l_linenumber")
    name = F.concat(F.lit("Q"), F.col("l_partkey").cast("string"))
    plain = F.to_json(F.struct(name.alias("name"), F.lit("ns").alias("type"), F.col("l_suppkey").cast("string").alias("resolver"), F.lower("l_linestatus").alias("status"), F.array(F.concat(F.lit("q. 60 IN NS "), "l_returnflag"), F.lit("last")).alias("answers")))
    other = F.to_json(F.struct(name.alias("qname"), F.col("l_suppkey").cast("string").alias("resolver_ip"), F.struct(F.lit("nxdomain").alias("rcode")).alias("data"), F.lit("late").alias("failure")))
    value = F.when(F.col("l_linenumber") < 5, plain).when(F.col("l_linenumber") < 7, other).when(F.col("l_partkey") % 2 == 0, F.concat(F.lit("{"), name)).otherwise('{"type": "A"}')
    good, bad = readers.read_responses(li.select(no.alias("line_no"), value.alias("value")))
    shown = good.select("line_no", "resolver", "qname", "rdtype", "rcode", joined("answers"), "error")
    return shown.unionByName(bad.select("line_no"), allowMissingColumns=True)


@query
def run_metadata_round_trip(s, d):
    path = new_folder(s, "metadata")
    late = F.concat(F.date_format("run_date", "yyyy-MM-dd"), F.when(F.col("run_id").endswith("-3"), "T23:30:00-02:00").otherwise("T23:30:00Z"))
    export.json_lines(v.runs(s, d).select(F.col("run_id").alias("github_run_id"), late.alias("generated_at"), F.lit("abc").alias("repo_sha"))).write.text(path)
    return readers.read_run_metadata(s, path, lines=True).select("github_run_id", "run_id", text_of("run_date"), F.date_format("generated_at", "yyyy-MM-dd HH:mm:ss").alias("generated_at"), "repo_sha")


def _listed(s, d) -> DataFrame:
    """Customers as lines of a host list: comments, blanks, ports, hosts with a space."""
    k, host = F.col("c_custkey") % 7, F.concat(F.lit("host-"), "c_custkey")
    line = F.when(k == 0, "# nothing").when(k == 1, "   ").when(k == 2, F.concat(host, F.lit(":5353 # odd port"))).when(k == 3, F.concat(F.lit("a "), host)).otherwise(host)
    return v.table(s, d, "customer").select(F.col("c_custkey").alias("ordinal"), line.alias("value"))


def _recorded(s, d) -> DataFrame:
    """Suppliers as records of URL endpoints."""
    k, host = F.col("s_suppkey"), F.concat(F.lit("H"), F.col("s_suppkey").cast("string"), F.lit(".example"))
    url = F.when(k % 3 == 0, F.concat(F.lit("https://"), host)).when(k % 3 == 1, F.concat(F.lit("http://"), host, F.lit("/q"))).otherwise(F.concat(F.lit("https://"), host, F.lit(":8443/p/q?x=1")))
    return v.table(s, d, "supplier").select(k.alias("ordinal"), F.when(k % 11 > 0, url).alias("url"), F.when(k % 2 == 0, F.col("s_name")).alias("provider"), F.col("s_nationkey").alias("nation"))


@query
def line_list(s, d):
    kept, out = readers.read_line_list(_listed(s, d))
    columns = ["ordinal", "host", "port", "transport", "source"]
    return kept.select(*columns).unionByName(out.select(*columns, "reason", "detail"), allowMissingColumns=True)


@query
def endpoint_records(s, d):
    r = readers.read_endpoint_records(_recorded(s, d))
    return r.select("ordinal", "provider", "transport", "endpoint_url", "host", "port", "path", "tls_server_name", F.col("metadata")["nation"].alias("nation"))


@query
def source_union(s, d):
    """All source types in order: hosts before URLs, whatever their place in the configuration."""
    lines, records = _listed(s, d), _recorded(s, d)
    kept, out = readers.read_sources([("lines", lines), ("lines", lines.where("ordinal % 2 = 0"), "second")], [("records", records)])
    shown = lambda df: df.groupBy(F.col("ordinal.source_no").alias("source_no"), "transport", "source")
    return shown(kept).agg(F.count("*").alias("n"), F.lit(True).alias("kept")).unionByName(shown(out).agg(F.count("*").alias("n"), F.lit(False).alias("kept")))


@query
def corpus_errors(s, d):
    """A corpus document a part, with one of twelve faults or none, held against the rules."""
    k = F.col("p_partkey") % 13
    probe = F.concat(
        F.lit('{"id": '), F.when(k == 1, "7").otherwise(F.concat(F.lit('"p'), "p_partkey", F.lit('"'))), F.lit(', "kind": "'), F.when(k == 2, "odd").otherwise("positive_exact"), F.lit('", "qtype": "A", "expected_mode": "'),
        F.when(k == 3, "odd").otherwise("exact_rrset"), F.lit('"'), F.when(k == 4, "").otherwise(', "qname": "q."'), F.when(k == 5, "").when(k == 6, ', "expected_answers": [1]').otherwise(', "expected_answers": ["a"]'),
        F.when(k == 7, ', "stability_score": "high"').otherwise(', "stability_score": 1.0'), F.when(k == 8, ', "size": 1').otherwise(""), F.lit("}"),
    )
    head = F.concat(F.lit('{"schema_version": '), F.when(k == 9, '"2"').otherwise("2"), F.lit(', "corpus_version": "'), "p_name", F.lit('", "generated_at": "now"'), F.when(k == 10, "").otherwise(', "generator_version": "g"'))
    document = F.concat(head, F.when(k == 11, ', "sources_used": []').otherwise(', "sources_used": ["s"]'), F.lit(', "probe_counts": {"positive_exact": 1}, "probes": ['), probe, F.when(k == 12, "").otherwise("]}"))
    raw = v.table(s, d, "part").select(F.col("p_partkey").cast("string").alias("file"), document.alias("value"))
    return documents.corpus_errors(raw)


@query
def seed_errors(s, d):
    """A seed document a supplier, with one of seven faults or none."""
    k = F.col("s_suppkey") % 8
    host = F.concat(F.lit('{"hostname": '), F.when(k == 1, "null").otherwise(F.concat(F.lit('"'), "s_name", F.lit('"'))), F.lit(', "source": "s", "ipv4": '), F.when(k == 2, "null").otherwise('["192.0.2.1"]'), F.lit("}"))
    zone = F.concat(F.lit('{"zone": "z.", "source": "s", "nameservers": '), F.when(k == 3, "[]").otherwise('["ns."]'), F.lit(', "exact_hosts": ['), host, F.lit(", "), F.when(k == 4, "1").otherwise(host), F.lit("]}"))
    document = F.concat(
        F.lit('{"snapshot_version": '), F.when(k == 5, "1.5").otherwise("1"), F.lit(', "generated_at": "now", "sources_used": ["s"], "root_servers": '), F.when(k == 6, "{}").otherwise(F.concat(F.lit("["), host, F.lit("]"))),
        F.when(k == 7, "").otherwise(F.concat(F.lit(', "delegations": ['), zone, F.lit("]"))), F.lit("}"),
    )
    return documents.seed_errors(v.table(s, d, "supplier").select(F.col("s_suppkey").cast("string").alias("file"), document.alias("value")))


ZONE_CAP, FAMILY_CAP = 5, 4
HEADER = {"schema_version": 2, "corpus_version": "1", "generated_at": "now", "generator_version": "g", "sources_used": ["tables"]}


def _seeds(s, d) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(roots, delegations, parent zones): nations are roots, twenty suppliers a delegation, brands the parent zones."""
    n = v.table(s, d, "nation").select(
        F.col("n_nationkey").alias("position"), F.concat("n_nationkey", F.lit(".root.")).alias("hostname"), F.array(F.concat(F.lit("192.0.2."), "n_nationkey")).alias("ipv4"),
        F.when(F.col("n_nationkey") % 2 == 0, F.array(F.concat(F.lit("2001:db8::"), "n_nationkey"))).alias("ipv6"), F.lit("nations").alias("source"), F.lit(None).cast("string").alias("notes"),
        F.concat(F.lit("r"), F.col("n_regionkey").cast("string")).alias("operator_family"),
    )
    k = F.col("s_suppkey")
    host = F.struct(
        k.alias("k"), F.concat(k.cast("string"), F.lit(".H.")).alias("hostname"), F.array(F.concat(F.lit("10.0.0."), (k % 250).cast("string")), F.lit("10.0.0.1")).alias("ipv4"),
        F.when(k % 3 == 0, F.array(F.concat(F.lit("2001:db8::"), k.cast("string")))).alias("ipv6"), F.lit(None).cast("string").alias("source"), F.lit(None).cast("string").alias("notes"),
        F.when(k % 4 > 0, F.concat(F.lit("f"), (k % 9).cast("string"))).alias("operator_family"),
    )
    zones = v.table(s, d, "supplier").groupBy(F.floor(k / 20).alias("position")).agg(F.array_sort(F.collect_list(host)).alias("exact_hosts"))
    zone = F.concat(F.lit("Z"), F.col("position").cast("string"), F.lit("."))
    delegations = zones.select("position", zone.alias("zone"), F.array(F.concat(F.lit("ns."), zone)).alias("nameservers"), F.lit("suppliers").alias("source"), F.lit(None).cast("string").alias("notes"), "exact_hosts")
    brands = v.table(s, d, "part").select(F.concat(F.replace(F.lower("p_brand"), F.lit("#"), F.lit("-")), F.lit(".")).alias("zone")).distinct()
    return n, delegations, brands


def _answered(asked: DataFrame) -> DataFrame:
    """Answers of a baseline by the number in the probe's id, with timeouts, wrong answers and disagreement."""
    number = F.regexp_extract("id", "([0-9]+)", 1).cast("int")
    turn = F.col("round") * 6 + F.col("check_no") * 2 + F.when(F.col("resolver") == "b", 1).otherwise(0)
    late = (number + turn) % 7 == 0
    wrong = (number % 11 == 3) & (turn == 1)
    right = F.coalesce("expected_answers", "expected_nameservers", F.array().cast("array<string>"))
    negative = F.col("kind") == "negative_generated"
    rcode = F.when(negative, F.when(wrong, "NOERROR").otherwise("NXDOMAIN")).otherwise("NOERROR")
    answers = F.when(negative, F.array().cast("array<string>")).otherwise(F.when(wrong, F.array(F.lit("other."))).otherwise(F.reverse(right)))
    return asked.select("id", "check_no", turn.alias("seq"), F.when(~late, rcode).alias("rcode"), F.when(~late, answers).alias("answers"), F.when(late, "timed out").alias("error"))


def _generated(s, d) -> tuple[DataFrame, DataFrame]:
    """(candidates, observations) of the whole chain: seeds, quota, baseline plan, answers."""
    roots, delegations, zones = _seeds(s, d)
    made = corpus.exact_probes(roots, delegations, ZONE_CAP, FAMILY_CAP).unionByName(corpus.consensus_probes(delegations), allowMissingColumns=True).unionByName(corpus.negative_probes(zones), allowMissingColumns=True)
    made = checkpointed(made)
    plan = corpus.baseline_plan(made.select("id", "kind", "qname", "qname_template"), ["a", "b"])
    return made, _answered(plan.join(made.select("id", "expected_answers", "expected_nameservers"), "id"))


@query
def exact_probes(s, d):
    roots, delegations, _ = _seeds(s, d)
    p = corpus.exact_probes(roots, delegations, ZONE_CAP, FAMILY_CAP)
    return p.select("id", "qname", "qtype", joined("expected_answers"), "source", "stability_score")


@query
def baseline_plan(s, d):
    """How often each kind of probe is asked, and of whom."""
    roots, delegations, zones = _seeds(s, d)
    made = corpus.consensus_probes(delegations).select("id", "kind", "qname").unionByName(corpus.negative_probes(zones).select("id", "kind", "qname_template"), allowMissingColumns=True)
    return corpus.baseline_plan(made, ["a", "b"])


@query
def corpus_build(s, d):
    """The corpus as it is read back from its document."""
    made, seen = _generated(s, d)
    path = new_folder(s, "corpus")
    voted = checkpointed(corpus.apply_agreed(corpus.vote(made, seen)))
    kept = voted.where("accepted").withColumn("position", F.dense_rank().over(_by_id()) - 1)
    export.write_corpus(kept, corpus.generation_report(voted), path, HEADER)
    probes, _ = readers.read_corpus(s, f"{path}/probe-corpus", 2)
    return probes.select("id", "kind", "qname", "qname_template", "qtype", "expected_mode", joined("expected_answers"), joined("expected_nameservers"), "parent_zone", "source", "stability_score", F.col("position").cast("long").alias("position"))


def _by_id():
    from pyspark.sql.window import Window

    return Window.orderBy("id")


@query
def corpus_report(s, d):
    made, seen = _generated(s, d)
    return corpus.generation_report(corpus.vote(made, seen))


@query
def vote_trail(s, d):
    made, seen = _generated(s, d)
    return corpus.vote_trail(seen, corpus.vote(made, seen))


@query
def logic_errors(s, d):
    """Parts as probes: unknown kinds, kinds and modes that differ, negatives without a parent, ids that repeat."""
    k = F.col("p_partkey") % 10
    p = v.table(s, d, "part").select(
        F.when(k == 0, F.concat(F.lit("twice-"), F.floor(F.col("p_partkey") / 20).cast("string"))).otherwise(F.concat(F.lit("p"), F.col("p_partkey").cast("string"))).alias("id"), F.col("p_partkey").alias("part"),
        F.when(k == 1, "odd").when(k < 5, "positive_exact").when(k < 7, "positive_consensus").otherwise("negative_generated").alias("kind"),
        F.when(k < 5, "exact_rrset").when(k == 5, "nxdomain").when(k == 6, "consensus_match").otherwise("nxdomain").alias("expected_mode"), F.when(k == 9, "z.").alias("parent_zone"),
    )
    return corpus.logic_errors(p).select("part", joined("errors"))


@query
def duplicate_ids(s, d):
    return dedup.duplicate_ids(v.table(s, d, "lineitem").select(F.concat_ws("-", "l_partkey", "l_suppkey").alias("id")), "id")


@query
def distinct_resolvers(s, d):
    return dedup.distinct_resolvers(v.scored(s, d))


@query
def ordered_exports(s, d):
    """Shard numbers of three sort orders: that of endpoints, of filtered rows, and of batches before the rest."""
    r = v.scored(s, d).select("endpoint", "day", "transport", "host", "port", F.concat(F.coalesce("endpoint_url", F.lit("")), F.lit("/"), "endpoint", F.lit("/"), F.col("day").cast("string")).alias("endpoint_url"), "path")
    f = r.withColumns({"stage": F.when(F.col("endpoint") % 2 == 0, "source").otherwise("normalize"), "reason": F.concat(F.lit("r"), (F.col("endpoint") % 3).cast("string"))})
    one = lambda df, order, name: export.assign_shards(df, 17, order).select("endpoint", text_of("day"), F.col("shard"), F.lit(name).alias("order_name"))
    return one(r, t.endpoint_order(), "endpoint").unionByName(one(r, t.priority_order(), "priority")).unionByName(one(f, t.filtered_order(), "filtered"))


@query
def endpoint_texts(s, d):
    """Display texts, shortened errors, quarantine details; filters by status and transport."""
    r = v.scored(s, d).where(t.by_status("accepted", "rejected") & t.by_transport("dns-udp", "doh"))
    shown = t.display(F.col("transport"), F.col("host"), F.col("port"), F.col("endpoint_url"))
    error = t.error_text("error:", F.repeat(F.concat("host", F.lit(" failed; ")), 20))
    return r.select("endpoint", text_of("day"), shown.alias("display"), error.alias("error"), t.quarantine_detail(F.date_add("day", 90), F.array_sort("reasons")).alias("detail"))


@query
def transport_errors(s, d):
    """Texts of failed exchanges, of plain transports and of URLs."""
    li = v.table(s, d, "lineitem")
    kind = F.element_at(F.array(*[F.lit(k) for k in ("timeout", "http", "tls_name", "tls", "connect", "odd")]), (F.col("l_linenumber") % 6 + 1).cast("int"))
    code = F.when(F.col("l_partkey") % 9 > 0, F.col("l_partkey") % 600)
    e = li.select("l_orderkey", "l_linenumber", kind.alias("kind"), F.concat("l_linestatus", F.lit(" refused")).alias("text"), code.alias("code"))
    return e.select("l_orderkey", "l_linenumber", evaluate.transport_error(False, F.col("kind"), F.col("text"), F.col("code")).alias("url_error"), evaluate.transport_error(True, F.col("kind"), F.col("text")).alias("plain_error"))


@query
def score_reliability(s, d):
    """Scores with the transport and the source's reliability known, or no number, or missing."""
    m = endpoint_metrics(v.probes(s, d), ["endpoint", "day"])
    k = F.col("endpoint") % 10
    m = m.withColumns({"transport": v.transport_of(F.col("endpoint")), "reliability": F.when(k == 0, "odd").when(k > 2, ((k + 1) / 11).cast("string"))})
    out = score(m)
    return out.select("endpoint", text_of("day"), "score", "status", "confidence_score", F.array_join(F.array_sort("reasons"), "|").alias("reasons"), F.array_join(F.array_sort("score_caps_applied"), "|").alias("caps"))


@query
def compare_shares(s, d):
    r, half = v.scored(s, d), F.date_sub(v.last_day(s, d), 14)
    top = r.withColumn("score", F.when(F.col("score") >= 85, 100).otherwise(F.col("score")))
    out = analyze.compare_shares(top.where(F.col("day") < half), top.where(F.col("day") >= half))
    return out.select(*[F.round(c, 9).alias(c) for c in ("old_share", "new_share", "change")])


@query
def key_sketches(s, d):
    """Distinct keys of each transport over three windows: exact, and whether the stored daily sketches come within four standard errors."""
    daily, last = v.daily(s, d), v.last_day(s, d)
    sketches = analyze.key_sketches(daily)
    out = None
    for days in (7, 14, 30):
        exact = daily.where((F.col("run_date") <= last) & (F.col("run_date") > F.date_sub(last, days))).groupBy("transport").agg(F.count_distinct("resolver_key").alias("n_keys"))
        about = analyze.approximate_keys(sketches, last, days).withColumnRenamed("n_keys", "about")
        both = exact.join(about, "transport", "full_outer")
        close = F.abs(F.col("about") - F.col("n_keys")) <= F.greatest(F.lit(1.0), 4 * 1.04 / 64 * F.col("n_keys"))
        one = both.select("transport", F.lit(days).alias("days"), "n_keys", close.alias("close"))
        out = one if out is None else out.unionByName(one)
    return out


@query
def normal_forms(s, d):
    """Addresses and answers in canonical form, keys of plain endpoints built and parsed again."""
    k = F.col("c_custkey")
    long = F.concat(F.lit(" 2001:0DB8:0:0000:0:0:0:"), F.lower(F.hex(k % 60000)))
    host = F.when(k % 4 == 0, F.concat(F.lit("2001:db8::x"), k.cast("string"))).otherwise(long)
    key = t.resolver_key(v.transport_of(k % 2), F.col("c_name"), F.when(k % 3 > 0, F.col("c_nationkey").cast("int")), F.lit(None).cast("string"))
    names = F.array(F.concat("c_name", F.lit(".Z..")), F.lit("A"), F.lit("a."))
    rows = v.table(s, d, "customer").select(
        "c_custkey", t.normalize_ip(host).alias("address"), key.alias("key"), t.parse_key(key).alias("p"),
        F.array_join(t.normalize_answers(names, F.when(k % 2 == 0, "NS").otherwise("TXT")), " ").alias("answers"),
    )
    return rows.select("c_custkey", "address", "key", F.col("p.transport").alias("transport"), F.col("p.host").alias("host"), F.col("p.port").alias("port"), "answers")


@query
def discover_candidates(s, d):
    """Hosts and page URLs as two sources: what is kept, and why the rest isn't."""
    hosts = v.host_candidates(s, d).withColumn("source", F.lit("customers"))
    urls = v.url_candidates(s, d).withColumns({"source": F.lit("pages"), "transport": F.lit("doh")})
    kept, out = pipelines.discover([(hosts, None), (urls, None)])
    columns = ["source", "transport", "host", "port", "endpoint_url"]
    return kept.select(*columns, F.lit(None).cast("string").alias("reason")).unionByName(out.select(*columns, "reason"))


@query
def validate_candidates(s, d):
    """Suppliers as candidates: asked in two rounds, some answers lost, wrong or spoofed, then scored."""
    k = F.col("s_suppkey")
    candidates = v.table(s, d, "supplier").select(k.alias("candidate_id"), F.lit("dns-udp").alias("transport"))
    right = F.array(F.when(F.col("rdtype") == "NS", "right.").otherwise("right"))
    plan = evaluate.probe_plan(candidates, corpus.builtin_corpus(s), 2).withColumns(
        {"probe_id": F.concat_ws("-", "candidate_id", "seq"), "expected_mode": F.lit("exact_rrset"), "expected_answers": right}
    )
    c, nx = F.col("candidate_id"), F.col("kind") == "nxdomain"
    rcode = F.when(nx & (c % 7 != 1), "NXDOMAIN").otherwise("NOERROR")
    answers = F.when(~nx & (c % 5 == 2) & (F.col("seq") % 8 == 0), F.array(F.lit("wrong"))).otherwise(F.col("expected_answers"))
    seen = plan.where((c + F.col("seq")) % (c % 9 + 2) != 0).select("probe_id", rcode.alias("rcode"), answers.alias("answers"), F.lit(None).cast("string").alias("error"), ((c % 90) * 10 + F.col("seq")).cast("double").alias("latency_ms"))
    out = pipelines.validate(candidates, plan, seen)
    return out.select("candidate_id", "score", "status", "correctness_score", "availability_score", "performance_score", joined("reasons"))


def _materialized(s, d) -> tuple[str, DataFrame]:
    path, r = new_folder(s, "materialized"), v.scored(s, d)
    out = v.host_candidates(s, d)
    pipelines.materialize(checkpointed(r), dedup.normalize_hosts(out)[1], path, max_bytes=100_000)
    return path, r


@query
def materialized_formats(s, d):
    """Every format of the results, written and counted: results by status, lines of lists, filtered rows."""
    path, _ = _materialized(s, d)
    results = readers.read_results(s, f"{path}/results", lines=True).groupBy("status").agg(F.count("*").alias("n"), F.sum("score").alias("total"))
    out = results.select(F.concat(F.lit("results "), "status").alias("format"), "n", "total")
    for kind in ("text", "urls", "backends", "forwarders"):
        out = out.unionByName(s.read.text(f"{path}/{kind}").agg(F.lit(kind).alias("format"), F.count("*").alias("n"), F.lit(None).cast("long").alias("total")))
    filtered = readers.read_filtered(s, f"{path}/filtered", lines=True).groupBy("reason").agg(F.count("*").alias("n"))
    return out.unionByName(filtered.select(F.concat(F.lit("filtered "), "reason").alias("format"), "n", F.lit(None).cast("long").alias("total")))


@query
def parts_round_trip(s, d):
    """Results in parts beside each other, read as one."""
    path, r = new_folder(s, "parts"), v.scored(s, d)
    lines = export.json_lines(r.withColumn("part", F.col("endpoint") % 3)).withColumn("part", F.get_json_object("value", "$.part"))
    lines = checkpointed(lines)
    for k in range(3):
        lines.where(F.col("part") == str(k)).select("value").write.text(f"{path}/results.part-{k}.json")
    return readers.read_results_parts(s, f"{path}/results.json", lines=True).groupBy("host", "status").agg(F.count("*").alias("n"), F.sum("score").alias("total"))


@query
def quarantined_candidates(s, d):
    """Candidates of hosts in quarantine join those that were filtered before."""
    state = history.quarantine_fold(history.host_day(v.daily(s, d)), streak=2)
    rows = v.scored(s, d).select("endpoint", "day", "host", "transport")
    before = rows.where("endpoint % 10 = 0").select("*", F.lit("earlier").alias("reason"), F.lit(None).cast("string").alias("detail"), F.lit("source").alias("stage"))
    kept, out = pipelines.apply_quarantine(rows.where("endpoint % 10 > 0"), before, state, v.last_day(s, d))
    columns = ["endpoint", text_of("day"), "host", "transport"]
    return kept.select(*columns).unionByName(out.select(*columns, "reason", "detail", "stage"), allowMissingColumns=True)


@query
def score_reports(s, d):
    """All reports on scores as one table."""
    r = pipelines.score_report(checkpointed(v.scored(s, d)))
    one = lambda name, key, n: r[name].select(F.lit(name).alias("report"), key.cast("string").alias("key"), n.cast("double").alias("n"))
    rows = [
        one("bands", F.col("band"), F.col("accepted")), one("histogram", F.col("score"), F.col("n")), one("reasons", F.concat_ws(" ", "band", "reason"), F.col("n")),
        one("averages", F.col("band"), F.round("avg_p95", 6)), one("confidence", F.lit("mean"), F.round("mean_confidence", 6)), one("caps", F.col("cap"), F.col("n")),
    ]
    return dedup.union_all(rows)


@query
def history_reports(s, d):
    """All reports on the history as one table."""
    daily, last = v.daily(s, d), v.last_day(s, d)
    r = pipelines.history_report(daily, history.stability_metrics(daily, last), last)
    one = lambda name, key, n: r[name].select(F.lit(name).alias("report"), key.cast("string").alias("key"), n.alias("n"))
    return dedup.union_all([one("transports", F.col("transport"), F.col("n_keys")), one("depth", F.col("days"), F.col("n_keys")), one("capped", F.lit("capped"), F.col("capped"))])


@query
def corpus_generated(s, d):
    """The generation job from seeds and answers to its report."""
    roots, delegations, zones = _seeds(s, d)
    made = checkpointed(corpus.exact_probes(roots, delegations).unionByName(corpus.consensus_probes(delegations), allowMissingColumns=True).unionByName(corpus.negative_probes(zones), allowMissingColumns=True))
    plan = corpus.baseline_plan(made.select("id", "kind", "qname", "qname_template"), ["a", "b"])
    seen = _answered(plan.join(made.select("id", "expected_answers", "expected_nameservers"), "id"))
    kept, report = pipelines.generate_corpus(roots, delegations, zones, seen)
    by_kind = kept.groupBy("kind").agg(F.count("*").alias("n")).select("kind", F.lit("kept").alias("rejection_reason"), "n")
    return report.where("rejection_reason is not null").unionByName(by_kind)


@query
def corpus_validation(s, d):
    """Probes of a corpus that break a rule, after the gates of least probes a kind."""
    k = F.col("p_partkey") % 10
    p = v.table(s, d, "part").select(
        F.concat(F.lit("p"), F.floor(F.col("p_partkey") / F.when(k == 3, 40).otherwise(1)).cast("string"), F.when(k == 3, "x").otherwise("")).alias("id"), F.col("p_partkey").alias("part"),
        F.when(k == 1, "odd").when(k < 5, "positive_exact").when(k < 7, "positive_consensus").otherwise("negative_generated").alias("kind"),
        F.when(k < 5, "exact_rrset").when(k < 7, "consensus_match").otherwise("nxdomain").alias("expected_mode"), F.when(k != 8, "z.").alias("parent_zone"),
    )
    return pipelines.validate_corpus(p).select("part", joined("errors"))
