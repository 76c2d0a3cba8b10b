"""User-level jobs and document readers, end to end on small inputs."""

import datetime
import json

import pytest
from endpointlens.operators import corpus, evaluate, export, history
from endpointlens.operators.score import HISTORY
from endpointlens.plans import pipelines
from endpointlens.sources import readers
from pyspark.sql import functions as F

SEEDS = {
    "snapshot_version": 1, "generated_at": "2024-01-01T00:00:00Z", "sources_used": ["s"],
    "root_servers": [{"hostname": f"{c}.root.", "ipv4": [f"192.0.2.{k}"], "ipv6": [f"2001:db8::{k}"], "source": "s", "operator_family": "f"} for k, c in enumerate("abc", 1)],
    "delegations": [{"zone": f"{z}.", "nameservers": [f"ns.{z}."], "source": "d", "exact_hosts": [{"hostname": f"h{k}.{z}.", "ipv4": [f"198.51.100.{k}"], "ipv6": []} for k in range(5)]} for z in ("com", "org", "net")],
}


@pytest.fixture(scope="module")
def seeds(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("seeds") / "seeds.json"
    path.write_text(json.dumps(SEEDS))
    *found, errors = readers.read_seeds(spark, str(path))
    assert [(r["path"], r["field"]) for r in errors.where("error not like '%source%'").collect() if r["field"] != "source"] == []
    return found


def test_exact_probes_respect_both_caps(seeds):
    rows = corpus.exact_probes(*seeds).collect()
    assert [r["id"] for r in sorted(rows, key=lambda r: r["id"]) if "root" in r["id"]] == ["positive-exact-a-root-a", "positive-exact-a-root-aaaa", "positive-exact-b-root-a"]
    assert len(rows) == 3 + 3 * 3 and {r["expected_mode"] for r in rows} == {"exact_rrset"}


def test_generated_corpus(spark, seeds):
    zones = spark.createDataFrame([("com.",), ("org.",), ("net.",)], "zone string")
    made = corpus.exact_probes(*seeds).unionByName(corpus.consensus_probes(seeds[1]), allowMissingColumns=True).unionByName(corpus.negative_probes(zones), allowMissingColumns=True)
    plan = corpus.baseline_plan(made.select("id", "kind", "qname", "qname_template"), ["r1", "r2"])
    counts = {r["kind"]: r["count"] for r in plan.groupBy("kind").count().collect()}
    assert counts == {"positive_exact": 12 * 4, "positive_consensus": 3 * 4, "negative_generated": 3 * 3 * 3 * 2}
    known = made.select("id", "expected_answers", "expected_nameservers")
    bad = F.col("id") == "negative-generated-org-a"
    seen = plan.join(known, "id").select(
        "id", "check_no", (F.col("round") * 2 + F.col("check_no")).alias("seq"), F.when((F.col("kind") == "negative_generated") & ~bad, "NXDOMAIN").otherwise("NOERROR").alias("rcode"),
        F.coalesce("expected_answers", "expected_nameservers", F.array().cast("array<string>")).alias("answers"), F.lit(None).cast("string").alias("error"),
    )
    kept, report = pipelines.generate_corpus(*seeds, zones, seen)
    assert kept.count() == 17
    assert {(r["kind"], r["rejection_reason"]): r["n"] for r in report.collect()}["negative_generated", "negative_parent_wildcard_like"] == 1
    assert pipelines.validate_corpus(kept, {"positive_exact": 6, "positive_consensus": 3, "negative_generated": 2}).count() == 0


def test_validate_scores_missing_answers_as_failures(spark):
    candidates = spark.createDataFrame([(1, "dns-udp", "192.0.2.1", 53), (2, "dns-udp", "192.0.2.2", 53)], "candidate_id long, transport string, host string, port int")
    plan = evaluate.probe_plan(candidates, corpus.builtin_corpus(spark), 2).withColumns(
        {"probe_id": F.concat_ws("-", "candidate_id", "seq"), "expected_mode": F.lit("exact_rrset"), "expected_answers": F.array(F.lit("192.0.2.9"))}
    )
    seen = plan.where("candidate_id = 1").select(
        "probe_id", F.when(F.col("kind") == "nxdomain", "NXDOMAIN").otherwise("NOERROR").alias("rcode"), F.array(F.when(F.col("rdtype") == "NS", "192.0.2.9.").otherwise("192.0.2.9")).alias("answers"),
        F.lit(None).cast("string").alias("error"), F.lit(20.0).alias("latency_ms"),
    )
    rows = {r["candidate_id"]: r for r in pipelines.validate(candidates, plan, seen).collect()}
    assert rows[1]["status"] == "accepted" and rows[1]["score"] == 90 and rows[2]["status"] == "rejected"
    assert rows[2]["reasons"] == ["timeout_or_error", "timeout_rate_high", "no_latency_samples"]


def test_documents(spark, tmp_path):
    good = {"schema_version": 2, "corpus_version": "1", "generated_at": "x", "generator_version": "g", "sources_used": ["s"], "probe_counts": {"positive_consensus": 1}, "probes": [{"id": "p", "kind": "positive_consensus", "qname": "q.", "qtype": "NS", "expected_mode": "baseline_match"}]}
    (tmp_path / "good.json").write_text(json.dumps(good))
    (tmp_path / "bad.json").write_text(json.dumps({"corpus_version": "1", "probes": [], "surprise": 1}))
    probes, errors = readers.read_corpus(spark, str(tmp_path / "good.json"), 2)
    assert probes.first()["expected_mode"] == "consensus_match" and errors.count() == 0
    found = sorted((r["field"], r["error"]) for r in readers.read_corpus(spark, str(tmp_path / "bad.json"), 2)[1].collect())
    assert found == [("", "unsupported fields: surprise"), ("generated_at", "missing or invalid string field"), ("schema_version", "missing or invalid integer field")]
    (tmp_path / "c.json").write_text(json.dumps([{"transport": "doh", "host": "h"}]))
    c = readers.read_candidates(spark, str(tmp_path / "c.json")).first()
    assert (c["source"], c["metadata"], c["bootstrap_ipv4"]) == ("loaded", {}, [])
    (tmp_path / "r.json").write_text(json.dumps([{"host": "h", "status": "rejected", "availability_score": 7, "score_breakdown": {"correctness": 40}, "probes": [{"ok": False}]}]))
    r = readers.read_results_parts(spark, str(tmp_path / "r*.json")).first()
    assert (r["correctness_score"], r["availability_score"], r["history_score"]) == (40, 7, 0)
    (tmp_path / "run.json").write_text(json.dumps({"generated_at": "2024-01-02T23:30:00-02:00", "github_run_id": "9"}))
    assert str(readers.read_run_metadata(spark, str(tmp_path / "run.json")).first()["run_date"]) == "2024-01-03"
    (tmp_path / "f.json").write_text(json.dumps([{"candidate": {"host": "h", "metadata": {"a": "b"}}, "reason": "x", "stage": "source"}]))
    assert readers.read_filtered(spark, str(tmp_path / "f.json")).first()["candidate"]["metadata"] == {"a": "b"}
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        readers.read_results_parts(spark, str(tmp_path / "none*.json")).count()


def test_history_update_is_repeatable(spark, tmp_path):
    base, day = str(tmp_path / "history"), F.lit("2024-02-01").cast("date")
    runs = spark.createDataFrame([("r1",), ("r2",)], "run_id string").withColumns({"run_date": day, "run_started_at": F.current_timestamp()})
    status = spark.createDataFrame(
        [("r1", "k1", "h", "dns-udp", "accepted", []), ("r2", "k1", "h", "dns-udp", "rejected", ["answer_mismatch"]), ("r1", "k2", "h2", "dns-tcp", "candidate", []), ("r2", "k2", "h2", "dns-tcp", "accepted", ["x"])],
        "run_id string, resolver_key string, host string, transport string, status string, reasons array<string>",
    ).withColumns({"run_date": day, **{c: F.lit(1.0) for c in ("p50_latency_ms", "p95_latency_ms", "jitter_ms")}})
    for _ in range(2):
        pipelines.update_history(spark, base, runs, status, day)
    daily = readers.read_history(spark, base, "daily")
    assert sorted((r["resolver_key"], r["day_status"], r["flapped_within_day"]) for r in daily.collect()) == [("k1", "rejected", True), ("k2", "accepted", True)]
    metrics = history.stability_metrics(daily, day)
    assert set(HISTORY) <= set(metrics.columns) and metrics.count() == 2
    report = pipelines.history_report(daily, metrics, day)
    assert report["capped"].first()["capped"] == 1 and report["transports"].count() == 2


def test_history_over_days(spark, tmp_path):
    """Two runs of a day in two calls, repeats, days past the retention, fourteen rejected days."""
    base, first = str(tmp_path / "h"), datetime.date(2024, 1, 1)

    def put(n, run, status, host="192.0.2.9"):
        day = F.lit(first + datetime.timedelta(days=n)).cast("date")
        runs = spark.createDataFrame([(run,)], "run_id string").withColumn("run_date", day)
        rows = [(run, f"k-{host}", host, "dns-udp", status, ["timeout"])]
        made = spark.createDataFrame(rows, "run_id string, resolver_key string, host string, transport string, status string, reasons array<string>")
        pipelines.update_history(spark, base, runs, made.withColumns({c: F.lit(1.0) for c in ("p50_latency_ms", "p95_latency_ms", "jitter_ms")}), day)

    put(0, "old", "accepted")
    for n in range(28, 42):
        put(n, f"r{n}", "rejected")
    put(41, "r41", "rejected")  # again
    daily = readers.read_history(spark, base, "daily")
    assert daily.count() == 14 and daily.agg(F.min("run_date")).first()[0] == first + datetime.timedelta(days=28)
    q = readers.read_history(spark, base, "quarantine").collect()
    assert [(r["host"], r["cycles"], r["retry_after"]) for r in q] == [("192.0.2.9", 1, first + datetime.timedelta(days=131))]
    put(42, "a", "accepted", "192.0.2.1")
    put(42, "b", "rejected", "192.0.2.1")
    row = readers.read_history(spark, base, "daily").where("host = '192.0.2.1'").first()
    assert (row["runs"], row["day_status"], row["flapped_within_day"]) == (2, "candidate", True)
    assert readers.read_history(spark, base, "quarantine").count() == 1


def test_unknown_kinds_raise(spark, tmp_path):
    from endpointlens.operators import corpus

    with pytest.raises(ValueError):
        corpus.build_corpus(spark, "bogus")
    with pytest.raises(ValueError):
        readers.read_source("bogus")
    (tmp_path / "x.part-1.json").write_text('[{"host": "h", "status": "accepted"}]')
    (tmp_path / "x.part-2.json").write_text('[{"host": "i", "status": "rejected"}]')
    assert readers.read_results_parts(spark, str(tmp_path / "x.json")).count() == 2


def test_exports(spark, tmp_path):
    rows = [("accepted", "dns-udp", None, "192.0.2.1", 53, None, 1), ("accepted", "doh", "https://h/dns-query", "h", 443, "/dns-query", 2), ("rejected", "dns-udp", None, "192.0.2.3", 53, None, 3)]
    r = spark.createDataFrame(rows, "status string, transport string, endpoint_url string, host string, port int, path string, ordinal int").withColumn("tls_server_name", F.lit(None).cast("string"))
    assert [x["line"] for x in pipelines.export_format(r, "urls").collect()] == ["https://h/dns-query"]
    assert pipelines.export_format(r, "json").count() == 2
    assert 'subjectName="h"' in [x["line"] for x in pipelines.export_format(r, "backends").collect()][1]
    export.write_results(r, str(tmp_path / "out"), ("accepted", "rejected"), max_bytes=200)
    assert spark.read.text(str(tmp_path / "out")).groupBy("status", "part").count().count() == 3
    manifest = pipelines.split_candidates(r.select("transport", "endpoint_url", "host", "port", "path"), 2, str(tmp_path / "shards"))
    assert [(m["shard"], m["n"]) for m in manifest.collect()] == [(0, 2), (1, 1)]


def test_build_and_write(spark, seeds, tmp_path):
    zones = spark.createDataFrame([("com.",), ("org.",), ("net.",)], "zone string")
    made = corpus.exact_probes(*seeds).unionByName(corpus.consensus_probes(seeds[1]), allowMissingColumns=True).unionByName(corpus.negative_probes(zones), allowMissingColumns=True)
    plan = corpus.baseline_plan(made.select("id", "kind", "qname", "qname_template"), ["r1", "r2"])
    seen = plan.join(made.select("id", "expected_answers", "expected_nameservers"), "id").select(
        "id", "check_no", (F.col("round") * 2 + F.col("check_no")).alias("seq"), F.when(F.col("kind") == "negative_generated", "NXDOMAIN").otherwise("NOERROR").alias("rcode"),
        F.coalesce("expected_answers", "expected_nameservers", F.array().cast("array<string>")).alias("answers"), F.lit(None).cast("string").alias("error"),
    )
    header = {"schema_version": 2, "corpus_version": "7", "generated_at": "now", "generator_version": "g", "sources_used": ["s"]}
    placed = pipelines.build_and_write(*seeds, zones, seen, str(tmp_path / "c"), header)
    assert placed.count() == 18
    text = "".join(f.read_text() for f in (tmp_path / "c" / "probe-corpus").glob("*.txt"))
    document = json.loads(text)
    assert document["probe_counts"] == {"positive_exact": 12, "positive_consensus": 3, "negative_generated": 3} and document["corpus_version"] == "7"
    assert [p["kind"] for p in document["probes"]] == ["positive_exact"] * 12 + ["positive_consensus"] * 3 + ["negative_generated"] * 3
    probes, errors = readers.read_corpus(spark, str(tmp_path / "c" / "probe-corpus"), 2)
    assert probes.count() == 18 and errors.count() == 0
    facts = json.loads("".join(f.read_text() for f in (tmp_path / "c" / "metadata").glob("*.txt")))
    assert facts["accepted_counts"] == document["probe_counts"] and facts["rejected_by_reason"] == {}
    with pytest.raises(ValueError):
        pipelines.build_and_write(*seeds, zones, seen, str(tmp_path / "d"), header, minimums={"positive_exact": 99})


def test_agreed_answers_are_written_back(spark):
    probes = spark.createDataFrame([("e", "positive_exact", "A", ["192.0.2.9", "192.0.2.1"], None), ("n", "positive_exact", "NS", ["B.", "a"], None), ("c", "positive_consensus", "NS", None, ["old."])], "id string, kind string, qtype string, expected_answers array<string>, expected_nameservers array<string>")
    rows = [(i, s, 0, "NOERROR", a, None) for i, answers in (("e", ["192.0.2.1", "192.0.2.9"]), ("n", ["A.", "b"]), ("c", ["new.", "also."])) for s, a in enumerate([answers, answers[::-1]])]
    seen = spark.createDataFrame(rows, "id string, seq int, check_no int, rcode string, answers array<string>, error string")
    voted = corpus.apply_agreed(corpus.vote(probes, seen))
    got = {r["id"]: (r["accepted"], r["expected_answers"], r["expected_nameservers"]) for r in voted.collect()}
    assert got == {"e": (True, ["192.0.2.1", "192.0.2.9"], None), "n": (True, ["a.", "b."], None), "c": (True, None, ["also.", "new."])}
    trail = {r["id"]: (r["asked"], r["failed"], r["agreed"]) for r in corpus.vote_trail(seen, voted).collect()}
    assert trail == {"e": (2, 0, None), "n": (2, 0, None), "c": (2, 0, "also.,new.")}


def test_refresh_and_materialize(spark, tmp_path):
    """Discovery to files in one go: a host that answers, one that doesn't, a URL, rejects on the way."""
    lines = spark.createDataFrame([(0, "192.0.2.1"), (1, "192.0.2.2"), (2, "192.0.2.1"), (3, "192.0.2.999")], "ordinal int, value string")
    records = spark.createDataFrame([(0, "https://dns.example/q"), (1, "ftp://x")], "ordinal int, url string")

    def plan(candidates):
        made = evaluate.probe_plan(candidates, corpus.builtin_corpus(spark), 2)
        return made.withColumns({"probe_id": F.concat_ws("-", "candidate_id", "seq"), "expected_mode": F.lit("exact_rrset"), "expected_answers": F.array(F.lit("192.0.2.9"))})

    def answers(made):
        hosts = made.where("transport <> 'dns-tcp'").select("probe_id", "rdtype", "kind", "candidate_id")
        alive = hosts.join(hosts.groupBy().agg(F.min("candidate_id").alias("_least")), F.col("candidate_id") == F.col("_least"))
        return alive.select(
            "probe_id", F.when(F.col("kind") == "nxdomain", "NXDOMAIN").otherwise("NOERROR").alias("rcode"), F.array(F.when(F.col("rdtype") == "NS", "192.0.2.9.").otherwise("192.0.2.9")).alias("answers"),
            F.lit(None).cast("string").alias("error"), F.lit(20.0).alias("latency_ms"),
        )

    sources = [readers.read_source("lines", lines), readers.read_source("records", records)]
    results, rejected = pipelines.refresh(sources, plan, answers)
    rows = results.collect()
    assert sorted((r["transport"], r["host"]) for r in rows) == [("dns-tcp", "192.0.2.1"), ("dns-tcp", "192.0.2.2"), ("dns-udp", "192.0.2.1"), ("dns-udp", "192.0.2.2"), ("doh", "dns.example")]
    assert [r["status"] for r in rows].count("accepted") == 1
    assert sorted({r["reason"] for r in rejected.collect()}) == ["duplicate_dns_candidate", "invalid_dns_host", "invalid_doh_url"]
    pipelines.materialize(results, rejected, str(tmp_path / "out"), max_bytes=4000)
    back = readers.read_results(spark, str(tmp_path / "out" / "results"), lines=True)
    assert sorted((r["host"], r["status"], r["score"]) for r in back.collect()) == sorted((r["host"], r["status"], r["score"]) for r in rows)
    assert spark.read.text(str(tmp_path / "out" / "text")).count() == 1 and spark.read.text(str(tmp_path / "out" / "urls")).count() == 0
    filtered = readers.read_filtered(spark, str(tmp_path / "out" / "filtered"), lines=True).collect()
    assert sorted((r["candidate"]["transport"], r["reason"]) for r in filtered) == sorted((r["transport"], r["reason"]) for r in rejected.collect())


def test_lines_that_are_no_records(spark, tmp_path):
    from endpointlens import schemas

    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "x.json").write_text('{"host": "h", "port": "no number"}\n{"host": \n\n{"host": "i", "more": 1}\nnull\n')
    kept = readers.read_candidates(spark, str(tmp_path), lines=True).collect()
    assert [(r["host"], r["port"], r["source"]) for r in kept] == [("i", None, "loaded")]
    bad = {r["value"] for r in readers.bad_lines(spark, str(tmp_path), schemas.CANDIDATE).collect()}
    assert bad == {'{"host": "h", "port": "no number"}', '{"host": ', "null"}
