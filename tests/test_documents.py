"""Every rule of corpus and seed documents with a failing row."""

import copy
import json

import pytest

from endpointlens.sources import documents, readers

CORPUS = {
    "schema_version": 2, "corpus_version": "1", "generated_at": "now", "generator_version": "g", "sources_used": ["s"], "probe_counts": {"positive_exact": 1},
    "probes": [
        {"id": "a", "kind": "positive_exact", "qtype": "A", "expected_mode": "exact_rrset", "qname": "a.", "expected_answers": ["192.0.2.1"], "stability_score": 1},
        {"id": "b", "kind": "positive_consensus", "qtype": "NS", "expected_mode": "baseline_match", "qname": "b.", "expected_nameservers": ["ns."], "notes": None},
        {"id": "c", "kind": "negative_generated", "qtype": "A", "expected_mode": "nxdomain", "qname_template": "{uuid}.c.", "parent_zone": "c.", "stability_score": 0.8},
    ],
}
SEED_HOST = {"hostname": "h.", "ipv4": ["192.0.2.1"], "ipv6": [], "source": "s", "operator_family": "f", "notes": "n"}
SEEDS = {
    "snapshot_version": 1, "generated_at": "now", "sources_used": ["s"], "root_servers": [copy.deepcopy(SEED_HOST)],
    "delegations": [{"zone": "z.", "nameservers": ["ns."], "exact_hosts": [copy.deepcopy(SEED_HOST), copy.deepcopy(SEED_HOST)], "source": "s", "further": 1}],
}
GONE = object()


def changed(document, path, value):
    out = copy.deepcopy(document)
    at = out
    for step in path[:-1]:
        at = at[step]
    if value is GONE:
        del at[path[-1]]
    else:
        at[path[-1]] = value
    return out


def table(spark, documents_):
    return spark.createDataFrame([(name, d if isinstance(d, str) else json.dumps(d)) for name, d in documents_.items()], "file string, value string")


def found(df):
    out = {}
    for r in df.collect():
        out.setdefault(r["file"], []).append((r["path"], r["field"], r["error"]))
    return {k: sorted(v) for k, v in out.items()}


MISSING = "missing or invalid {} field"
CASES = [
    *[((f,), v, ("", f, MISSING.format("string"))) for f in ("corpus_version", "generated_at", "generator_version") for v in (GONE, None, 3, "", ["x"])],
    *[(("schema_version",), v, ("", "schema_version", MISSING.format("integer"))) for v in ("2", 2.5, None)],
    *[(("sources_used",), v, ("", "sources_used", MISSING.format("list"))) for v in (GONE, None, "s", [], ["s", 1])],
    *[(("probe_counts",), v, ("", "probe_counts", MISSING.format("map"))) for v in (GONE, None, [], {}, {"a": "1"}, {"a": 1.5})],
    (("surprise",), 1, ("", "", "unsupported fields: surprise")),
    *[(("probes", 0, f), v, ("probes[0]", f, MISSING.format("string"))) for f in ("id", "qtype") for v in (GONE, None, 3, "", {})],
    *[(("probes", 0, f), v, ("probes[0]", f, "invalid string field")) for f in ("parent_zone", "source", "notes") for v in (3, "", ["x"], True)],
    (("probes", 0, "expected_answers"), GONE, ("probes[0]", "expected_answers", "exact_rrset probes need 'expected_answers'")),
    (("probes", 0, "expected_answers"), [], ("probes[0]", "expected_answers", "exact_rrset probes need 'expected_answers'")),
    *[(("probes", 1, "expected_nameservers"), v, ("probes[1]", "expected_nameservers", "invalid list field")) for v in (None, "ns.", ["ns.", 1], {})],
    *[(("probes", 0, "stability_score"), v, ("probes[0]", "stability_score", "invalid numeric field")) for v in ("1", [1], {})],
    (("probes", 0, "kind"), "odd", ("probes[0]", "kind", "unsupported probe kind")),
    (("probes", 1, "expected_mode"), "odd", ("probes[1]", "expected_mode", "unsupported expected_mode")),
    (("probes", 0, "qname"), GONE, ("probes[0]", "qname", "either 'qname' or 'qname_template' is needed")),
    (("probes", 2, "odd"), 1, ("probes[2]", "", "unsupported fields: odd")),
    (("probes", 2, "qname"), 5, ("probes[2]", "qname", "invalid string field")),
]


def test_every_rule_of_a_corpus(spark):
    bad = {str(k): changed(CORPUS, path, value) for k, (path, value, _) in enumerate(CASES)}
    got = found(documents.corpus_errors(table(spark, {"good": CORPUS, **bad})))
    assert got == {str(k): [error] for k, (_, _, error) in enumerate(CASES)}


def test_other_faults_of_a_corpus(spark):
    first = changed(changed(changed(CORPUS, ("schema_version",), 1), ("generator_version",), GONE), ("sources_used",), GONE)
    rows = {
        "text": "{", "list": "[]", "number": "3", "empty": "", "first": first, "first-null": changed(first, ("sources_used",), None),
        "entry": changed(CORPUS, ("probes", 1), 7), "no-list": changed(CORPUS, ("probes",), {}), "template": changed(changed(CORPUS, ("probes", 2, "qname"), "q."), ("probes", 2, "qname_template"), GONE),
    }
    got = found(documents.corpus_errors(table(spark, rows)))
    whole = [("", "", "must be a JSON object")]
    assert got == {
        "text": whole, "list": whole, "number": whole, "empty": whole, "first-null": [("", "sources_used", "invalid list field")],
        "entry": [("", "probes", MISSING.format("list")), ("probes[1]", "", "must be a JSON object")], "no-list": [("", "probes", MISSING.format("list"))],
        "template": [("probes[2]", "qname_template", "negative_generated probes need 'qname_template'")],
    }
    other = found(documents.corpus_errors(table(spark, {"a": CORPUS}), version=3))
    assert other == {"a": [("", "schema_version", "unsupported schema_version; expected 3")]}
    loose = changed(changed(CORPUS, ("surprise",), 1), ("probes", 0, "odd"), 1)
    assert found(documents.corpus_errors(table(spark, {"a": loose}), strict=False)) == {}


SEED_CASES = [
    *[(("snapshot_version",), v, ("", "snapshot_version", MISSING.format("integer"))) for v in (GONE, None, "1", 1.5)],
    (("generated_at",), "", ("", "generated_at", MISSING.format("string"))),
    *[(("sources_used",), v, ("", "sources_used", MISSING.format("list"))) for v in ([], [1], None)],
    (("root_servers",), None, ("", "root_servers", MISSING.format("list"))),
    (("delegations",), GONE, ("", "delegations", MISSING.format("list"))),
    *[(("root_servers", 0, f), v, ("root_servers[0]", f, MISSING.format("string"))) for f in ("hostname", "source") for v in (GONE, 1, "")],
    *[(("root_servers", 0, f), v, ("root_servers[0]", f, "invalid list field")) for f in ("ipv4", "ipv6") for v in (None, "x", [1])],
    *[(("root_servers", 0, f), v, ("root_servers[0]", f, "invalid string field")) for f in ("operator_family", "notes") for v in (1, "")],
    *[(("delegations", 0, f), GONE, ("delegations[0]", f, MISSING.format("string"))) for f in ("zone", "source")],
    (("delegations", 0, "nameservers"), [], ("delegations[0]", "nameservers", MISSING.format("list"))),
    (("delegations", 0, "exact_hosts"), GONE, ("delegations[0]", "exact_hosts", MISSING.format("list"))),
    (("delegations", 0, "exact_hosts", 1, "hostname"), 4, ("delegations[0].exact_hosts[1]", "hostname", MISSING.format("string"))),
]


def test_every_rule_of_seeds(spark):
    bad = {str(k): changed(SEEDS, path, value) for k, (path, value, _) in enumerate(SEED_CASES)}
    got = found(documents.seed_errors(table(spark, {"good": SEEDS, **bad})))
    assert got == {str(k): [error] for k, (_, _, error) in enumerate(SEED_CASES)}


def test_probes_of_documents(spark, tmp_path):
    (tmp_path / "c.json").write_text(json.dumps(CORPUS))
    probes, errors = readers.read_corpus(spark, str(tmp_path / "c.json"), 2)
    rows = {r["id"]: r for r in probes.collect()}
    assert errors.count() == 0 and [rows[k]["position"] for k in "abc"] == [0, 1, 2]
    assert rows["a"]["expected_answers"] == ["192.0.2.1"] and rows["a"]["stability_score"] == 1.0 and rows["b"]["expected_mode"] == "consensus_match"
    assert rows["c"]["qname"] is None and rows["c"]["stability_score"] == pytest.approx(0.8) and rows["b"]["expected_answers"] == []


def test_sources_in_order(spark):
    lines = spark.createDataFrame([(0, "192.0.2.1:5353 # x"), (1, "a b")], "ordinal int, value string")
    records = spark.createDataFrame([(0, "https://h/dns-query", "p")], "ordinal int, url string, provider string")
    kept, out = readers.read_sources([("lines", lines)], [("records", records)])
    assert sorted((r["ordinal"]["source_no"], r["transport"], r["host"]) for r in kept.collect()) == [(0, "dns-tcp", "192.0.2.1"), (0, "dns-udp", "192.0.2.1"), (1, "doh", "h")]
    assert {r["reason"] for r in out.collect()} == {"invalid_dns_host"}


def test_documents_of_a_small_file_go_to_all_tasks(spark, tmp_path):
    """One file with many documents is read by one task; its rules run in many, in one pass a level."""
    path = str(tmp_path / "raw")
    spark.range(64).selectExpr("CAST(id AS string) AS file", "'{\"probes\": [{}]}' AS value").repartition(1).write.parquet(path)
    out = documents.corpus_errors(spark.read.parquet(path), 2)
    assert out.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism
    assert out._jdf.queryExecution().sparkPlan().toString().count("FileScan") == 2
    assert {r["file"] for r in out.collect()} == {str(k) for k in range(64)}
