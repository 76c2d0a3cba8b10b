"""Record schemas as DDL strings."""

CANDIDATE = (
    "provider string, source string, transport string, endpoint_url string, host string, port int, path string, "
    "bootstrap_ipv4 array<string>, bootstrap_ipv6 array<string>, tls_server_name string, metadata map<string,string>"
)
CANDIDATE_FIELDS = [f.strip().split(" ")[0] for f in CANDIDATE.replace("map<string,string>", "map").split(", ")]
FILTERED = f"candidate struct<{', '.join(f.strip().replace(' ', ':', 1) for f in CANDIDATE.replace('map<string,string>', 'map<string;string>').split(', '))}>, reason string, detail string, stage string".replace(";", ",")
PROBE = "ok boolean, probe string, latency_ms double, error string, details map<string,string>"
PARTS = "correctness int, availability int, performance int, history int"
RESULT = (
    CANDIDATE + ", status string, score int, accepted boolean, reasons array<string>, confidence_score int, "
    "score_breakdown struct<correctness:int,availability:int,performance:int,history:int>, correctness_score int, availability_score int, "
    "performance_score int, history_score int, score_caps_applied array<string>, all_probes_failed boolean, "
    "probes array<struct<ok:boolean,probe:string,latency_ms:double,error:string,details:map<string,string>>>"
)
CORPUS_PROBE = (
    "id string, kind string, qname string, qname_template string, qtype string, expected_mode string, expected_answers array<string>, "
    "expected_nameservers array<string>, parent_zone string, source string, stability_score double, notes string"
)
CORPUS_PROBE_FIELDS = [f.strip().split(" ")[0] for f in CORPUS_PROBE.split(", ")]
CORPUS = (
    "schema_version int, corpus_version string, generated_at string, generator_version string, sources_used array<string>, probe_counts map<string,int>, "
    "probes array<struct<" + ",".join(f.strip().replace(" ", ":", 1) for f in CORPUS_PROBE.split(", ")) + ">>"
)
HOST = "hostname string, ipv4 array<string>, ipv6 array<string>, source string, operator_family string, notes string"
_HOST = ",".join(f.strip().replace(" ", ":", 1) for f in HOST.split(", "))
SEEDS = (
    f"snapshot_version int, generated_at string, sources_used array<string>, root_servers array<struct<{_HOST}>>, "
    f"delegations array<struct<zone:string,nameservers:array<string>,source:string,notes:string,exact_hosts:array<struct<{_HOST}>>>>"
)
RESPONSE = "name string, qname string, resolver string, resolver_ip string, type string, qtype string, rcode string, status string, error string, failure string, latency_ms double, rt double, answers array<string>, data struct<rcode:string>, _bad string"
HISTORY = {
    "runs": "run_id string, run_date date, run_started_at timestamp, generated_at timestamp, github_run_id string, repo_sha string, crawler_sha string, run_type string",
    "run_status": "run_id string, run_date date, resolver_key string, host string, transport string, status string, score int, reasons array<string>, p50_latency_ms double, p95_latency_ms double, jitter_ms double",
    "daily": "run_date date, resolver_key string, host string, transport string, reasons array<string>, runs long, successful_runs long, failed_runs long, avg_p50 double, avg_p95 double, avg_jitter double, day_status string, reasons_signature string, flapped_within_day boolean",
    "quarantine": "host string, first_quarantined_on date, last_quarantined_on date, retry_after date, reasons_signature string, reasons array<string>, cycles int",
}
