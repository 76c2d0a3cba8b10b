"""SQL of the job queries for DuckDB, on the same tables."""

from __future__ import annotations

from .oracles import _LAST, DAILY, HOST_DAY, HOSTS, KEPT, ORACLE_SQL, PROBES, RESULTS, STATUS, STREAKS, metrics, scoring

_MOVED = f"(ends_with(run_id, '-0') AND run_date < {_LAST})"
_UPSERT = f"""{STATUS},
runs2 AS (SELECT run_id, CAST(CASE WHEN {_MOVED} THEN run_date + 1 ELSE run_date END AS DATE) AS run_date FROM runs),
status2 AS (SELECT s.* FROM run_status s JOIN runs USING (run_id) WHERE NOT {_MOVED} OR CAST(substr(resolver_key, 3) AS BIGINT) % 2 = 0)""" + DAILY[len(STATUS) :].replace("run_status s JOIN runs", "status2 s JOIN runs2")

_HOST_LINES = """listed AS (SELECT c_custkey AS ordinal, c_custkey % 7 AS k, 'host-' || c_custkey AS phone FROM customer WHERE c_custkey % 7 > 1)"""
_RECORDS = """records AS (SELECT s_suppkey AS ordinal, CASE WHEN s_suppkey % 2 = 0 THEN s_name END AS provider, s_nationkey, s_suppkey % 3 AS k, 'H' || s_suppkey || '.example' AS h FROM supplier WHERE s_suppkey % 11 > 0)"""

_SEEDS = """n AS (SELECT 0 AS k1, n_nationkey AS a, CAST(0 AS BIGINT) AS b, 'root' AS zone, n_nationkey || '.root.' AS hostname, ['192.0.2.' || n_nationkey] AS v4, CASE WHEN n_nationkey % 2 = 0 THEN ['2001:db8::' || n_nationkey] END AS v6,
  'nations' AS source, 'r' || n_regionkey AS family FROM nation),
h AS (SELECT 1 AS k1, s_suppkey // 20 AS a, s_suppkey AS b, 'Z' || (s_suppkey // 20) || '.' AS zone, s_suppkey || '.H.' AS hostname, ['10.0.0.' || (s_suppkey % 250), '10.0.0.1'] AS v4,
  CASE WHEN s_suppkey % 3 = 0 THEN ['2001:db8::' || s_suppkey] END AS v6, 'suppliers' AS source, coalesce(CASE WHEN s_suppkey % 4 > 0 THEN 'f' || (s_suppkey % 9) END, 'Z' || (s_suppkey // 20) || '.') AS family FROM supplier),
hosts AS (SELECT *, 1 + CASE WHEN v6 IS NULL THEN 0 ELSE 1 END AS want, row_number() OVER (ORDER BY k1, a, b) AS k FROM (SELECT * FROM n UNION ALL SELECT * FROM h)),
fold AS (
  SELECT CAST(0 AS BIGINT) AS k, CAST(0 AS BIGINT) AS takes, CAST(MAP {} AS MAP(VARCHAR, BIGINT)) AS probes, CAST(MAP {} AS MAP(VARCHAR, BIGINT)) AS families
  UNION ALL
  SELECT k, takes, map_concat(probes, MAP {zone: coalesce(element_at(probes, zone)[1], 0) + takes}), map_concat(families, MAP {family: coalesce(element_at(families, family)[1], 0) + CASE WHEN takes > 0 THEN 1 ELSE 0 END})
  FROM (SELECT i.k, i.zone, i.family, f.probes, f.families, CAST(CASE WHEN coalesce(element_at(families, family)[1], 0) >= 4 THEN 0 ELSE least(want, greatest(5 - coalesce(element_at(probes, zone)[1], 0), 0)) END AS BIGINT) AS takes
    FROM fold f JOIN hosts i ON i.k = f.k + 1)),
exact0 AS (SELECT hosts.*, takes, unnest(['A', 'AAAA']) AS qtype FROM hosts JOIN fold USING (k) WHERE takes > 0),
exact AS (SELECT lower('positive-exact-' || replace(rtrim(hostname, '.'), '.', '-') || '-' || qtype) AS id, hostname AS qname, qtype, CASE WHEN qtype = 'A' THEN v4 ELSE v6 END AS answers, source FROM exact0 WHERE qtype = 'A' OR (takes = 2 AND v6 IS NOT NULL))"""

_VOTES = _SEEDS + """,
consensus AS (SELECT DISTINCT 'positive-consensus-' || lower(rtrim(zone, '.')) || '-ns' AS id, zone AS qname, ['ns.' || zone] AS names FROM h),
negative AS (SELECT DISTINCT 'negative-generated-' || replace(lower(p_brand), '#', '-') || '-a' AS id, replace(lower(p_brand), '#', '-') || '.' AS zone FROM part),
made AS (SELECT id, 'positive_exact' AS kind, list_sort(answers) AS expected FROM exact UNION ALL SELECT id, 'positive_consensus', names FROM consensus UNION ALL SELECT id, 'negative_generated', [] FROM negative),
asked AS (SELECT made.*, CAST(regexp_extract(id, '([0-9]+)', 1) AS INT) AS number, r.r * 6 + c.c * 2 + b.b AS turn, c.c AS check_no FROM made, range(3) r(r), range(3) c(c), range(2) b(b)
  WHERE CASE WHEN kind = 'negative_generated' THEN TRUE ELSE r.r < 2 AND c.c = 0 END),
seen AS (SELECT *, (number + turn) % 7 = 0 AS late, number % 11 = 3 AND turn = 1 AS wrong FROM asked),
counted AS (SELECT id, kind, expected, count(*) AS asked, count_if(late) AS failed, count_if(wrong AND NOT late) AS bad, count_if(NOT late AND NOT wrong) AS good FROM seen GROUP BY ALL),
checks AS (SELECT id, check_no, count_if(NOT late AND NOT wrong) AS nx, count_if(wrong AND NOT late) AS bad FROM seen WHERE kind = 'negative_generated' GROUP BY ALL),
negatives AS (SELECT id, arg_min(r, check_no) FILTER (r IS NOT NULL) AS reason FROM (SELECT *, CASE WHEN bad > 0 THEN 'negative_parent_wildcard_like' WHEN nx < 2 THEN 'insufficient_baseline_consensus' END AS r FROM checks) GROUP BY id),
top AS (SELECT c.*, n.reason AS negative_reason, CASE kind
    WHEN 'positive_exact' THEN CASE WHEN bad > 0 THEN 'exact_rrset_mismatch' WHEN good < 2 THEN CASE WHEN failed * 2 > asked THEN 'timeout_rate_high' ELSE 'insufficient_baseline_consensus' END END
    WHEN 'positive_consensus' THEN CASE WHEN good + bad = 0 THEN 'timeout_rate_high' WHEN greatest(good, bad) < 2 THEN 'insufficient_baseline_consensus' WHEN good > 0 AND bad > 0 THEN 'baseline_disagreement' WHEN failed * 2 > asked THEN 'timeout_rate_high' END
    ELSE n.reason END AS rejection_reason FROM counted c LEFT JOIN negatives n USING (id)),
voted AS (SELECT id, kind, expected, asked, failed, rejection_reason IS NULL AS accepted, rejection_reason, CASE WHEN kind = 'positive_consensus' AND rejection_reason IS NULL THEN array_to_string(expected, ',') END AS agreed,
  CASE WHEN kind = 'positive_exact' AND bad > 0 THEN 'other.' END AS observed FROM top)"""

_RELIABLE = (
    scoring("scored", "mr")
    .replace("+ 5) AS confidence_score", "+ CASE WHEN rel >= 0.95 THEN 15 WHEN rel >= 0.85 THEN 12 WHEN rel >= 0.70 THEN 8 ELSE 5 END) AS confidence_score")
    .replace("THEN 'recent_failure_streak' END]", "THEN 'recent_failure_streak' END, CASE WHEN rel < 0.55 THEN 'reliability_low' END, CASE WHEN transport = 'dns-udp' THEN 'udp_only' END]")
    .replace("correctness_score + availability_score + performance_score + history_score AS whole", "greatest(0, correctness_score + availability_score + performance_score + history_score - CASE WHEN rel < 0.55 THEN 15 WHEN rel < 0.70 THEN 10 WHEN rel < 0.85 THEN 5 WHEN rel < 0.95 THEN 2 ELSE 0 END) AS whole")
    .replace("['source_reliability_unknown',", "[CASE WHEN endpoint % 10 IN (1, 2) THEN 'source_reliability_unknown' END,")
)

_GENERATED = _VOTES.replace(">= 4 THEN 0 ELSE least(want, greatest(5 -", ">= 3 THEN 0 ELSE least(want, greatest(3 -")
_of = ORACLE_SQL.__getitem__

JOB_SQL: dict[str, str] = {
    "score_reliability": f"""WITH {PROBES}, {metrics("endpoint, day")}, mr AS (SELECT *, CASE WHEN endpoint % 10 > 2 THEN (endpoint % 10 + 1) / 11 END AS rel, ['dns-udp', 'dns-tcp', 'doh'][endpoint % 3 + 1] AS transport FROM m), {_RELIABLE}
SELECT endpoint, CAST(day AS VARCHAR) AS day, score, status, CAST(confidence_score AS INT) AS confidence_score, array_to_string(reasons, '|') AS reasons, array_to_string(list_sort(caps), '|') AS caps FROM scored""",
    "history_upsert": f"""WITH {_UPSERT} SELECT CAST(run_date AS VARCHAR) AS run_date, resolver_key, host, transport, day_status, runs, successful_runs, failed_runs, flapped_within_day, reasons_signature
FROM daily WHERE run_date >= {_LAST} - INTERVAL 29 DAY""",
    "quarantine_step": f"""WITH RECURSIVE {HOST_DAY},
n AS (SELECT host, run_date, status, reasons_signature, row_number() OVER (PARTITION BY host ORDER BY run_date) AS k FROM host_day),
fold AS (
  SELECT host, CAST(0 AS BIGINT) AS k, CAST(NULL AS DATE) AS f, CAST(NULL AS DATE) AS l, CAST(NULL AS DATE) AS r, CAST(NULL AS VARCHAR) AS sig, 0 AS c FROM n WHERE k = 1
  UNION ALL
  SELECT n.host, n.k,
    CASE WHEN r <= run_date AND status = 'rejected' AND reasons_signature = sig THEN f WHEN r <= run_date THEN NULL WHEN r IS NULL AND status = 'rejected' THEN run_date ELSE f END,
    CASE WHEN r <= run_date AND status = 'rejected' AND reasons_signature = sig THEN run_date WHEN r <= run_date THEN NULL WHEN r IS NULL AND status = 'rejected' THEN run_date ELSE l END,
    CASE WHEN r <= run_date AND status = 'rejected' AND reasons_signature = sig THEN CAST(run_date + INTERVAL 3 DAY AS DATE) WHEN r <= run_date THEN NULL WHEN r IS NULL AND status = 'rejected' THEN CAST(run_date + INTERVAL 3 DAY AS DATE) ELSE r END,
    CASE WHEN r <= run_date AND status = 'rejected' AND reasons_signature = sig THEN sig WHEN r <= run_date THEN NULL WHEN r IS NULL AND status = 'rejected' THEN reasons_signature ELSE sig END,
    CAST(CASE WHEN r <= run_date AND status = 'rejected' AND reasons_signature = sig THEN c + 1 WHEN r <= run_date THEN 0 WHEN r IS NULL AND status = 'rejected' THEN 1 ELSE c END AS INT)
  FROM fold JOIN n ON n.host = fold.host AND n.k = fold.k + 1)
SELECT host, CAST(f AS VARCHAR) AS first_quarantined_on, CAST(l AS VARCHAR) AS last_quarantined_on, CAST(r AS VARCHAR) AS retry_after, sig AS reasons_signature, c AS cycles
FROM (SELECT *, row_number() OVER (PARTITION BY host ORDER BY k DESC) AS last FROM fold) WHERE last = 1 AND r IS NOT NULL""",
    "candidates_round_trip": """SELECT c_name AS provider, CASE WHEN c_custkey % 4 > 0 THEN c_mktsegment ELSE 'loaded' END AS source, ['dns-udp', 'dns-tcp', 'doh'][c_custkey % 3 + 1] AS transport, 'host-' || c_custkey AS host,
  CASE WHEN c_custkey % 5 > 0 THEN CAST(c_nationkey AS INT) END AS port, c_mktsegment AS segment, CAST(0 AS INT) AS n_bootstrap FROM customer
UNION ALL SELECT c_name, NULL, NULL, NULL, NULL, NULL, NULL FROM customer WHERE right(c_name, 2) IN ('00', '50')""",
    "filtered_round_trip": f"""WITH {HOSTS} SELECT CASE WHEN good THEN host ELSE ' ' || host END AS host, transport, CASE WHEN good THEN 'duplicate_dns_candidate' ELSE 'invalid_dns_host' END AS reason,
  CASE WHEN good THEN transport || ':' || host || ':53' ELSE ' ' || host END AS detail, 'normalize' AS stage FROM firsts WHERE NOT good OR rn > 1""",
    "results_round_trip": f"WITH {RESULTS} SELECT host, transport, CAST(port AS INT) AS port, status, score, correctness_score, availability_score, performance_score, CAST(0 AS INT) AS history_score, array_to_string(reasons, '|') AS reasons FROM results",
    "pruned_round_trip": f"""WITH {PROBES}, g AS (SELECT endpoint || '/' || CAST(day AS VARCHAR) AS provider, count(*) AS n, count_if(NOT ok) AS f FROM probes GROUP BY endpoint, day),
s AS (SELECT *, CASE WHEN f = 0 THEN 'accepted' WHEN 2 * f <= n THEN 'candidate' ELSE 'rejected' END AS status FROM g)
SELECT provider, status, CAST(CASE WHEN status <> 'rejected' THEN n WHEN f = n THEN 0 ELSE f END AS INT) AS n_probes, CAST(CASE WHEN status = 'rejected' AND f = n THEN NULL ELSE f END AS INT) AS n_failed,
  CASE WHEN status = 'rejected' AND f = n THEN TRUE END AS all_probes_failed FROM s""",
    "responder_lines": """WITH l AS (SELECT *, l_orderkey * 10 + l_linenumber AS line_no FROM lineitem)
SELECT line_no, CAST(l_suppkey AS VARCHAR) AS resolver, 'q' || l_partkey AS qname, 'NS' AS rdtype, upper(l_linestatus) AS rcode, l_returnflag || '|last' AS answers, NULL AS error FROM l WHERE l_linenumber < 5
UNION ALL SELECT line_no, CAST(l_suppkey AS VARCHAR), 'q' || l_partkey, 'A', 'NXDOMAIN', '', 'late' FROM l WHERE l_linenumber IN (5, 6)
UNION ALL SELECT line_no, NULL, NULL, NULL, NULL, NULL, NULL FROM l WHERE l_linenumber >= 7""",
    "run_metadata_round_trip": f"""WITH {PROBES}, runs AS (SELECT run_id, min(day) AS d FROM probes GROUP BY run_id)
SELECT run_id AS github_run_id, run_id || '_' || CAST(d AS VARCHAR) || CASE WHEN ends_with(run_id, '-3') THEN 'T23:30:00-02:00' ELSE 'T23:30:00Z' END AS run_id,
  CAST(CAST(CASE WHEN ends_with(run_id, '-3') THEN d + 1 ELSE d END AS DATE) AS VARCHAR) AS run_date,
  CASE WHEN ends_with(run_id, '-3') THEN CAST(d + 1 AS VARCHAR) || ' 01:30:00' ELSE CAST(d AS VARCHAR) || ' 23:30:00' END AS generated_at, 'abc' AS repo_sha FROM runs""",
    "line_list": f"""WITH {_HOST_LINES}, t AS (SELECT unnest(['dns-udp', 'dns-tcp']) AS transport)
SELECT CAST(ordinal AS BIGINT) AS ordinal, CASE WHEN k = 3 THEN 'a ' || phone ELSE phone END AS host, CAST(CASE WHEN k = 2 THEN 5353 ELSE 53 END AS INT) AS port, transport, 'manual' AS source,
  CASE WHEN k = 3 THEN 'invalid_dns_host' END AS reason, CASE WHEN k = 3 THEN 'a ' || phone END AS detail FROM listed, t""",
    "endpoint_records": f"""WITH {_RECORDS} SELECT CAST(ordinal AS BIGINT) AS ordinal, provider, 'doh' AS transport, CASE k WHEN 0 THEN 'https://' || h WHEN 1 THEN 'http://' || h || '/q' ELSE 'https://' || h || ':8443/p/q?x=1' END AS endpoint_url, lower(h) AS host,
  CAST(CASE k WHEN 0 THEN 443 WHEN 1 THEN 80 ELSE 8443 END AS INT) AS port, CASE k WHEN 0 THEN '/dns-query' WHEN 1 THEN '/q' ELSE '/p/q' END AS path, lower(h) AS tls_server_name, CAST(s_nationkey AS VARCHAR) AS nation FROM records""",
    "source_union": f"""WITH {_HOST_LINES}, {_RECORDS}, t AS (SELECT unnest(['dns-udp', 'dns-tcp']) AS transport),
lines AS (SELECT 0 AS source_no, 'manual' AS source, * FROM listed UNION ALL SELECT 1, 'second', * FROM listed WHERE ordinal % 2 = 0)
SELECT CAST(source_no AS INT) AS source_no, transport, source, count(*) AS n, k <> 3 AS kept FROM lines, t GROUP BY ALL
UNION ALL SELECT 2, 'doh', 'manual', count(*), TRUE FROM records""",
    "corpus_errors": """WITH p AS (SELECT CAST(p_partkey AS VARCHAR) AS file, p_partkey % 13 AS k FROM part)
SELECT file, CASE WHEN k < 9 THEN 'probes[0]' ELSE '' END AS path, ['id', 'kind', 'expected_mode', 'qname', 'expected_answers', 'expected_answers', 'stability_score', '', 'schema_version', 'generator_version', 'sources_used', ''][k] AS field,
  ['missing or invalid string field', 'unsupported probe kind', 'unsupported expected_mode', 'either ''qname'' or ''qname_template'' is needed', 'exact_rrset probes need ''expected_answers''', 'invalid list field',
   'invalid numeric field', 'unsupported fields: size', 'missing or invalid integer field', 'missing or invalid string field', 'missing or invalid list field', 'must be a JSON object'][k] AS error FROM p WHERE k > 0""",
    "seed_errors": """WITH s AS (SELECT CAST(s_suppkey AS VARCHAR) AS file, s_suppkey % 8 AS k FROM supplier), places AS (SELECT unnest(['root_servers[0]', 'delegations[0].exact_hosts[0]', 'delegations[0].exact_hosts[1]']) AS path)
SELECT file, path, CASE k WHEN 1 THEN 'hostname' ELSE 'ipv4' END AS field, CASE k WHEN 1 THEN 'missing or invalid string field' ELSE 'invalid list field' END AS error FROM s, places WHERE k IN (1, 2)
UNION ALL SELECT file, 'delegations[0]', 'nameservers', 'missing or invalid list field' FROM s WHERE k = 3
UNION ALL SELECT file, 'delegations[0]', 'exact_hosts', 'missing or invalid list field' FROM s WHERE k = 4
UNION ALL SELECT file, 'delegations[0].exact_hosts[1]', '', 'must be a JSON object' FROM s WHERE k = 4
UNION ALL SELECT file, '', CASE k WHEN 5 THEN 'snapshot_version' WHEN 6 THEN 'root_servers' ELSE 'delegations' END, CASE k WHEN 5 THEN 'missing or invalid integer field' ELSE 'missing or invalid list field' END FROM s WHERE k > 4""",
    "exact_probes": f"WITH RECURSIVE {_SEEDS} SELECT id, qname, qtype, array_to_string(answers, '|') AS expected_answers, source, CAST(1.0 AS DOUBLE) AS stability_score FROM exact",
    "baseline_plan": f"""WITH RECURSIVE {_VOTES}, m AS (SELECT id, 'positive_consensus' AS kind, qname, CAST(NULL AS VARCHAR) AS zone, 2 AS rounds, 1 AS labels FROM consensus UNION ALL SELECT id, 'negative_generated', CAST(NULL AS VARCHAR), negative.zone, 3, 3 FROM negative)
SELECT id, kind, CAST(r.r AS INT) AS round, CAST(c.c AS INT) AS check_no, b.b AS resolver, coalesce(qname, substr(sha256(id || '-' || r.r || '-' || c.c), 1, 40) || '.' || zone) AS qname
FROM m, range(3) r(r), range(3) c(c), (SELECT unnest(['a', 'b']) AS b) b WHERE r.r < rounds AND c.c < labels""",
    "corpus_report": f"WITH RECURSIVE {_VOTES} SELECT kind, rejection_reason, count(*) AS n FROM voted GROUP BY ALL",
    "vote_trail": f"WITH RECURSIVE {_VOTES} SELECT id, kind, accepted, rejection_reason, agreed, observed, asked, failed FROM voted",
    "corpus_build": f"""WITH RECURSIVE {_VOTES}, kept AS (SELECT v.id, v.kind, coalesce(e.qname, c.qname) AS qname, CASE WHEN n.zone IS NOT NULL THEN '{{uuid}}.' || n.zone END AS qname_template, coalesce(e.qtype, CASE WHEN c.id IS NOT NULL THEN 'NS' ELSE 'A' END) AS qtype,
  CASE v.kind WHEN 'positive_exact' THEN 'exact_rrset' WHEN 'positive_consensus' THEN 'consensus_match' ELSE 'nxdomain' END AS expected_mode,
  CASE WHEN v.kind = 'positive_exact' THEN array_to_string(expected, '|') ELSE '' END AS expected_answers, CASE WHEN v.kind = 'positive_consensus' THEN array_to_string(expected, '|') ELSE '' END AS expected_nameservers,
  n.zone AS parent_zone, coalesce(e.source, CASE WHEN c.id IS NOT NULL THEN 'suppliers' ELSE 'negative-parent-pool' END) AS source,
  CAST(CASE v.kind WHEN 'positive_exact' THEN 1.0 WHEN 'positive_consensus' THEN 0.9 ELSE 0.8 END AS DOUBLE) AS stability_score
  FROM voted v LEFT JOIN exact e USING (id) LEFT JOIN consensus c USING (id) LEFT JOIN negative n USING (id) WHERE accepted)
SELECT *, row_number() OVER (ORDER BY id) - 1 AS position FROM kept""",
    "logic_errors": """WITH p AS (SELECT p_partkey AS part, p_partkey % 10 AS k, CASE WHEN p_partkey % 10 = 0 THEN 'twice-' || (p_partkey // 20) ELSE 'p' || p_partkey END AS id FROM part)
SELECT part, array_to_string(list_filter([CASE WHEN k = 1 THEN 'unknown kind' END, CASE WHEN k = 5 THEN 'kind and expected_mode differ' END, CASE WHEN k IN (7, 8) THEN 'negative probe without parent_zone' END,
  CASE WHEN count(*) OVER (PARTITION BY id) > 1 THEN 'duplicate id' END], lambda x: x IS NOT NULL), '|') AS errors FROM p""",
    "duplicate_ids": "SELECT l_partkey || '-' || l_suppkey AS id, count(*) AS n FROM lineitem GROUP BY 1 HAVING count(*) > 1",
    "distinct_resolvers": f"WITH {RESULTS} SELECT DISTINCT host || ':' || CAST(port AS VARCHAR) AS resolver FROM results",
    "ordered_exports": f"""WITH {RESULTS}, r AS (SELECT endpoint, day, transport, host, port, coalesce(endpoint_url, '') || '/' || endpoint || '/' || CAST(day AS VARCHAR) AS u, CASE WHEN endpoint % 2 = 0 THEN 'source' ELSE 'normalize' END AS stage, 'r' || (endpoint % 3) AS reason FROM results)
SELECT endpoint, CAST(day AS VARCHAR) AS day, CAST(ntile(17) OVER (ORDER BY transport, u) - 1 AS INT) AS shard, 'endpoint' AS order_name FROM r
UNION ALL SELECT endpoint, CAST(day AS VARCHAR), CAST(ntile(17) OVER (ORDER BY CASE WHEN transport = 'dns-udp' AND port = 53 THEN 0 WHEN transport <> 'doh' THEN 1 ELSE 2 END, transport, u) - 1 AS INT), 'priority' FROM r
UNION ALL SELECT endpoint, CAST(day AS VARCHAR), CAST(ntile(17) OVER (ORDER BY stage, reason, transport, u) - 1 AS INT), 'filtered' FROM r""",
    "endpoint_texts": f"""WITH {RESULTS} SELECT endpoint, CAST(day AS VARCHAR) AS day, CASE WHEN transport = 'doh' THEN 'doh:' || endpoint_url ELSE transport || ':' || host || ':' || port END AS display, 'error:' || substr(repeat(host || ' failed; ', 20), 1, 80) AS error,
  'historically rejected for 14 consecutive days; retry after ' || CAST(CAST(day + 90 AS DATE) AS VARCHAR) || '; last reasons: ' || array_to_string(reasons, ', ') AS detail
FROM results WHERE status IN ('accepted', 'rejected') AND transport IN ('dns-udp', 'doh')""",
    "transport_errors": """WITH e AS (SELECT l_orderkey, l_linenumber, l_linenumber % 6 AS k, l_linestatus || ' refused' AS t, CASE WHEN l_partkey % 9 > 0 THEN l_partkey % 600 END AS code FROM lineitem)
SELECT l_orderkey, l_linenumber, CASE k WHEN 0 THEN 'timeout:' || t WHEN 1 THEN 'http_error:' || code WHEN 2 THEN 'tls_name_mismatch:' || t WHEN 3 THEN 'tls_error:' || t WHEN 4 THEN 'connect_error:' || t ELSE 'error:' || t END AS url_error, 'timeout_or_error:' || t AS plain_error FROM e""",
    "compare_shares": f"""WITH {RESULTS}, s AS (SELECT day < {_LAST} - INTERVAL 14 DAY AS old, count_if(status = 'accepted') AS a, count_if(status = 'accepted' AND score >= 85) AS b FROM results GROUP BY 1),
o AS (SELECT coalesce(max(CASE WHEN old AND a > 0 THEN b / a END), 0.0) AS x, coalesce(max(CASE WHEN NOT old AND a > 0 THEN b / a END), 0.0) AS y FROM s) SELECT round(x, 9) AS old_share, round(y, 9) AS new_share, round(y - x, 9) AS change FROM o""",
    "key_sketches": f"""WITH {DAILY}, w AS (SELECT unnest([7, 14, 30]) AS days)
SELECT transport, CAST(days AS INT) AS days, count(DISTINCT resolver_key) AS n_keys, TRUE AS close FROM daily, w WHERE run_date <= {_LAST} AND datediff('day', run_date, {_LAST}) < days GROUP BY transport, days""",
    "normal_forms": """SELECT c_custkey, CASE WHEN c_custkey % 4 > 0 THEN CASE WHEN c_custkey % 60000 = 0 THEN '2001:db8::' ELSE '2001:db8::' || lower(to_hex(c_custkey % 60000)) END END AS address,
  concat_ws('|', ['dns-udp', 'dns-tcp'][c_custkey % 2 + 1], c_name, CASE WHEN c_custkey % 3 > 0 THEN c_nationkey END) AS key, ['dns-udp', 'dns-tcp'][c_custkey % 2 + 1] AS transport, c_name AS host,
  CAST(CASE WHEN c_custkey % 3 > 0 THEN c_nationkey ELSE 53 END AS INT) AS port, CASE WHEN c_custkey % 2 = 0 THEN 'a. a. ' || lower(c_name) || '.z.' ELSE 'A ' || c_name || '.Z.. a.' END AS answers FROM customer""",
    "discover_candidates": f"""SELECT 'customers' AS source, transport, host, port, NULL AS endpoint_url, NULL AS reason FROM (WITH {HOSTS} SELECT * FROM firsts WHERE good AND rn = 1)
UNION ALL SELECT 'customers', transport, CASE WHEN good THEN host ELSE ' ' || host END, port, NULL, CASE WHEN good THEN 'duplicate_dns_candidate' ELSE 'invalid_dns_host' END FROM (WITH {HOSTS} SELECT * FROM firsts WHERE NOT good OR rn > 1)
UNION ALL SELECT 'pages', 'doh', host, port, endpoint_url, NULL FROM ({_of("url_dedup")})
UNION ALL SELECT 'pages', 'doh', NULL, NULL, pages.url, reason FROM ({_of("url_rejects")}) r JOIN pages ON pages.page_id = r.ordinal""",
    "validate_candidates": f"""WITH asked AS (SELECT s_suppkey AS endpoint, r.r * 8 + q.q AS seq, q.q >= 6 AS nx FROM supplier, range(2) r(r), range(8) q(q)),
weighted AS (SELECT *, reason IS NULL AS ok, CASE WHEN reason = 'timeout_or_error' THEN 'timeout_or_error:x' ELSE reason END AS error, CASE reason WHEN 'nxdomain_spoofing' THEN 50 WHEN 'answer_mismatch' THEN 25 WHEN 'timeout_or_error' THEN 5 ELSE 0 END AS weight,
  CASE WHEN reason IS NULL OR reason <> 'timeout_or_error' THEN CAST((endpoint % 90) * 10 + seq AS DOUBLE) END AS latency_ms
  FROM (SELECT *, CASE WHEN (endpoint + seq) % (endpoint % 9 + 2) = 0 THEN 'timeout_or_error' WHEN nx AND endpoint % 7 = 1 THEN 'nxdomain_spoofing' WHEN NOT nx AND endpoint % 5 = 2 AND seq % 8 = 0 THEN 'answer_mismatch' END AS reason FROM asked)),
{metrics("endpoint")}, {scoring("scored", "m")},
firsts AS (SELECT endpoint, list(reason ORDER BY first) AS found FROM (SELECT endpoint, reason, min(seq) AS first FROM weighted WHERE reason IS NOT NULL GROUP BY ALL) GROUP BY endpoint)
SELECT endpoint AS candidate_id, score, status, correctness_score, availability_score, performance_score,
  array_to_string(list_concat(coalesce(found, []), list_filter([CASE WHEN timeouts * 2 > total THEN 'timeout_rate_high' END, CASE WHEN n = 0 THEN 'no_latency_samples' END, CASE WHEN p50 > 1500 THEN 'latency_very_high' WHEN p50 > 700 THEN 'latency_high' WHEN p50 > 100 THEN 'latency_moderate' END,
    CASE WHEN p95 > 1500 THEN 'latency_p95_high' END, CASE WHEN jitter > 400 THEN 'latency_jitter_high' END], lambda x: x IS NOT NULL)), '|') AS reasons FROM scored LEFT JOIN firsts USING (endpoint)""",
    "materialized_formats": f"""SELECT 'results ' || status AS format, count(*) AS n, CAST(sum(score) AS BIGINT) AS total FROM (WITH {RESULTS} SELECT * FROM results) GROUP BY status
UNION ALL SELECT 'text', count(*), NULL FROM ({_of("plain_list")}) UNION ALL SELECT 'urls', count(*), NULL FROM ({_of("url_list")}) UNION ALL SELECT 'forwarders', count(*), NULL FROM ({_of("forwarder_lines")})
UNION ALL SELECT 'backends', CAST(sum(n * len(string_split(line, chr(10)))) AS BIGINT), NULL FROM ({_of("backend_lines")})
UNION ALL SELECT 'filtered ' || reason, count(*), NULL FROM ({_of("dedup_rejects")}) GROUP BY reason""",
    "parts_round_trip": f"WITH {RESULTS} SELECT host, status, count(*) AS n, CAST(sum(score) AS BIGINT) AS total FROM results GROUP BY host, status",
    "quarantined_candidates": f"""WITH {STREAKS}, c AS (SELECT DISTINCT user_id AS endpoint, CAST(ts AS DATE) AS day FROM events),
m AS (SELECT endpoint, CAST(day AS VARCHAR) AS day, 'h' || CAST(endpoint % 40 AS VARCHAR) AS host, ['dns-udp', 'dns-tcp', 'doh'][endpoint % 3 + 1] AS transport FROM c),
j AS (SELECT m.*, q.*  EXCLUDE (host), endpoint % 10 > 0 AND transport <> 'doh' AND q.first_day + INTERVAL 90 DAY > {_LAST} AS out FROM m LEFT JOIN quarantine q USING (host))
SELECT endpoint, day, host, transport, CASE WHEN endpoint % 10 = 0 THEN 'earlier' WHEN out THEN 'historical_dns_quarantine' END AS reason,
  CASE WHEN out THEN 'historically rejected for 14 consecutive days; retry after ' || CAST(CAST(first_day + 90 AS DATE) AS VARCHAR) || '; last reasons: ' || replace(sig, '|', ', ') END AS detail, CASE WHEN endpoint % 10 = 0 THEN 'source' WHEN out THEN 'history' END AS stage FROM j""",
    "score_reports": f"""SELECT 'bands' AS report, band AS key, CAST(accepted AS DOUBLE) AS n FROM ({_of("score_bands")}) UNION ALL SELECT 'histogram', CAST(score AS VARCHAR), n FROM ({_of("score_histogram")})
UNION ALL SELECT 'reasons', band || ' ' || reason, n FROM ({_of("band_reasons")}) UNION ALL SELECT 'averages', band, avg_p95 FROM ({_of("band_averages")}) UNION ALL SELECT 'confidence', 'mean', mean_confidence FROM ({_of("confidence_stats")})
UNION ALL SELECT 'caps', cap, n FROM ({_of("top_caps")})""",
    "history_reports": f"""SELECT 'transports' AS report, transport AS key, n_keys AS n FROM ({_of("transport_breakdown")}) UNION ALL SELECT 'depth', CAST(days AS VARCHAR), n_keys FROM ({_of("history_depth")})
UNION ALL SELECT 'capped', 'capped', capped FROM ({_of("capped_count").replace("< 29", "< 14")})""",
    "corpus_generated": f"""WITH RECURSIVE {_GENERATED} SELECT kind, rejection_reason, count(*) AS n FROM voted WHERE rejection_reason IS NOT NULL GROUP BY ALL UNION ALL SELECT kind, 'kept', count(*) FROM voted WHERE accepted GROUP BY kind""",
    "corpus_validation": """WITH p AS (SELECT p_partkey AS part, p_partkey % 10 AS k, CASE WHEN p_partkey % 10 = 3 THEN 'p' || (p_partkey // 40) || 'x' ELSE 'p' || p_partkey END AS id FROM part),
e AS (SELECT part, list_filter([CASE WHEN k = 1 THEN 'unknown kind' END, CASE WHEN k = 8 THEN 'negative probe without parent_zone' END, CASE WHEN count(*) OVER (PARTITION BY id) > 1 THEN 'duplicate id' END], lambda x: x IS NOT NULL) AS l FROM p)
SELECT part, array_to_string(l, '|') AS errors FROM e WHERE len(l) > 0""",
}
