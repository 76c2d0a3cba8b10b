"""SQL of the registered queries for DuckDB, on the same tables."""

from __future__ import annotations

from .testviews import ERRORS

_ERRORS = "[" + ", ".join(f"'{e}'" for e in ERRORS) + "]"
_LAST = "(SELECT max(CAST(ts AS DATE)) FROM events)"
_SEVERE = "['nxdomain_spoofing', 'tls_name_mismatch', 'tls_error', 'answer_mismatch', 'doh_path_invalid']"

PROBES = f"""probes AS (
  SELECT user_id AS endpoint, event_id AS seq, CAST(ts AS DATE) AS day,
    strftime(ts, '%Y-%m-%d') || '-' || CAST(hour(ts) // 6 AS VARCHAR) AS run_id, event_type <> 'error' AS ok,
    CASE WHEN event_type <> 'error' THEN value * (1 + user_id % 8) END AS latency_ms,
    CASE WHEN event_type = 'error' THEN {_ERRORS}[CAST(json_extract(props, '$.k') AS INT) % 7 + 1] END AS error FROM events),
marked AS (
  SELECT *, CASE WHEN ok OR coalesce(error, '') = '' THEN NULL WHEN starts_with(error, 'nxdomain_spoofing') THEN 'nxdomain_spoofing'
    WHEN contains(error, 'tls_name_mismatch') THEN 'tls_name_mismatch' WHEN contains(error, 'tls_error') THEN 'tls_error'
    WHEN starts_with(error, 'timeout') THEN 'timeout_or_error' WHEN starts_with(error, 'http_error') THEN 'http_error'
    WHEN starts_with(error, 'connect_error') THEN 'connect_error' WHEN starts_with(error, 'doh_path_invalid') THEN 'doh_path_invalid'
    WHEN starts_with(error, 'answer_mismatch') THEN 'answer_mismatch' WHEN starts_with(error, 'unexpected_nxdomain') THEN 'unexpected_nxdomain'
    WHEN starts_with(error, 'unexpected_rcode') AND (contains(error, 'REFUSED') OR contains(error, 'SERVFAIL')) THEN 'unexpected_rcode_suspicious'
    WHEN starts_with(error, 'unexpected_rcode') THEN 'unexpected_rcode' ELSE 'error' END AS reason FROM probes),
weighted AS (
  SELECT *, CASE reason WHEN 'nxdomain_spoofing' THEN 50 WHEN 'tls_name_mismatch' THEN 40 WHEN 'tls_error' THEN 30 WHEN 'doh_path_invalid' THEN 25
    WHEN 'answer_mismatch' THEN 25 WHEN 'unexpected_nxdomain' THEN 15 WHEN 'unexpected_rcode' THEN 10 WHEN 'http_error' THEN 10 WHEN 'connect_error' THEN 10
    ELSE CASE WHEN reason IS NULL THEN 0 ELSE 5 END END AS weight FROM marked)"""


def metrics(keys: str, name: str = "m", source: str = "weighted", where: str = "TRUE") -> str:
    return f"""{name}0 AS (
  SELECT {keys}, count(*) AS total, count_if(ok) AS ok_count, CAST(sum(weight) AS BIGINT) AS penalty,
    count_if(NOT ok AND contains(coalesce(error, ''), 'timeout')) AS timeouts, list_distinct(list(reason) FILTER (reason IS NOT NULL)) AS errs,
    coalesce(list_sort(list(latency_ms) FILTER (ok AND latency_ms IS NOT NULL)), []) AS lat FROM {source} WHERE {where} GROUP BY {keys}),
{name}1 AS (
  SELECT *, len(lat) AS n, CASE WHEN len(lat) = 0 THEN NULL WHEN len(lat) % 2 = 0 THEN (lat[len(lat) // 2] + lat[len(lat) // 2 + 1]) / 2 ELSE lat[len(lat) // 2 + 1] END AS p50,
    lat[least(len(lat) * 95 // 100, len(lat) - 1) + 1] AS p95 FROM {name}0),
{name} AS (SELECT *, CASE WHEN n > 0 THEN greatest(0.0, p95 - p50) END AS jitter, coalesce(errs, []) AS error_reasons FROM {name}1)"""


AVAILABILITY = """CASE WHEN total = 0 THEN 0 WHEN 100 * ok_count >= 99 * total THEN 20 WHEN 100 * ok_count >= 95 * total THEN 19 WHEN 100 * ok_count >= 90 * total THEN 18
  WHEN 100 * ok_count >= 85 * total THEN 17 WHEN 100 * ok_count >= 80 * total THEN 16 WHEN 100 * ok_count >= 75 * total THEN 15 WHEN 100 * ok_count >= 70 * total THEN 14
  WHEN 100 * ok_count >= 65 * total THEN 13 WHEN 100 * ok_count >= 60 * total THEN 12 WHEN 100 * ok_count >= 55 * total THEN 11 WHEN 100 * ok_count >= 50 * total THEN 10
  ELSE 20 * ok_count // total END"""

_ENDPOINT = "endpoint % 3"


def scoring(name: str, source: str, history: bool = False) -> str:
    """CTEs from a metrics table to its scores; with history, source also has the stability columns."""
    h = {c: (c if history else "CAST(NULL AS BIGINT)") for c in ("runs_seen_7d", "runs_seen_30d", "success_days_7d", "success_days_30d", "consecutive_success_days", "consecutive_fail_days", "status_flaps_30d")}
    seen, flaps, fails = h["runs_seen_30d"], h["status_flaps_30d"], h["consecutive_fail_days"]
    points = f"""CASE WHEN {seen} IS NULL THEN 0 ELSE greatest(0, CASE WHEN {seen} >= 14 THEN 4 WHEN {seen} >= 7 THEN 2 WHEN {seen} >= 3 THEN 1 ELSE 0 END
      + CASE WHEN {seen} <= 0 THEN 0 WHEN 100 * {h["success_days_30d"]} >= 95 * {seen} THEN 3 WHEN 100 * {h["success_days_30d"]} >= 85 * {seen} THEN 2 WHEN 100 * {h["success_days_30d"]} >= 70 * {seen} THEN 1 ELSE 0 END
      + CASE WHEN {h["runs_seen_7d"]} <= 0 THEN 0 WHEN 100 * {h["success_days_7d"]} >= 95 * {h["runs_seen_7d"]} THEN 2 WHEN 100 * {h["success_days_7d"]} >= 80 * {h["runs_seen_7d"]} THEN 1 ELSE 0 END
      + CASE WHEN {h["consecutive_success_days"]} >= 14 THEN 1 ELSE 0 END - CASE WHEN {flaps} >= 5 THEN 4 WHEN {flaps} >= 3 THEN 2 ELSE 0 END
      - CASE WHEN {fails} >= 3 THEN 3 WHEN {fails} >= 1 THEN 1 ELSE 0 END) END"""
    return f"""{name}0 AS (
  SELECT *, CASE WHEN timeouts * 2 > total THEN 20 * timeouts // total ELSE 0 END AS tp,
    CASE WHEN n = 0 THEN 0 ELSE 100 - CASE WHEN p50 > 1500 THEN 30 WHEN p50 > 700 THEN 18 WHEN p50 > 300 THEN 8 WHEN p50 > 100 THEN 3 ELSE 0 END
      - CASE WHEN p95 > 2500 THEN 20 WHEN p95 > 1500 THEN 12 WHEN p95 > 800 THEN 6 WHEN p95 > 400 THEN 2 ELSE 0 END
      - CASE WHEN jitter > 900 THEN 12 WHEN jitter > 400 THEN 6 WHEN jitter > 150 THEN 2 ELSE 0 END END AS praw,
    {points} AS history_score,
    list_filter(list_concat(error_reasons, [CASE WHEN timeouts * 2 > total THEN 'timeout_rate_high' END, CASE WHEN n = 0 THEN 'no_latency_samples' END,
      CASE WHEN p50 > 1500 THEN 'latency_very_high' WHEN p50 > 700 THEN 'latency_high' WHEN p50 > 100 THEN 'latency_moderate' END,
      CASE WHEN p95 > 1500 THEN 'latency_p95_high' END, CASE WHEN jitter > 400 THEN 'latency_jitter_high' END,
      CASE WHEN {flaps} >= 5 THEN 'high_flapping' WHEN {flaps} >= 3 THEN 'moderate_flapping' END, CASE WHEN {fails} >= 3 THEN 'recent_failure_streak' END]), lambda x: x IS NOT NULL) AS rs
  FROM {source}),
{name}1 AS (
  SELECT *, CAST(greatest(0, 100 - penalty - tp) // 2 AS INT) AS correctness_score, CAST({AVAILABILITY} AS INT) AS availability_score, CAST(praw // 5 AS INT) AS performance_score,
    least(100, CASE WHEN total >= 20 THEN 30 WHEN total >= 10 THEN 25 WHEN total >= 5 THEN 15 WHEN total >= 3 THEN 10 ELSE 5 END
      + CASE WHEN n >= 15 THEN 20 WHEN n >= 8 THEN 15 WHEN n >= 4 THEN 10 WHEN n >= 1 THEN 5 ELSE 0 END
      + CASE WHEN {seen} IS NULL THEN 0 WHEN {seen} >= 21 THEN 35 WHEN {seen} >= 14 THEN 30 WHEN {seen} >= 7 THEN 20 WHEN {seen} >= 3 THEN 10 ELSE 5 END + 5) AS confidence_score,
    len(list_intersect(rs, list_concat({_SEVERE}, ['unexpected_rcode_suspicious']))) > 0 AS hard FROM {name}0),
{name}2 AS (SELECT *, correctness_score + availability_score + performance_score + history_score AS whole FROM {name}1),
{name}3 AS (SELECT *, CASE WHEN {seen} < 3 THEN least(whole, 90) WHEN {seen} < 7 THEN least(whole, 95) WHEN {seen} < 14 THEN least(whole, 98) ELSE whole END AS capped FROM {name}2),
{name}4 AS (SELECT *, CASE WHEN capped < 100 THEN NULL WHEN penalty + tp > 0 OR len(error_reasons) > 0 THEN 'correctness_issues' WHEN praw < 100 THEN 'performance_not_perfect' WHEN {seen} IS NULL THEN NULL
    WHEN {seen} < 14 THEN 'insufficient_history_for_100:' || CAST({seen} AS VARCHAR) || '_runs' WHEN {flaps} > 2 THEN 'too_much_flapping:' || CAST({flaps} AS VARCHAR) || '_flaps'
    WHEN {fails} > 0 THEN 'recent_failures' WHEN ok_count < total THEN 'imperfect_availability' WHEN confidence_score < 90 THEN 'low_confidence' END AS gate FROM {name}3),
{name}5 AS (SELECT *, CASE WHEN gate IS NOT NULL THEN 99 ELSE least(capped, 100) END AS opened FROM {name}4),
{name} AS (
  SELECT *, CAST(CASE WHEN hard AND opened > 59 THEN 59 ELSE opened END AS INT) AS score,
    CASE WHEN NOT hard AND opened >= 80 THEN 'accepted' WHEN NOT hard AND opened >= 60 THEN 'candidate' ELSE 'rejected' END AS status,
    list_sort(list_distinct(rs)) AS reasons,
    list_filter(['source_reliability_unknown', CASE WHEN capped < whole THEN 'insufficient_history:' || CAST({seen} AS VARCHAR) || '_runs' END, gate, CASE WHEN hard AND opened > 59 THEN 'hard_fail_cap' END], lambda x: x IS NOT NULL) AS caps
  FROM {name}5)"""


SCORED = f"{PROBES}, {metrics('endpoint, day')}, {scoring('scored', 'm')}"
RESULTS = f"""{SCORED}, results AS (
  SELECT *, ['dns-udp', 'dns-tcp', 'doh'][endpoint % 3 + 1] AS transport, 'h' || CAST(endpoint % 40 AS VARCHAR) AS host, CASE WHEN endpoint % 5 = 0 THEN 5353 ELSE 53 END AS port,
    CASE WHEN endpoint % 3 = 2 THEN 'https://h' || CAST(endpoint % 40 AS VARCHAR) || '/dns-query' END AS endpoint_url FROM scored)"""
STATUS = f"""{PROBES}, {metrics('endpoint, run_id', 'r')}, run_status AS (
  SELECT run_id, 'k|' || CAST(endpoint AS VARCHAR) AS resolver_key, 'h' || CAST(endpoint % 40 AS VARCHAR) AS host, ['dns-udp', 'dns-tcp', 'doh'][endpoint % 3 + 1] AS transport,
    CASE WHEN ok_count = total THEN 'accepted' WHEN 2 * (total - ok_count) <= total THEN 'candidate' ELSE 'rejected' END AS status, error_reasons AS reasons, p50, p95, jitter FROM r),
runs AS (SELECT run_id, min(day) AS run_date FROM probes GROUP BY run_id)"""
DAILY = f"""{STATUS}, daily0 AS (
  SELECT run_date, resolver_key, min(host) AS host, min(transport) AS transport, list_sort(list_distinct(flatten(list(s.reasons)))) AS reasons, count(*) AS runs, count_if(status = 'accepted') AS successful_runs,
    count_if(status = 'rejected') AS failed_runs, count(DISTINCT status) > 1 AS flapped_within_day, avg(p50) AS avg_p50, avg(p95) AS avg_p95, avg(jitter) AS avg_jitter
  FROM run_status s JOIN runs USING (run_id) GROUP BY run_date, resolver_key),
daily AS (
  SELECT *, CASE WHEN len(list_intersect(reasons, {_SEVERE})) > 0 THEN 'rejected' WHEN successful_runs > 0 AND failed_runs = 0 THEN 'accepted' WHEN failed_runs = runs THEN 'rejected' ELSE 'candidate' END AS day_status,
    array_to_string(reasons, '|') AS reasons_signature FROM daily0)"""
HOST_DAY = f"""{DAILY}, host_day AS (
  SELECT host, run_date, count_if(day_status = 'accepted') AS accepted_count, count_if(day_status = 'candidate') AS candidate_count, count_if(day_status = 'rejected') AS rejected_count,
    array_to_string(list_sort(list_distinct(flatten(list(reasons)))), '|') AS reasons_signature,
    CASE WHEN count_if(day_status = 'accepted') > 0 THEN 'accepted' WHEN count_if(day_status = 'candidate') > 0 THEN 'candidate' ELSE 'rejected' END AS status
  FROM daily WHERE transport IN ('dns-udp', 'dns-tcp') GROUP BY host, run_date)"""
STABLE = f"""{DAILY}, ranked AS (
  SELECT *, row_number() OVER w AS rn, lag(day_status) OVER w AS newer, first_value(day_status) OVER w AS newest, datediff('day', run_date, {_LAST}) AS age
  FROM daily WHERE run_date <= {_LAST} WINDOW w AS (PARTITION BY resolver_key ORDER BY run_date DESC)),
stable0 AS (
  SELECT resolver_key, count_if(age < 7) AS runs_seen_7d, count_if(age < 30) AS runs_seen_30d, count_if(age < 7 AND day_status = 'accepted') AS success_days_7d,
    count_if(age < 30 AND day_status = 'accepted') AS success_days_30d, coalesce(min(CASE WHEN age <> rn - 1 OR day_status <> newest OR day_status = 'candidate' THEN rn END) - 1, count(*)) AS streak,
    arg_max(day_status, run_date) AS latest_status, count_if(rn <= 30 AND newer IS NOT NULL AND newer <> day_status) AS status_flaps_30d,
    count_if(rn <= 30 AND flapped_within_day) AS flapped_within_day_30d, count_if(rn <= 30 AND flapped_within_day AND age < 7) AS flapped_within_day_7d FROM ranked GROUP BY resolver_key),
stable AS (
  SELECT *, CASE WHEN latest_status = 'accepted' THEN streak ELSE 0 END AS consecutive_success_days, CASE WHEN latest_status = 'rejected' THEN streak ELSE 0 END AS consecutive_fail_days
  FROM stable0 WHERE runs_seen_30d > 0)"""
STREAKS = f"""{HOST_DAY}, streaks AS (
  SELECT *, count(*) OVER w = 2 AND min(run_date) OVER w = run_date - INTERVAL 1 DAY AND count(CASE WHEN status <> 'rejected' THEN 1 END) OVER w = 0 AS streak
  FROM host_day WINDOW w AS (PARTITION BY host ORDER BY run_date ROWS BETWEEN 1 PRECEDING AND CURRENT ROW)),
quarantine AS (
  SELECT host, min(run_date) AS first_day, arg_min(reasons_signature, run_date) AS sig FROM streaks WHERE streak GROUP BY host)"""
BAND = "CASE WHEN score >= 100 THEN '100' WHEN score >= 95 THEN '95-99' WHEN score >= 85 THEN '85-94' WHEN score >= 70 THEN '70-84' ELSE '<70' END"
WIDE = "CASE WHEN score >= 95 THEN '95-100' WHEN score >= 85 THEN '85-94' WHEN score >= 70 THEN '70-84' ELSE '0-69' END"
BANDS = "bands AS (SELECT unnest(['100', '95-99', '85-94', '70-84', '<70']) AS band)"

URLS = r"""urls AS (
  SELECT page_id, url, trim(url) AS u FROM pages),
parts0 AS (
  SELECT *, lower(regexp_extract(u, '^([A-Za-z][A-Za-z0-9+.\-]*)://', 1)) AS scheme, regexp_replace(regexp_extract(u, '^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#]*)', 1), '^.*@', '') AS authority,
    regexp_extract(u, '^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*([^#]*)', 1) AS tail FROM urls),
parts AS (
  SELECT *, lower(regexp_extract(authority, '^([^:]*)', 1)) AS host, TRY_CAST(nullif(regexp_extract(authority, '^[^:]*:(.*)$', 1), '') AS INT) AS port,
    regexp_extract(tail, '^([^?]*)', 1) AS path0, regexp_extract(tail, '^[^?]*\?(.*)$', 1) AS query FROM parts0),
canon AS (
  SELECT *, CASE WHEN path0 = '' THEN '/dns-query' ELSE path0 END AS bare FROM parts),
canonical AS (
  SELECT *, CASE WHEN scheme = 'https' AND host <> '' THEN 'https://' || host || CASE WHEN port IS NULL OR port = 443 THEN '' ELSE ':' || CAST(port AS VARCHAR) END
    || CASE WHEN bare <> '/' AND bare LIKE '%/' AND query = '' THEN regexp_replace(bare, '/+$', '') ELSE bare END || CASE WHEN query = '' THEN '' ELSE '?' || query END END AS canonical FROM canon)"""
KEPT = f"{URLS}, firsts AS (SELECT *, row_number() OVER (PARTITION BY canonical ORDER BY page_id) AS rn FROM canonical)"

HOSTS = r"""hosts AS (
  SELECT c_custkey AS ordinal, '10.' || CAST(c_nationkey AS VARCHAR) || '.' || CAST(c_custkey % 37 AS VARCHAR) || '.' || CAST(c_custkey % 300 AS VARCHAR) AS host, 53 AS port,
    ['dns-udp', 'dns-tcp'][c_custkey % 2 + 1] AS transport, c_custkey % 300 <= 255 AS good FROM customer),
firsts AS (SELECT *, row_number() OVER (PARTITION BY host, port, transport, good ORDER BY ordinal) AS rn FROM hosts)"""
ANSWERS = """answers AS (
  SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS probe_id, l_partkey AS part, 'q' || CAST(l_partkey AS VARCHAR) AS qname, CAST(l_suppkey AS VARCHAR) AS resolver, l_returnflag AS answer,
    CASE WHEN l_linestatus = 'O' THEN 'NOERROR' WHEN l_returnflag = 'A' THEN 'NXDOMAIN' ELSE 'REFUSED' END AS rcode, CASE WHEN l_quantity > 45 THEN 'timed out' END AS error, l_linenumber % 2 AS check_no, l_tax >= 0.08 AS lost FROM lineitem)"""
_UNMATCHED = "timeout_or_error:massdns_unmatched"

ORACLE_SQL: dict[str, str] = {
    "score_endpoints": f"""WITH {SCORED} SELECT endpoint, CAST(day AS VARCHAR) AS day, score, status, correctness_score, availability_score, performance_score, CAST(confidence_score AS INT) AS confidence_score,
  array_to_string(reasons, '|') AS reasons, array_to_string(list_sort(caps), '|') AS score_caps_applied FROM scored""",
    "latency_stats": f"WITH {PROBES}, {metrics('endpoint')} SELECT endpoint, p50 AS p50_latency_ms, p95 AS p95_latency_ms, jitter AS jitter_ms, n AS latency_sample_count FROM m",
    "error_histogram": f"WITH {PROBES} SELECT endpoint, reason, count(*) AS n, CAST(sum(weight) AS BIGINT) AS penalty FROM weighted WHERE reason IS NOT NULL GROUP BY endpoint, reason",
    "availability_tier": f"WITH {PROBES}, {metrics('endpoint')} SELECT endpoint, ok_count, total - ok_count AS failed_count, total, CAST({AVAILABILITY} AS INT) AS points FROM m",
    "url_canonical": f"WITH {URLS} SELECT page_id, canonical FROM canonical",
    "resolver_key": f"WITH {URLS} SELECT page_id, 'doh|' || coalesce(canonical, url, '') AS key, 'doh' AS transport, coalesce(canonical, url, '') AS host FROM canonical",
    "url_dedup": f"WITH {KEPT} SELECT page_id AS ordinal, canonical AS endpoint_url, host, coalesce(port, 443) AS port, CASE WHEN bare <> '/' AND bare LIKE '%/' AND query = '' THEN regexp_replace(bare, '/+$', '') ELSE bare END AS path FROM firsts WHERE canonical IS NOT NULL AND rn = 1",
    "url_rejects": f"""WITH {KEPT} SELECT page_id AS ordinal, CASE WHEN canonical IS NULL THEN 'invalid_doh_url' ELSE 'duplicate_doh_candidate' END AS reason, coalesce(canonical, url) AS detail, 'normalize' AS stage
  FROM firsts WHERE canonical IS NULL OR rn > 1""",
    "dedup_keep_first": f"WITH {HOSTS} SELECT ordinal, host, port, transport FROM firsts WHERE good AND rn = 1",
    "dedup_rejects": f"WITH {HOSTS} SELECT ordinal, CASE WHEN good THEN 'duplicate_dns_candidate' ELSE 'invalid_dns_host' END AS reason, transport FROM firsts WHERE NOT good OR rn > 1",
    "scrape_links": """WITH found AS (SELECT page_id AS page, regexp_extract_all(html, 'href="([^"]+)"', 1) AS l FROM pages),
each AS (SELECT page, unnest(l) AS raw, unnest(range(len(l))) AS "at" FROM found), urls AS (SELECT page, "at", regexp_replace(raw, '[.,;)]+$', '') AS endpoint_url FROM each)
SELECT page, "at", endpoint_url FROM urls WHERE endpoint_url <> '' QUALIFY row_number() OVER (PARTITION BY endpoint_url ORDER BY page, "at") = 1""",
    "fill_down": """WITH rows AS (SELECT conv_id, turn, role, trim(split_part(text, chr(10), 1), '* ') AS head FROM conversations),
filled AS (SELECT *, last_value(CASE WHEN role = 'user' THEN head END IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn) AS provider FROM rows)
SELECT conv_id, turn, provider, 'https://x/' || CAST(conv_id AS VARCHAR) || '-' || CAST(turn AS VARCHAR) AS endpoint_url FROM filled WHERE role <> 'user'""",
    "reliability_split": """WITH rows AS (SELECT *, unnest(['dns-udp', 'dns-tcp']) AS transport FROM customer)
SELECT c_custkey AS ordinal, c_name AS host, transport, c_mktsegment AS provider, CASE WHEN c_acctbal / 10000 >= 0.5 THEN 1 ELSE 2 END AS n_meta,
  CASE WHEN c_acctbal / 10000 < 0.5 THEN 'source_reliability_below_min' END AS reason FROM rows""",
    "daily_rollup": f"""WITH {DAILY} SELECT CAST(run_date AS VARCHAR) AS run_date, resolver_key, host, transport, day_status, runs, successful_runs, failed_runs, flapped_within_day, reasons_signature,
  round(avg_p50, 6) AS avg_p50, round(avg_p95, 6) AS avg_p95, round(avg_jitter, 6) AS avg_jitter FROM daily""",
    "flapped_days": f"WITH {DAILY} SELECT CAST(run_date AS VARCHAR) AS run_date, resolver_key, day_status FROM daily WHERE flapped_within_day",
    "run_status_join": f"WITH {STATUS} SELECT CAST(run_date AS VARCHAR) AS run_date, run_id, resolver_key, status FROM runs JOIN run_status USING (run_id) WHERE run_date = {_LAST}",
    "host_day": f"WITH {HOST_DAY} SELECT host, CAST(run_date AS VARCHAR) AS run_date, status, accepted_count, candidate_count, rejected_count, reasons_signature FROM host_day",
    "stability_metrics": f"""WITH {STABLE} SELECT resolver_key, runs_seen_7d, runs_seen_30d, success_days_7d, success_days_30d, consecutive_success_days, consecutive_fail_days, status_flaps_30d, flapped_within_day_30d,
  flapped_within_day_7d, latest_status FROM stable""",
    "stability_panel": f"""WITH {DAILY} SELECT resolver_key, CAST(run_date AS VARCHAR) AS run_date, count(*) OVER a AS runs_seen_7d, count(*) OVER b AS runs_seen_30d,
  count(CASE WHEN day_status = 'accepted' THEN 1 END) OVER a AS success_days_7d, count(CASE WHEN day_status = 'accepted' THEN 1 END) OVER b AS success_days_30d FROM daily
  WINDOW a AS (PARTITION BY resolver_key ORDER BY run_date RANGE BETWEEN INTERVAL 6 DAYS PRECEDING AND CURRENT ROW), b AS (PARTITION BY resolver_key ORDER BY run_date RANGE BETWEEN INTERVAL 29 DAYS PRECEDING AND CURRENT ROW)""",
    "rejected_streak": f"WITH {STREAKS} SELECT host, CAST(run_date AS VARCHAR) AS run_date FROM streaks WHERE streak",
    "history_retention": f"WITH {DAILY} SELECT CAST(run_date AS VARCHAR) AS run_date, resolver_key FROM daily WHERE run_date >= {_LAST} - INTERVAL 9 DAY",
    "quarantine_state": f"""WITH {STREAKS} SELECT host, CAST(first_day AS VARCHAR) AS first_quarantined_on, CAST(CAST(first_day + INTERVAL 90 DAY AS DATE) AS VARCHAR) AS retry_after, sig AS reasons_signature, CAST(1 AS INT) AS cycles FROM quarantine""",
    "quarantine_renewal": f"""WITH RECURSIVE {HOST_DAY}, n AS (SELECT *, row_number() OVER (PARTITION BY host ORDER BY run_date) AS k FROM host_day),
fold AS (
  SELECT host, CAST(0 AS BIGINT) AS k, CAST(NULL AS DATE) AS f, CAST(NULL AS DATE) AS l, CAST(NULL AS DATE) AS r, CAST(NULL AS VARCHAR) AS sig, CAST(0 AS INT) AS c FROM (SELECT DISTINCT host FROM n)
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
    "quarantine_apply": f"""WITH {STREAKS}, c AS (SELECT DISTINCT user_id AS endpoint, CAST(ts AS DATE) AS day FROM events)
SELECT endpoint, CAST(day AS VARCHAR) AS day, CASE WHEN endpoint % 3 <> 2 AND q.first_day + INTERVAL 90 DAY > {_LAST} THEN 'historical_dns_quarantine' END AS reason
FROM c LEFT JOIN quarantine q ON q.host = 'h' || CAST(endpoint % 40 AS VARCHAR)""",
    "score_with_history": f"""WITH {STABLE}, {metrics('endpoint', 'm', 'weighted', f'day = {_LAST}')},
mh AS (SELECT m.*, s.* EXCLUDE (resolver_key) FROM m LEFT JOIN stable s ON s.resolver_key = 'k|' || CAST(endpoint AS VARCHAR)), {scoring('scored', 'mh', True)}
SELECT endpoint, score, status, CAST(history_score AS INT) AS history_score, CAST(confidence_score AS INT) AS confidence_score, array_to_string(reasons, '|') AS reasons, array_to_string(list_sort(caps), '|') AS score_caps_applied FROM scored""",
    "probe_plan": """WITH q AS (SELECT * FROM (VALUES (0, 'positive', 'A', 'example.com.'), (1, 'positive', 'AAAA', 'example.com.'), (2, 'positive', 'A', 'iana.org.'), (3, 'positive', 'NS', 'com.'),
  (4, 'positive', 'NS', 'org.'), (5, 'positive', 'NS', 'net.'), (6, 'nxdomain', 'A', NULL), (7, 'nxdomain', 'AAAA', NULL)) t(p, kind, rdtype, qname)),
c AS (SELECT s_suppkey AS candidate_id, ['dns-udp', 'dns-tcp', 'doh'][s_suppkey % 3 + 1] AS transport FROM supplier)
SELECT candidate_id, CAST(round AS INT) AS round, CAST(CASE WHEN transport = 'doh' THEN 1 ELSE 0 END + round * 8 + p AS BIGINT) AS seq, kind, rdtype,
  coalesce(qname, substr(sha256(CAST(candidate_id AS VARCHAR) || '-' || CAST(round AS VARCHAR) || '-' || CAST(p AS VARCHAR)), 1, 40) || '.invalid.') AS qname,
  transport || ':' || kind || ':' || kind || '-' || rdtype || '-' || CAST(p AS VARCHAR) AS probe_name FROM c, q, range(3) r(round)
UNION ALL SELECT candidate_id, 0, 0, 'tls', NULL, NULL, 'doh:tls:handshake' FROM c WHERE transport = 'doh'""",
    "evaluate_positive": f"""WITH {ANSWERS}, e AS (SELECT probe_id, CASE WHEN lost THEN '{_UNMATCHED}' WHEN error IS NOT NULL THEN 'timeout_or_error:timed out' WHEN rcode NOT IN ('NOERROR', 'NXDOMAIN') THEN 'unexpected_rcode:' || rcode
  WHEN rcode = 'NXDOMAIN' THEN 'unexpected_nxdomain' WHEN answer <> 'N' THEN 'answer_mismatch' END AS error FROM answers) SELECT probe_id, error IS NULL AS ok, error FROM e""",
    "evaluate_negative": f"""WITH {ANSWERS}, e AS (SELECT probe_id, CASE WHEN lost THEN '{_UNMATCHED}' WHEN error IS NOT NULL THEN 'timeout_or_error:timed out' WHEN rcode <> 'NXDOMAIN' THEN 'nxdomain_spoofing' END AS error
  FROM answers) SELECT probe_id, error IS NULL AS ok, error FROM e""",
    "unresolved_probes": f"WITH {ANSWERS} SELECT probe_id, FALSE AS ok, '{_UNMATCHED}' AS error FROM answers WHERE lost",
    "consensus_baseline": f"WITH {ANSWERS} SELECT qname, CASE WHEN count(DISTINCT answer) = 1 AND count(DISTINCT resolver) = 4 THEN min(answer) END AS agreed FROM answers WHERE error IS NULL GROUP BY qname",
    "quorum_exact": f"""WITH {ANSWERS}, w AS (SELECT *, error IS NULL AND (rcode <> 'NOERROR' OR answer <> 'N') AS wrong FROM answers),
g AS (SELECT qname, count(*) AS n, count(error) AS t, count_if(wrong) AS bad, arg_min(CASE WHEN rcode <> 'NOERROR' THEN rcode ELSE answer END, probe_id) FILTER (wrong) AS observed FROM w GROUP BY qname),
r AS (SELECT *, CASE WHEN bad > 0 THEN 'exact_rrset_mismatch' WHEN n - t < 2 THEN CASE WHEN t * 2 > n THEN 'timeout_rate_high' ELSE 'insufficient_baseline_consensus' END END AS rejection_reason FROM g)
SELECT qname, rejection_reason IS NULL AS accepted, rejection_reason, observed FROM r""",
    "quorum_consensus": f"""WITH {ANSWERS}, s AS (SELECT qname, answer, count(*) AS c FROM answers WHERE error IS NULL AND rcode = 'NOERROR' GROUP BY qname, answer),
b AS (SELECT qname, count(*) AS kinds, max(c) AS top, min(answer) AS answer FROM s GROUP BY qname), a AS (SELECT qname, count(*) AS n, count(error) AS t FROM answers GROUP BY qname),
r AS (SELECT a.qname, b.answer, CASE WHEN kinds IS NULL THEN 'timeout_rate_high' WHEN top < 2 THEN 'insufficient_baseline_consensus' WHEN kinds > 1 THEN 'baseline_disagreement' WHEN t * 2 > n THEN 'timeout_rate_high' END AS rejection_reason FROM a LEFT JOIN b USING (qname))
SELECT qname, rejection_reason IS NULL AS accepted, rejection_reason, CASE WHEN rejection_reason IS NULL THEN answer END AS agreed FROM r""",
    "quorum_negative": f"""WITH {ANSWERS}, w AS (SELECT *, error IS NULL AND rcode = 'NXDOMAIN' AS nx, error IS NULL AND rcode <> 'NXDOMAIN' AS bad FROM answers),
c AS (SELECT qname, check_no, count_if(nx) AS nx, count_if(bad) AS bad FROM w GROUP BY qname, check_no),
f AS (SELECT qname, check_no, CASE WHEN bad > 0 THEN 'negative_parent_wildcard_like' WHEN nx < 1 THEN 'insufficient_baseline_consensus' END AS reason FROM c)
SELECT qname, count(reason) = 0 AS accepted, arg_min(reason, check_no) FILTER (reason IS NOT NULL) AS rejection_reason FROM f GROUP BY qname""",
    "fifo_match": """WITH p AS (SELECT o_custkey % 50 AS resolver, o_custkey % 3 AS question, o_orderkey AS probe, row_number() OVER (PARTITION BY o_custkey % 50, o_custkey % 3 ORDER BY o_orderkey) AS k FROM orders),
e AS (SELECT CASE WHEN event_type <> 'error' THEN user_id % 60 END AS resolver, event_id % 3 AS question, event_id AS response FROM events),
r AS (SELECT *, row_number() OVER (PARTITION BY resolver, question ORDER BY response) AS k FROM e WHERE resolver IS NOT NULL),
m AS (SELECT p.question, probe, response FROM p LEFT JOIN r ON p.resolver = r.resolver AND p.question = r.question AND p.k = r.k),
p2 AS (SELECT question, probe, row_number() OVER (PARTITION BY question ORDER BY probe) AS k FROM m WHERE response IS NULL),
r2 AS (SELECT question, response, row_number() OVER (PARTITION BY question ORDER BY response) AS k FROM e WHERE resolver IS NULL)
SELECT * FROM m WHERE response IS NOT NULL UNION ALL SELECT coalesce(p2.question, r2.question) AS question, probe, response FROM p2 FULL JOIN r2 ON p2.question = r2.question AND p2.k = r2.k
UNION ALL SELECT r.question, NULL, response FROM r WHERE response NOT IN (SELECT response FROM m WHERE response IS NOT NULL)""",
    "route_batches": """SELECT l_orderkey AS a, l_linenumber AS b, l_returnflag AS rdtype, CAST((row_number() OVER (PARTITION BY l_returnflag ORDER BY l_orderkey * 10 + l_linenumber) - 1) // 500 AS INT) AS batch
FROM lineitem WHERE l_suppkey % 3 = 0 AND l_partkey % 4 <> 0""",
    "recent_days": f"WITH {DAILY} SELECT CAST(run_date AS VARCHAR) AS run_date, resolver_key, day_status FROM daily WHERE resolver_key = 'k|1' QUALIFY row_number() OVER (ORDER BY daily.run_date DESC) <= 7",
    "host_ports": "SELECT c_custkey, c_name AS host, CASE WHEN c_custkey % 3 = 1 THEN c_nationkey ELSE 53 END AS port FROM customer",
    "probe_ids": "SELECT p_partkey, lower('exact-' || replace(replace(p_name, ' ', '.'), '.', '-') || '-' || p_brand) AS probe_id FROM part",
    "results_payload": """WITH p AS (SELECT user_id AS endpoint, CASE WHEN event_type <> 'error' THEN value * (1 + user_id % 8) END AS x FROM events) SELECT endpoint, median(x) AS median_latency_ms FROM p GROUP BY endpoint""",
    "score_bands": f"""WITH {RESULTS}, {BANDS}, g AS (SELECT {BAND} AS band, count(*) AS n, count_if(status = 'accepted') AS accepted, count_if(status = 'candidate') AS candidate, count_if(status = 'rejected') AS rejected FROM results GROUP BY 1)
SELECT band, coalesce(n, 0) AS n, coalesce(accepted, 0) AS accepted, coalesce(candidate, 0) AS candidate, coalesce(rejected, 0) AS rejected FROM bands LEFT JOIN g USING (band)""",
    "score_histogram": f"WITH {RESULTS} SELECT score, count(*) AS n FROM results GROUP BY score",
    "band_reasons": f"""WITH {RESULTS}, e AS (SELECT {BAND} AS band, unnest(list_sort(list_distinct(list_concat(reasons, CASE WHEN FALSE THEN [''] ELSE [] END)))) AS reason FROM results WHERE score < 100),
g AS (SELECT band, reason, count(*) AS n FROM e GROUP BY band, reason) SELECT band, reason, n FROM g QUALIFY row_number() OVER (PARTITION BY band ORDER BY n DESC, reason) <= 5""",
    "band_averages": f"""WITH {RESULTS}, bands AS (SELECT unnest(['95-100', '85-94', '70-84', '0-69']) AS band), g AS (SELECT {WIDE} AS band, avg(p50) AS a, avg(p95) AS b, avg(jitter) AS c FROM results GROUP BY 1)
SELECT band, round(coalesce(a, 0.0), 6) AS avg_p50, round(coalesce(b, 0.0), 6) AS avg_p95, round(coalesce(c, 0.0), 6) AS avg_jitter, CAST(0.0 AS DOUBLE) AS avg_runs_seen_30d FROM bands LEFT JOIN g USING (band)""",
    "top_caps": f"WITH {RESULTS}, e AS (SELECT unnest(caps) AS cap FROM results) SELECT cap, count(*) AS n FROM e GROUP BY cap ORDER BY n DESC, cap LIMIT 10",
    "confidence_stats": f"WITH {RESULTS} SELECT round(avg(confidence_score), 6) AS mean_confidence, count_if(confidence_score > 0) AS with_confidence FROM results",
    "compare_bands": f"""WITH {RESULTS}, {BANDS}, g AS (SELECT {BAND} AS band, count_if(day < {_LAST} - INTERVAL 14 DAY) AS a, count_if(day >= {_LAST} - INTERVAL 14 DAY) AS b FROM results GROUP BY 1),
f AS (SELECT band, coalesce(a, 0) AS old_n, coalesce(b, 0) AS new_n FROM bands LEFT JOIN g USING (band))
SELECT band, old_n, new_n, new_n - old_n AS delta, round((new_n - old_n) * CAST(100 AS DOUBLE) / (sum(old_n) OVER ()), 6) AS delta_pct FROM f""",
    "status_totals": f"WITH {RESULTS} SELECT status, count(*) AS n FROM results GROUP BY status",
    "run_summary": f"""WITH {STREAKS}, latest AS (SELECT run_id, run_date FROM runs ORDER BY run_date DESC, run_id DESC LIMIT 1),
t AS (SELECT reason, count(*) AS n FROM (SELECT unnest(reasons) AS reason FROM daily WHERE day_status = 'rejected') GROUP BY reason ORDER BY n DESC, reason LIMIT 5)
SELECT CAST(run_date AS VARCHAR) AS latest_run_date, run_id AS latest_run_id, (SELECT count(*) FROM runs) AS runs_tracked,
  (SELECT count_if(status = 'accepted') FROM run_status s WHERE s.run_id = latest.run_id) AS accepted_count, (SELECT count_if(status = 'candidate') FROM run_status s WHERE s.run_id = latest.run_id) AS candidate_count,
  (SELECT count_if(status = 'rejected') FROM run_status s WHERE s.run_id = latest.run_id) AS rejected_count,
  (SELECT count(*) FROM quarantine WHERE first_day + INTERVAL 90 DAY > latest.run_date) AS quarantined_count, (SELECT string_agg(reason || '=' || CAST(n AS VARCHAR), ',' ORDER BY n DESC, reason) FROM t) AS top_reasons FROM latest""",
    "transport_breakdown": f"WITH {DAILY} SELECT transport, count(DISTINCT resolver_key) AS n_keys FROM daily GROUP BY transport",
    "history_depth": f"""WITH {DAILY}, m AS (SELECT max(run_date) AS d FROM daily) SELECT CAST(days AS INT) AS days, (SELECT count(DISTINCT resolver_key) FROM daily, m WHERE datediff('day', run_date, m.d) < days) AS n_keys FROM (VALUES (7), (14), (30)) t(days)""",
    "capped_count": f"WITH {STABLE} SELECT count(*) AS capped FROM daily d JOIN stable s USING (resolver_key) WHERE d.run_date = {_LAST} AND d.day_status = 'accepted' AND s.runs_seen_30d < 29",
    "even_shards": "SELECT c_custkey, CAST(ntile(7) OVER (ORDER BY c_name, c_custkey) - 1 AS INT) AS shard FROM customer",
    "sorted_export": """SELECT '{"s_suppkey":' || CAST(s_suppkey AS VARCHAR) || ',"s_name":"' || s_name || '","s_nationkey":' || CAST(s_nationkey AS VARCHAR) || '}' AS value FROM supplier""",
    "size_bounded_parts": """WITH RECURSIVE rows AS (SELECT doc_id, source, strlen(CAST(to_json({'doc_id': doc_id, 'text': text}) AS VARCHAR)) AS size, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS k FROM documents),
fold AS (
  SELECT source, doc_id, k, CAST(1 AS BIGINT) AS part, 2 + size AS used FROM rows WHERE k = 1
  UNION ALL
  SELECT r.source, r.doc_id, r.k, CASE WHEN used + 1 + r.size <= 20000 THEN part ELSE part + 1 END, CASE WHEN used + 1 + r.size <= 20000 THEN used + 1 + r.size ELSE 2 + r.size END
  FROM fold f JOIN rows r ON r.source = f.source AND r.k = f.k + 1) SELECT doc_id, part FROM fold""",
    "quota_select": """WITH RECURSIVE items AS (SELECT p_partkey AS ordinal, p_brand AS zone, p_type AS family, p_size % 3 AS want, row_number() OVER (ORDER BY p_partkey) AS k FROM part),
fold AS (
  SELECT CAST(0 AS BIGINT) AS k, CAST(0 AS BIGINT) AS ordinal, CAST(0 AS BIGINT) AS takes, CAST(MAP {} AS MAP(VARCHAR, BIGINT)) AS probes, CAST(MAP {} AS MAP(VARCHAR, BIGINT)) AS hosts
  UNION ALL
  SELECT k, ordinal, takes, map_concat(probes, MAP {zone: coalesce(element_at(probes, zone)[1], 0) + takes}), map_concat(hosts, MAP {family: coalesce(element_at(hosts, family)[1], 0) + CASE WHEN takes > 0 THEN 1 ELSE 0 END})
  FROM (SELECT i.k, i.ordinal, i.zone, i.family, f.probes, f.hosts,
      CAST(CASE WHEN coalesce(element_at(hosts, family)[1], 0) >= 25 THEN 0 ELSE least(want, greatest(40 - coalesce(element_at(probes, zone)[1], 0), 0)) END AS BIGINT) AS takes
    FROM fold f JOIN items i ON i.k = f.k + 1))
SELECT ordinal, takes FROM fold WHERE takes > 0""",
    "plain_list": f"WITH {RESULTS} SELECT DISTINCT host || ':' || CAST(port AS VARCHAR) AS line FROM results WHERE status = 'accepted' AND transport <> 'doh'",
    "url_list": f"WITH {RESULTS} SELECT DISTINCT endpoint_url AS line FROM results WHERE status = 'accepted' AND transport = 'doh'",
    "forwarder_lines": f"""WITH {RESULTS}, f AS (SELECT * FROM results WHERE status = 'accepted' AND transport <> 'doh' QUALIFY row_number() OVER (PARTITION BY host ORDER BY day, endpoint) = 1)
SELECT '    forward-addr: ' || host || CASE WHEN port <> 53 THEN '@' || CAST(port AS VARCHAR) ELSE '' END AS line FROM f""",
    "backend_lines": f"""WITH {RESULTS} SELECT CASE WHEN transport = 'doh' THEN 'newServer({{' || chr(10) || '  address="' || host || ':' || CAST(port AS VARCHAR) || '",' || chr(10) || '  tls="openssl",' || chr(10) || '  subjectName="' || host || '",' || chr(10)
  || '  dohPath="/dns-query"' || chr(10) || '}})' ELSE 'newServer({{address="' || host || ':' || CAST(port AS VARCHAR) || '"}})' END AS line, count(*) AS n FROM results WHERE status <> 'rejected' GROUP BY 1""",
    "host_outcomes": f"""WITH {RESULTS} SELECT host, CASE WHEN count_if(status = 'accepted') > 0 THEN 'accepted' WHEN count_if(status = 'candidate') > 0 THEN 'candidate' ELSE 'rejected' END AS status,
  count_if(status = 'accepted') AS accepted_count, count_if(status = 'candidate') AS candidate_count, count_if(status = 'rejected') AS rejected_count,
  arg_min(status, endpoint) FILTER (transport = 'dns-udp') AS udp_status, arg_min(status, endpoint) FILTER (transport = 'dns-tcp') AS tcp_status,
  array_to_string(list_sort(list_distinct(flatten(list(reasons)))), '|') AS reasons_signature FROM results WHERE day = {_LAST} AND transport <> 'doh' GROUP BY host""",
}
