"""Column functions on names, keys, errors and answers of endpoints. Built-in expressions only, never raising on dirty input."""

from __future__ import annotations

import ipaddress

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Reason codes that reject a whole day, and with the last one cap a score.
SEVERE_REASONS = ("answer_mismatch", "doh_path_invalid", "nxdomain_spoofing", "tls_error", "tls_name_mismatch")
HARD_FAIL_REASONS = (*SEVERE_REASONS, "unexpected_rcode_suspicious")
PLAIN_TRANSPORTS = ("dns-udp", "dns-tcp")
IPV4 = r"^(25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])(\.(25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])){3}$"


def classify_error(error: Column) -> Column:
    """Reason code of a probe's error text; the first fitting rule counts."""
    suspicious = error.contains("REFUSED") | error.contains("SERVFAIL")
    starts = lambda p: error.startswith(p)
    return (
        F.when(starts("nxdomain_spoofing"), "nxdomain_spoofing")
        .when(error.contains("tls_name_mismatch"), "tls_name_mismatch")
        .when(error.contains("tls_error"), "tls_error")
        .when(starts("timeout"), "timeout_or_error")
        .when(starts("http_error"), "http_error")
        .when(starts("connect_error"), "connect_error")
        .when(starts("doh_path_invalid"), "doh_path_invalid")
        .when(starts("answer_mismatch"), "answer_mismatch")
        .when(starts("unexpected_nxdomain"), "unexpected_nxdomain")
        .when(starts("unexpected_rcode") & suspicious, "unexpected_rcode_suspicious")
        .when(starts("unexpected_rcode"), "unexpected_rcode")
        .otherwise("error")
    )


def has_any(reasons: Column, codes: tuple[str, ...]) -> Column:
    return F.coalesce(F.arrays_overlap(reasons, F.array(*[F.lit(c) for c in codes])), F.lit(False))


def has_hard_fail(reasons: Column) -> Column:
    return has_any(reasons, HARD_FAIL_REASONS)


def is_severe(reasons: Column) -> Column:
    return has_any(reasons, SEVERE_REASONS)


def reasons_signature(reasons: Column) -> Column:
    """Sorted distinct non-empty reasons, joined by "|"."""
    return F.array_join(F.array_sort(F.array_distinct(F.filter(reasons, lambda r: r != ""))), "|")


def union_reasons(reasons: Column) -> Column:
    """Aggregate: the sorted set of all reasons of a group."""
    return F.array_sort(F.array_distinct(F.flatten(F.collect_list(reasons))))


@F.pandas_udf(T.StringType())
def _ipv6(host: pd.Series) -> pd.Series:
    def canonical(text):
        try:
            return str(ipaddress.ip_address(text)) if text else None
        except ValueError:
            return None

    return host.map(canonical).astype(object)


def normalize_ip(host: Column) -> Column:
    """Canonical text of an address, null if it is none. Only text with ":" leaves the JVM."""
    trimmed = F.trim(host)
    return F.when(trimmed.rlike(IPV4), trimmed).when(trimmed.contains(":"), _ipv6(F.when(trimmed.contains(":"), trimmed)))


def normalize_ipv4(host: Column) -> Column:
    """Canonical dotted text, null if it is none."""
    trimmed = F.trim(host)
    return F.when(trimmed.rlike(IPV4), trimmed)


def url_parts(url: Column) -> dict[str, Column]:
    """scheme, host (lower-cased), port (int, null if absent), bad_port, path and query of a URL; null where it has none."""
    text = F.trim(url)
    rest = F.regexp_extract(text, r"^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#]*)", 1)
    authority = F.regexp_replace(rest, r"^.*@", "")
    host = F.lower(F.regexp_extract(authority, r"^(\[[^\]]*\]|[^:]*)", 1))
    port_text = F.regexp_extract(authority, r"^(?:\[[^\]]*\]|[^:]*):(.*)$", 1)
    port = port_text.try_cast("int")
    tail = F.regexp_extract(text, r"^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*([^#]*)", 1)
    return {
        "scheme": F.lower(F.regexp_extract(text, r"^([A-Za-z][A-Za-z0-9+.\-]*)://", 1)),
        "host": F.when(host != "", host),
        "port": port,
        "bad_port": (port_text != "") & (port.isNull() | ~port_text.rlike("^[0-9]+$") | (port > 65535)),
        "path": F.regexp_extract(tail, r"^([^?]*)", 1),
        "query": F.regexp_extract(tail, r"^[^?]*\?(.*)$", 1),
    }


def canonical_url(url: Column) -> Column:
    """Canonical https URL, or null: host lower-cased, user, fragment and port 443 dropped, path case and query kept,
    an empty path is /dns-query, a trailing slash goes if there is no query."""
    p = url_parts(url)
    bare = F.when(p["path"] == "", "/dns-query").otherwise(p["path"])
    stripped = F.regexp_replace(bare, r"/+$", "")
    path = F.when((bare != "/") & bare.endswith("/") & (p["query"] == ""), F.when(stripped == "", "/").otherwise(stripped)).otherwise(bare)
    port = F.when(p["port"].isNull() | (p["port"] == 443), "").otherwise(F.concat(F.lit(":"), p["port"].cast("string")))
    query = F.when(p["query"] == "", "").otherwise(F.concat(F.lit("?"), p["query"]))
    fits = (p["scheme"] == "https") & p["host"].isNotNull() & ~p["bad_port"]
    return F.when(fits, F.concat(F.lit("https://"), p["host"], port, path, query))


def resolver_key(transport: Column, host: Column, port: Column, url: Column) -> Column:
    """doh|canonical url, or transport|host|port."""
    return F.when(transport == "doh", F.concat(F.lit("doh|"), F.coalesce(canonical_url(url), url, F.lit("")))).otherwise(
        F.concat_ws("|", transport, host, port.cast("string"))
    )


def parse_key(key: Column) -> Column:
    """struct(transport, host, port); no separator: ('unknown', key, null); a bad port is 53."""
    parts = F.split(key, r"\|", 3)
    rest = F.regexp_replace(key, r"^[^|]*\|", "")
    plain = F.struct(
        parts[0].alias("transport"), parts[1].alias("host"), F.coalesce(F.try_element_at(parts, F.lit(3)).try_cast("int"), F.lit(53)).alias("port")
    )
    url = F.struct(F.lit("doh").alias("transport"), rest.alias("host"), F.lit(None).cast("int").alias("port"))
    unknown = F.struct(F.lit("unknown").alias("transport"), key.alias("host"), F.lit(None).cast("int").alias("port"))
    return F.when(~key.contains("|"), unknown).when(parts[0] == "doh", url).otherwise(plain)


def display(transport: Column, host: Column, port: Column, url: Column) -> Column:
    return F.when(transport == "doh", F.concat(F.lit("doh:"), url)).otherwise(F.concat_ws(":", transport, host, port.cast("string")))


def normalize_answers(answers: Column, rdtype: Column) -> Column:
    """Names lower-cased with one trailing dot for NS, CNAME and PTR; sorted, duplicates kept."""
    named = F.transform(answers, lambda a: F.concat(F.regexp_replace(F.lower(a), r"\.+$", ""), F.lit(".")))
    return F.array_sort(F.when(rdtype.isin("NS", "CNAME", "PTR"), named).otherwise(answers))


def parse_endpoint(endpoint: Column) -> Column:
    """struct(host, port): exactly one ":" splits off a port, else port 53 (IPv6 text has more)."""
    one = F.length(endpoint) - F.length(F.replace(endpoint, F.lit(":"))) == 1
    port = F.substring_index(endpoint, ":", -1).try_cast("int")
    return F.struct(
        F.when(one, F.substring_index(endpoint, ":", 1)).otherwise(endpoint).alias("host"), F.when(one, F.coalesce(port, F.lit(53))).otherwise(F.lit(53)).alias("port")
    )


def probe_id(prefix: Column, name: Column, qtype: Column) -> Column:
    return F.lower(F.concat_ws("-", prefix, F.replace(F.regexp_replace(name, r"\.+$", ""), F.lit("."), F.lit("-")), qtype))


def probe_name(transport: Column, kind: Column, label: Column) -> Column:
    return F.concat_ws(":", transport, kind, label)


def render_qname(template: Column, seed: Column, length: int = 40) -> Column:
    """The template with its label filled by a seeded hash, so that a plan is the same when it is run again."""
    return F.replace(template, F.lit("{uuid}"), F.substring(F.sha2(seed.cast("string"), 256), 1, length))


def error_text(prefix: str, error: Column) -> Column:
    return F.concat(F.lit(prefix), F.substring(error, 1, 80))


def quarantine_detail(retry_after: Column, reasons: Column) -> Column:
    why = F.array_join(reasons, ", ")
    return F.concat(F.lit("historically rejected for 14 consecutive days; retry after "), F.date_format(retry_after, "yyyy-MM-dd"), F.lit("; last reasons: "), why)


def by_status(*statuses: str) -> Column:
    return F.col("status").isin(*statuses)


def by_transport(*transports: str) -> Column:
    return F.col("transport").isin(*transports)


def endpoint_order() -> list[Column]:
    empty = lambda c: F.coalesce(F.col(c), F.lit(""))
    return [F.col("transport"), empty("endpoint_url"), empty("host"), F.coalesce(F.col("port"), F.lit(0)), empty("path")]


def priority_order() -> list[Column]:
    """Batched endpoints first (udp, port 53), then plain, then by URL."""
    batched = F.col("transport").eqNullSafe("dns-udp") & F.col("port").eqNullSafe(53)
    return [F.when(batched, 0).when(F.col("transport").isin(*PLAIN_TRANSPORTS), 1).otherwise(2), *endpoint_order()]


def filtered_order() -> list[Column]:
    return [F.col("stage"), F.col("reason"), *endpoint_order()]
