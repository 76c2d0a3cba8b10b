"""Empirical-Bayes host reputation for URLs, with an explicit rule list on top.

Labelled page outcomes (good or bad) are counted per host, registered domain and suffix. Each level is a
beta-binomial prior for the level below: the whole corpus shrinks the suffixes, a suffix its domains, a domain
its hosts. A host is blocked when the lower bound of its posterior bad rate is above a limit, so a host is only
blocked on evidence. Everything is built-in column functions, grouped counts and equi-joins on the host.

Defined results: a null url, or one without "://", has an empty host and path, fits no rule and is allowed. Hosts
without labelled pages take the bound of their domain or suffix; without either they are allowed. Outcomes that are
null are ignored, so empty outcomes allow every page that no rule blocks. Repeated pages are judged row by row.
Columns of the pages come back unchanged whatever their names, but for those named like the added ones, which are
replaced. Domain and suffix leave out user info, a port and a closing dot; an IPv4 host is its own domain and suffix.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, checkpointed

#: Second-level labels under which a registry sells names, so that the suffix has two labels.
REGISTRY_LABELS = ("ac", "co", "com", "edu", "gov", "net", "org")


def url_host(url: Column) -> Column:
    """After the first "://" up to "/", "?", "#" or the end, A-Z lower-cased; null or no "://": empty."""
    return F.coalesce(ascii_lower(F.regexp_extract(_after_scheme(url), r"^[^/?#]*", 0)), F.lit(""))


def url_path(url: Column) -> Column:
    """After the host up to "?", "#" or the end."""
    return F.coalesce(F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def _after_scheme(url: Column) -> Column:
    at = F.locate("://", url)
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))


def rule_for(host: Column, path: Column, rules: list[tuple[str, str]]) -> Column:
    """struct(rule, verdict) of the longest fitting rule, or null. Ties of length go to the smaller rule text.

    rules: (verdict, "host/path") pairs; their number is the caller's, so they are one literal array.
    """
    if not rules:
        return F.lit(None).cast("struct<rule:string,verdict:string>")
    table = F.array(
        *[
            F.struct(
                F.lit(-len(text)).alias("order"), F.lit(text).alias("rule"), F.lit(verdict).alias("verdict"),
                F.lit(text.partition("/")[0]).alias("host"), F.lit("/" + text.partition("/")[2]).alias("path"),
            )
            for verdict, text in rules
        ]
    )
    fits = F.filter(
        table,
        lambda r: ((host == r["host"]) | F.endswith(host, F.concat(F.lit("."), r["host"]))) & F.startswith(path, r["path"]),
    )
    best = F.array_min(fits)
    return F.when(F.size(fits) > 0, F.struct(best["rule"].alias("rule"), best["verdict"].alias("verdict")))


def with_levels(df: DataFrame) -> DataFrame:
    """Adds `_domain` and `_suffix` of the column `_host`."""
    bare = F.regexp_replace("_host", r"(?s)^.*@|\.?:[0-9]*\z|\.\z", "")
    labels = F.split(bare, r"\.")
    two = F.size(labels) >= 3
    deep = two & F.element_at(labels, -2).isin(*REGISTRY_LABELS) & (F.length(F.element_at(labels, -1)) == 2)
    keep = F.when(bare.rlike(r"^[0-9]{1,3}(\.[0-9]{1,3}){3}\z"), 4).when(deep, 2).otherwise(1)
    suffix = F.array_join(F.slice(labels, -keep, keep), ".")
    return df.withColumns(
        {
            "_suffix": suffix,
            "_domain": F.array_join(F.slice(labels, -F.least(keep + 1, F.size(labels)), F.least(keep + 1, F.size(labels))), "."),
        }
    )


def _strength(n: Column, bad: Column, prior: Column, low: float, high: float) -> Column:
    """Concentration of a beta prior by moments, for an aggregate over children of one mean `prior`."""
    seen, mean = F.sum(F.when(n > 1, n)), F.max(prior)
    spread = F.sum(F.when(n > 1, n * (bad / n - prior) ** 2)) / seen
    noise = F.sum(F.when(n > 1, prior * (1 - prior))) / seen
    between = F.greatest(spread - noise, F.lit(0.0))
    found = F.when(between > 0, mean * (1 - mean) / between - 1)
    return F.least(F.greatest(F.coalesce(found, F.lit(high)), F.lit(low)), F.lit(high))


def host_reputation(
    outcomes: DataFrame, z: float = 1.645, low: float = 2.0, high: float = 200.0
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Posterior tables (suffixes, domains, hosts) from rows `host`, `bad` (0 or 1).

    Every table has n, bad_rate (posterior mean) and lower (mean - z standard deviations). Counting is one partial
    aggregate per host; the upper levels aggregate the host table, which no hot host can skew.
    """
    seen = outcomes.where(F.col("bad").isNotNull() & F.col("host").isNotNull())
    counted = seen.groupBy(F.col("host").alias("_host")).agg(F.count("*").cast("double").alias("n"), F.sum("bad").cast("double").alias("b"))
    hosts = checkpointed(with_levels(counted))
    domains = hosts.groupBy("_suffix", "_domain").agg(F.sum("n").alias("n"), F.sum("b").alias("b"))
    suffixes = domains.groupBy("_suffix").agg(F.sum("n").alias("n"), F.sum("b").alias("b"))
    total = suffixes.agg(F.coalesce(F.sum("n"), F.lit(0.0)).alias("n"), F.coalesce(F.sum("b"), F.lit(0.0)).alias("b")).first()
    overall = (total["b"] + 0.5) / (total["n"] + 1.0)

    def shrunk(level: DataFrame, parent: list[str]) -> DataFrame:
        """level has n, b, the prior mean _p and the weight _w of that mean.

        The strength is shared by all rows of one parent, and no prior counts for more pages than its mean rests on.
        """
        strength = level.groupBy(*parent).agg(_strength(F.col("n"), F.col("b"), F.col("_p"), low, high).alias("_m"))
        out = level.join(strength, parent).withColumn("_m", F.least("_m", "_w"))
        alpha, weight = F.col("b") + F.col("_m") * F.col("_p"), F.col("n") + F.col("_m")
        mean = alpha / weight
        return out.withColumns(
            {"mean": mean, "weight": weight, "lower": F.greatest(mean - z * F.sqrt(mean * (1 - mean) / (weight + 1)), F.lit(0.0))}
        ).drop("_m", "_p", "_w")

    suffix_post = checkpointed(shrunk(suffixes.withColumns({"_all": F.lit(1), "_p": F.lit(overall), "_w": F.lit(total["n"] + 1.0)}), ["_all"]).drop("_all"))
    domain_post = checkpointed(shrunk(domains.join(suffix_post.select("_suffix", F.col("mean").alias("_p"), F.col("weight").alias("_w")), "_suffix"), ["_suffix"]))
    host_post = shrunk(hosts.join(domain_post.select("_suffix", "_domain", F.col("mean").alias("_p"), F.col("weight").alias("_w")), ["_suffix", "_domain"]), ["_suffix", "_domain"])
    return suffix_post, domain_post, host_post


def filter_urls(
    pages: DataFrame,
    outcomes: DataFrame,
    rules: list[tuple[str, str]] = (),
    url: str = "url",
    limit: float = 0.5,
    z: float = 1.645,
) -> DataFrame:
    """pages with host, path, rule, verdict and the posterior `bad_lower` that gave it.

    outcomes: rows `host` (as url_host gives it) and `bad` (0 or 1). A fitting rule decides; else the page is
    blocked when `bad_lower` of its host (domain, suffix if the host has no labelled page) is above `limit`.
    pages keep their columns; columns named like the added ones are replaced.
    """
    suffixes, domains, hosts = host_reputation(outcomes, z)
    added = ("host", "path", "rule", "verdict", "bad_lower")
    kept = [c for c in pages.columns if c not in added]
    # the pages' own columns travel in one struct, so that no name of theirs meets a name used here
    judged = pages.select(F.struct(*[pages[f"`{c}`"] for c in kept]).alias("page"), url_host(F.col(url)).alias("_host"), url_path(F.col(url)).alias("path"))
    # one lookup row per distinct host: the joins below it see each host once, whatever its share of the pages
    distinct = with_levels(judged.groupBy("_host").agg(F.count("*").alias("_n")))
    lookup = (
        distinct.join(hosts.select("_host", F.col("lower").alias("_h")), "_host", "left")
        .join(domains.select("_suffix", "_domain", F.col("lower").alias("_d")), ["_suffix", "_domain"], "left")
        .join(suffixes.select("_suffix", F.col("lower").alias("_s")), "_suffix", "left")
        .select("_host", F.coalesce("_h", "_d", "_s", F.lit(0.0)).alias("bad_lower"))
    )
    found = judged.join(lookup, "_host", "left")
    found = found.withColumn("_fit", rule_for(F.col("_host"), F.col("path"), list(rules)))
    own = F.when(F.col("bad_lower") > limit, "block").otherwise("allow")
    return found.select(
        *[F.col("page").getField(c).alias(c) for c in kept],
        F.col("_host").alias("host"), "path", F.col("_fit.rule").alias("rule"),
        F.coalesce(F.col("_fit.verdict"), own).alias("verdict"), "bad_lower",
    )
