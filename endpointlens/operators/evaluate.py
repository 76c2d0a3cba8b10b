"""Probe plans, answers held against expectations, votes over baseline answers, first-in first-out matching."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.text import error_text, normalize_answers, probe_name, render_qname
from ..plans.lineage import checkpointed
from .ranks import ahead, largest, same, slices


def probe_plan(candidates: DataFrame, corpus: DataFrame, rounds: int = 3) -> DataFrame:
    """Every candidate in every round asks every entry: positives, then negatives; URL candidates first test TLS.

    corpus: position (from 0), kind ('positive' or 'nxdomain'), label, qname, qname_template, rdtype. It is a
    configured list of questions, folded into one array that every candidate row explodes.
    """
    entry = F.struct("nx", "position", "kind", "label", "qname", "qname_template", "rdtype")
    questions = corpus.withColumn("nx", (F.col("kind") == "nxdomain").cast("int")).agg(F.array_sort(F.collect_list(entry)).alias("_q"))
    asked = candidates.join(F.broadcast(questions.withColumn("_one", F.lit(1))), F.when(F.col("candidate_id").isNotNull(), 1) == F.col("_one"))
    each = asked.withColumn("round", F.explode(F.sequence(F.lit(0), F.lit(rounds - 1)))).select("*", F.posexplode("_q").alias("_p", "_e"))
    tls = F.when(F.col("transport") == "doh", 1).otherwise(0)
    seq = (tls + F.col("round") * F.size("_q") + F.col("_p")).cast("long")
    plan = each.select(
        "candidate_id", "transport", "round", seq.alias("seq"), F.col("_e.kind").alias("kind"), F.col("_e.label").alias("label"), F.col("_e.rdtype").alias("rdtype"),
        F.coalesce(F.col("_e.qname"), render_qname(F.col("_e.qname_template"), F.concat_ws("-", "candidate_id", "round", "_p"))).alias("qname"),
        probe_name(F.col("transport"), F.col("_e.kind"), F.col("_e.label")).alias("probe_name"),
    )
    first = candidates.where(F.col("transport") == "doh").select(
        "candidate_id", "transport", F.lit(0).alias("round"), F.lit(0).cast("long").alias("seq"), F.lit("tls").alias("kind"), F.lit("handshake").alias("label"),
        F.lit(None).cast("string").alias("rdtype"), F.lit(None).cast("string").alias("qname"), F.lit("doh:tls:handshake").alias("probe_name"),
    )
    return plan.unionByName(first)


def transport_error(plain: bool, kind: Column, error: Column, code: Column | None = None) -> Column:
    """Error text of a failed exchange; plain transports know one kind only."""
    if plain:
        return error_text("timeout_or_error:", error)
    return (
        F.when(kind == "timeout", error_text("timeout:", error))
        .when(kind == "http", F.concat(F.lit("http_error:"), (code if code is not None else F.lit(None)).cast("string")))
        .when(kind == "tls_name", error_text("tls_name_mismatch:", error))
        .when(kind == "tls", error_text("tls_error:", error))
        .when(kind == "connect", error_text("connect_error:", error))
        .otherwise(error_text("error:", error))
    )


def baseline_consensus(observations: DataFrame, n_resolvers: int) -> DataFrame:
    """(qname, rdtype, agreed): the one sorted answer set of all baseline resolvers, null where they don't agree."""
    ok = observations.where("error is null").select("qname", "rdtype", "resolver", F.array_sort("answers").alias("_a"))
    question = ["qname", "rdtype"]
    # the few sets of a question are made distinct before anything is sorted; resolvers are only counted where there is one
    # set. The cut keeps the optimizer from dropping the distinct sets, which would sort all observations
    sets = ok.groupBy(*question, "_a").agg(F.lit(1).alias("_one")).groupBy(*question).agg(F.count("_a").alias("_sets"), F.max("_a").alias("_set"))
    sets = checkpointed(sets)
    one = sets.where("_sets = 1").select(F.col("qname").alias("_q"), F.col("rdtype").alias("_t"))
    of_one = same([F.col("qname"), F.col("rdtype")], [F.col("_q"), F.col("_t")])
    named = ok.where("resolver is not null").join(one, of_one, "left_semi").groupBy(*question, "resolver").agg(F.lit(1).alias("_one"))
    n = named.groupBy(F.col("qname").alias("_q"), F.col("rdtype").alias("_t")).agg(F.count("*").alias("_n"))
    agreed = F.when(F.col("_n") == n_resolvers, F.col("_set"))
    return sets.join(n, of_one, "left").select(*question, agreed.alias("agreed"))


def evaluate_positive(plan: DataFrame, observations: DataFrame, baseline: DataFrame | None = None) -> DataFrame:
    """plan (probe_id, expected_mode, expected_answers, rdtype, qname) with ok and error of its observation."""
    out = plan.join(observations.select("probe_id", "rcode", "answers", F.col("error").alias("_error")), "probe_id", "left")
    out = out.join(baseline, ["qname", "rdtype"], "left") if baseline is not None else out.withColumn("agreed", F.lit(None).cast("array<string>"))
    expected = F.when(F.col("expected_mode") == "exact_rrset", normalize_answers(F.col("expected_answers"), F.col("rdtype"))).otherwise(F.col("agreed"))
    same = normalize_answers(F.col("answers"), F.col("rdtype")) == expected
    error = (
        F.when(F.col("rcode").isNull() & F.col("_error").isNull(), "timeout_or_error:massdns_unmatched")
        .when(F.col("_error").isNotNull(), error_text("timeout_or_error:", F.col("_error")))
        .when(~F.col("rcode").isin("NOERROR", "NXDOMAIN"), F.concat(F.lit("unexpected_rcode:"), "rcode"))
        .when(F.col("rcode") == "NXDOMAIN", "unexpected_nxdomain")
        .when((F.col("expected_mode") == "consensus_match") & F.col("agreed").isNull(), "baseline_error")
        .when(~F.coalesce(same, F.lit(False)), "answer_mismatch")
    )
    return out.withColumns({"error": error, "ok": error.isNull()}).drop("_error", "agreed")


def evaluate_negative(plan: DataFrame, observations: DataFrame) -> DataFrame:
    """plan (probe_id) with ok and error: any answer but NXDOMAIN is spoofed."""
    out = plan.join(observations.select("probe_id", "rcode", F.col("error").alias("_error")), "probe_id", "left")
    error = (
        F.when(F.col("rcode").isNull() & F.col("_error").isNull(), "timeout_or_error:massdns_unmatched")
        .when(F.col("_error").isNotNull(), error_text("timeout_or_error:", F.col("_error")))
        .when(F.col("rcode") != "NXDOMAIN", "nxdomain_spoofing")
    )
    return out.withColumns({"error": error, "ok": error.isNull()}).drop("_error")


def vote_exact(results: DataFrame, keys: list[str], quorum: int = 2) -> DataFrame:
    """results: keys, seq, rcode, answers, expected, rdtype, error. Any mismatch rejects; then the quorum counts."""
    observed = normalize_answers(F.col("answers"), F.col("rdtype"))
    failed = F.coalesce(F.col("error"), F.lit("")) != ""
    wrong = ~failed & ((F.col("rcode") != "NOERROR") | (observed != F.col("expected")))
    text = F.when(F.col("rcode") != "NOERROR", F.col("rcode")).otherwise(F.array_join(observed, ","))
    g = results.groupBy(*keys).agg(
        F.count("*").alias("n"), F.count_if(failed).alias("timeouts"), F.count_if(wrong).alias("mismatches"), F.min_by(F.when(wrong, text), F.when(wrong, F.col("seq"))).alias("observed")
    )
    reason = F.when(F.col("mismatches") > 0, "exact_rrset_mismatch").when(
        F.col("n") - F.col("timeouts") < quorum, F.when(F.col("timeouts") * 2 > F.col("n"), "timeout_rate_high").otherwise("insufficient_baseline_consensus")
    )
    return g.select(*keys, reason.isNull().alias("accepted"), reason.alias("rejection_reason"), "observed")


def vote_consensus(results: DataFrame, keys: list[str], quorum: int = 2) -> DataFrame:
    """results: keys, rcode, answers, error. The answer sets are counted first, so a hot question is pre-aggregated."""
    failed = F.coalesce(F.col("error"), F.lit("")) != ""
    good = ~failed & (F.col("rcode") == "NOERROR")
    each = results.withColumn("_set", F.when(good, F.array_sort("answers"))).groupBy(*keys, "_set").agg(
        F.count("*").alias("_c"), F.count_if(failed).alias("_t"), F.max(good).alias("_good")
    )
    top = F.when(F.col("_good"), F.struct(F.col("_c"), (-F.rank().over(Window.partitionBy(*keys).orderBy("_set"))).alias("_o"), F.col("_set").alias("_s")))
    g = each.withColumn("_top", top).groupBy(*keys).agg(
        F.sum("_c").alias("n"), F.sum("_t").alias("timeouts"), F.count_if("_good").alias("kinds"), F.max("_top").alias("_best")
    )
    reason = (
        F.when(F.col("kinds") == 0, "timeout_rate_high").when(F.col("_best._c") < quorum, "insufficient_baseline_consensus")
        .when(F.col("kinds") > 1, "baseline_disagreement").when(F.col("timeouts") * 2 > F.col("n"), "timeout_rate_high")
    )
    agreed = F.when(reason.isNull(), F.array_join("_best._s", ","))
    return g.select(*keys, reason.isNull().alias("accepted"), reason.alias("rejection_reason"), agreed.alias("agreed"))


def vote_negative(results: DataFrame, keys: list[str], check: str = "check_no", quorum: int = 2) -> DataFrame:
    """results: keys, check_no, seq, rcode, answers, error. The first failing check gives the reason."""
    failed = F.coalesce(F.col("error"), F.lit("")) != ""
    empty = F.coalesce(F.size("answers"), F.lit(0)) <= 0
    nx = ~failed & (F.col("rcode") == "NXDOMAIN") & empty
    bad = ~failed & ~nx
    kind = F.when((F.col("rcode") == "NOERROR") | ~empty, "negative_parent_wildcard_like").otherwise("negative_parent_inconsistent")
    per = results.groupBy(*keys, check).agg(F.count_if(nx).alias("_nx"), F.min_by(F.when(bad, kind), F.when(bad, F.col("seq"))).alias("_bad"))
    reason = F.coalesce("_bad", F.when(F.col("_nx") < quorum, "insufficient_baseline_consensus"))
    out = per.withColumn("_r", reason).groupBy(*keys).agg(F.min_by("_r", F.when(F.col("_r").isNotNull(), F.col(check))).alias("rejection_reason"))
    return out.select(*keys, F.col("rejection_reason").isNull().alias("accepted"), "rejection_reason")


def fifo_match(
    plan: DataFrame, responses: DataFrame, resolver: list[str], question: list[str], plan_order: str, response_order: str, width: int = 100_000, bound: int | None = None
) -> tuple[DataFrame, DataFrame]:
    """(probes with their response, responses left over).

    A response consumes the oldest pending probe of its resolver and question: the k-th response takes the k-th probe.
    A response whose resolver is null takes, after those, the oldest probe still pending for its question alone. Every
    planned probe is returned; one that nothing answered has nulls. All columns but the keys must differ, the orders
    are numbers, and a null question is one of its own.

    Both sides are one table of events, counted on in slices of `width` sequence numbers; the k-th probe and the k-th
    response of a key meet in one aggregation, whose groups have two rows at most.
    """
    mine = [c for c in plan.columns if c not in (*resolver, *question)]
    theirs = [c for c in responses.columns if c not in (*resolver, *question)]
    named = reduce(Column.__and__, [F.col(c).isNotNull() for c in resolver])

    def events(df: DataFrame, keys: list[str], side: int, order: str, kept: list[str]) -> DataFrame:
        row = F.struct(*kept)
        none = lambda d, columns: F.lit(None).cast(d.select(F.struct(*columns)).schema[0].dataType)
        p, r = (row, none(responses, theirs)) if side == 0 else (none(plan, [*resolver, *mine]), row)
        return df.select(*keys, F.lit(side).alias("_side"), F.col(order).alias("_order"), p.alias("_p"), r.alias("_r"))

    def met(both: DataFrame, keys: list[str], most: int | None = None) -> DataFrame:
        ranked = ahead(both, [*keys, "_side"], ["_order"], slices(F.col("_order"), width), bound=bound, most=most)
        return ranked.groupBy(*keys, "before").agg(F.first("_p", ignorenulls=True).alias("_p"), F.first("_r", ignorenulls=True).alias("_r")).drop("before")

    keys = [*resolver, *question]
    most = max(largest(plan, keys), largest(responses.where(named), keys))
    first = met(events(plan, keys, 0, plan_order, [*resolver, *mine]).unionByName(events(responses.where(named), keys, 1, response_order, theirs)), keys, most)
    first = checkpointed(first)  # read three times
    waiting = first.where("_r is null").select(*question, "_p.*")
    unnamed = responses.where(~named)
    second = met(events(waiting, question, 0, plan_order, [*resolver, *mine]).unionByName(events(unnamed, question, 1, response_order, theirs)), question)
    shown = lambda df: df.select(*[F.col(f"_p.{c}") if c in mine or c in resolver else c for c in plan.columns], *[F.col(f"_r.{c}") for c in theirs])
    over = lambda df, named: df.where("_p is null").select(*[c if c in (question if not named else keys) else F.col(f"_r.{c}") if c in theirs else F.lit(None).cast(responses.schema[c].dataType).alias(c) for c in responses.columns])
    return shown(first.where("_p is not null and _r is not null")).unionByName(shown(second.where("_p is not null"))), over(first, True).unionByName(over(second, False))


def route_batches(df: DataFrame, max_queries: int, width: int = 100_000, bound: int | None = None) -> DataFrame:
    """Endpoints on udp port 53 with their batch number within each record type, in order of seq, a number."""
    batched = df.where((F.col("transport") == "dns-udp") & (F.col("port") == 53))
    placed = ahead(batched, ["rdtype"], ["seq"], slices(F.col("seq"), width), bound=bound)
    return placed.withColumn("batch", F.floor(F.col("before") / max_queries).cast("int")).drop("before")
