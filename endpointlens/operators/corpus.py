"""Building and checking a corpus of questions: seeds to probes, quotas, votes, gates."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from pyspark.sql.window import Window

from ..functions.text import normalize_answers, probe_id, render_qname
from ..plans.lineage import checkpointed
from .components import components
from .dedup import duplicate_ids
from .evaluate import vote_consensus, vote_exact, vote_negative

#: Least probes of each kind.
MINIMUMS = {"positive_exact": 6, "positive_consensus": 3, "negative_generated": 3}


def greedy_quota(items: DataFrame, zone_cap: int, family_cap: int) -> DataFrame:
    """items (ordinal, zone, family, want) with `takes`: greedy in order under a cap of probes a zone and of hosts a family.

    Every item has a lower and an upper bound of what it takes; each round bounds it anew from prefix sums of the
    others' bounds. Rounds go on while they settle half of the open items. What then is still open are chains, in
    which one item waits for the next: items linked by a zone or family are one component, and each component is
    gone through once in order, with counters only in memory. Ordinals tell items apart.
    """
    before = lambda key: Window.partitionBy(key).orderBy("ordinal").rowsBetween(Window.unboundedPreceding, -1)
    used = lambda c, key: F.coalesce(F.sum(c).over(before(key)), F.lit(0))
    hosts = lambda c: (F.col(c) > 0).cast("int")
    state = checkpointed(items.withColumns({"lo": F.lit(0).cast("long"), "hi": F.col("want").cast("long")}))
    unsettled = F.col("lo") != F.col("hi")
    left, last = state.where(unsettled).count(), None
    while left and (last is None or 2 * left <= last):
        sums = state.withColumns(
            {"zl": used(F.col("lo"), "zone"), "zh": used(F.col("hi"), "zone"), "fl": used(hosts("lo"), "family"), "fh": used(hosts("hi"), "family")}
        )
        take = lambda zone, family: F.when(F.col(family) >= family_cap, 0).otherwise(F.least(F.col("want"), F.greatest(F.lit(zone_cap) - F.col(zone), F.lit(0)))).cast("long")
        state = checkpointed(sums.select(*items.columns, take("zh", "fh").alias("lo"), take("zl", "fl").alias("hi")))
        left, last = state.where(unsettled).count(), left
    if not left:
        return state.withColumn("takes", F.col("lo")).drop("lo", "hi")
    settled = F.when(~unsettled, F.col("lo")).otherwise(0)
    ahead = state.withColumns({"_z": used(settled, "zone"), "_f": used((settled > 0).cast("int"), "family")}).where(unsettled)
    found = walked(checkpointed(ahead.select("ordinal", "zone", "family", F.col("want").cast("long").alias("want"), "_z", "_f")), zone_cap, family_cap)
    return state.join(found, "ordinal", "left").withColumn("takes", F.coalesce("_takes", "lo")).drop("lo", "hi", "_takes")


def walked(waiting: DataFrame, zone_cap: int, family_cap: int) -> DataFrame:
    """(ordinal, _takes) of waiting items (ordinal, zone, family, want, _z, _f), the last two what others took ahead of them."""
    name = lambda c: F.concat(F.lit(f"{c}:"), F.coalesce(F.col(c).cast("string"), F.lit("")))
    of = components(waiting.select(name("zone").alias("u"), name("family").alias("v"))).withColumnRenamed("node", "_node")
    placed = waiting.join(of, name("zone") == F.col("_node")).select("component", "ordinal", "zone", "family", "want", "_z", "_f")

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, probes, taken = None, {}, {}
        for batch in batches:
            takes = []
            for component, zone, family, want, z, f in zip(*[batch.column(c).to_pylist() for c in ("component", "zone", "family", "want", "_z", "_f")]):
                if component != at:
                    at, probes, taken = component, {}, {}
                room = max(0, zone_cap - z - probes.get(zone, 0))
                take = min(want, room) if f + taken.get(family, 0) < family_cap else 0
                if take:
                    probes[zone] = probes.get(zone, 0) + take
                    taken[family] = taken.get(family, 0) + 1
                takes.append(take)
            yield pa.RecordBatch.from_arrays([batch.column("ordinal"), pa.array(takes, pa.int64())], names=["ordinal", "_takes"])

    sorted_ = placed.repartition("component").sortWithinPartitions("component", "ordinal")
    return sorted_.mapInArrow(walk, StructType([placed.schema["ordinal"]]).add("_takes", "long"))


def exact_hosts(roots: DataFrame, delegations: DataFrame) -> DataFrame:
    """(ordinal, zone, hostname, ipv4, ipv6, source, notes, family): root servers first, then hosts of delegations."""
    first = roots.select(
        F.struct(F.lit(0).alias("k"), F.col("position").alias("a"), F.lit(0).alias("b")).alias("ordinal"), F.lit("root").alias("zone"), "hostname", "ipv4", "ipv6", "source", "notes",
        F.coalesce("operator_family", "hostname").alias("family"),
    )
    hosts = delegations.select("zone", "source", "notes", "position", F.posexplode("exact_hosts").alias("b", "h"))
    rest = hosts.select(
        F.struct(F.lit(1).alias("k"), F.col("position").alias("a"), "b").alias("ordinal"), "zone", F.col("h.hostname").alias("hostname"), F.col("h.ipv4").alias("ipv4"),
        F.col("h.ipv6").alias("ipv6"), F.coalesce("h.source", "source").alias("source"), F.coalesce("h.notes", "notes").alias("notes"), F.coalesce("h.operator_family", "zone").alias("family"),
    )
    return first.unionByName(rest)


def exact_probes(roots: DataFrame, delegations: DataFrame, zone_cap: int = 3, family_cap: int = 3) -> DataFrame:
    hosts = exact_hosts(roots, delegations)
    some = lambda c: (F.coalesce(F.size(c), F.lit(0)) > 0).cast("int")
    taken = greedy_quota(hosts.withColumn("want", some("ipv4") + some("ipv6")), zone_cap, family_cap).where("takes > 0")
    kinds = F.array_compact(F.array(F.when(some("ipv4") == 1, F.struct(F.lit("A").alias("qtype"), F.col("ipv4").alias("a"))), F.when(some("ipv6") == 1, F.struct(F.lit("AAAA").alias("qtype"), F.col("ipv6").alias("a")))))
    each = taken.select("*", F.explode(F.slice(kinds, F.lit(1), F.col("takes").cast("int"))).alias("q"))
    return each.select(
        probe_id(F.lit("positive-exact"), F.col("hostname"), F.col("q.qtype")).alias("id"), F.lit("positive_exact").alias("kind"), F.col("hostname").alias("qname"),
        F.col("q.qtype").alias("qtype"), F.lit("exact_rrset").alias("expected_mode"), F.col("q.a").alias("expected_answers"), "source", "notes", F.lit(1.0).alias("stability_score"),
    )


def consensus_probes(delegations: DataFrame) -> DataFrame:
    return delegations.select(
        probe_id(F.lit("positive-consensus"), F.col("zone"), F.lit("NS")).alias("id"), F.lit("positive_consensus").alias("kind"), F.col("zone").alias("qname"), F.lit("NS").alias("qtype"),
        F.lit("consensus_match").alias("expected_mode"), F.col("nameservers").alias("expected_nameservers"), "source", "notes", F.lit(0.9).alias("stability_score"),
    )


def negative_probes(zones: DataFrame) -> DataFrame:
    """One probe per parent zone; a zone that doesn't end in a dot has no parent_zone, which is a logic error."""
    bare = F.regexp_replace("zone", r"\.+$", "")
    return zones.select(
        probe_id(F.lit("negative-generated"), F.col("zone"), F.lit("A")).alias("id"), F.lit("negative_generated").alias("kind"), F.concat(F.lit("{uuid}."), bare, F.lit(".")).alias("qname_template"),
        F.lit("A").alias("qtype"), F.lit("nxdomain").alias("expected_mode"), F.when(F.col("zone").endswith("."), F.col("zone")).alias("parent_zone"),
        F.lit("negative-parent-pool").alias("source"), F.lit(0.8).alias("stability_score"),
    )


def baseline_plan(candidates: DataFrame, resolvers: list[str], rounds: dict[str, int] | None = None, labels: int = 3) -> DataFrame:
    """(id, kind, round, check_no, resolver, qname): every resolver in every round; negatives with several labels."""
    n = {"positive_exact": 2, "positive_consensus": 2, "negative_generated": 3} | (rounds or {})
    count = F.create_map(*[F.lit(x) for p in n.items() for x in p])[F.col("kind")]
    rows = candidates.withColumn("round", F.explode(F.sequence(F.lit(0), count - 1)))
    rows = rows.withColumn("check_no", F.explode(F.when(F.col("kind") == "negative_generated", F.sequence(F.lit(0), F.lit(labels - 1))).otherwise(F.array(F.lit(0)))))
    rows = rows.withColumn("resolver", F.explode(F.array(*[F.lit(r) for r in resolvers])))
    seed = F.concat_ws("-", "id", "round", "check_no")
    qname = F.coalesce(F.col("qname") if "qname" in candidates.columns else F.lit(None).cast("string"), render_qname(F.col("qname_template"), seed) if "qname_template" in candidates.columns else F.lit(None).cast("string"))
    return rows.select("id", "kind", "round", "check_no", "resolver", qname.alias("qname"))


def vote(candidates: DataFrame, observations: DataFrame, quorum: int = 2) -> DataFrame:
    """candidates with accepted, rejection_reason, agreed and observed, by the rule of their kind; an unknown kind is refused.

    The expected answers of exact probes are held in the form in which answers are compared.
    """
    candidates = candidates.withColumn("expected_answers", normalize_answers(F.col("expected_answers"), F.col("qtype")))
    rows = observations.join(candidates.select("id", "kind", F.col("expected_answers").alias("expected"), F.col("qtype").alias("rdtype")), "id")
    of = lambda kind: rows.where(F.col("kind") == kind)
    cols = ["id", "accepted", "rejection_reason"]
    none = lambda name: F.lit(None).cast("string").alias(name)
    votes = (
        vote_exact(of("positive_exact"), ["id"], quorum).select(*cols, none("agreed"), "observed")
        .unionByName(vote_consensus(of("positive_consensus"), ["id"], quorum).select(*cols, "agreed", none("observed")))
        .unionByName(vote_negative(of("negative_generated"), ["id"], quorum=quorum).select(*cols, none("agreed"), none("observed")))
    )
    known = F.col("kind").isin("positive_exact", "positive_consensus", "negative_generated")
    out = candidates.join(votes, "id", "left")
    return out.withColumns(
        {"rejection_reason": F.when(~known, "unsupported_probe_kind").when(F.col("accepted").isNull(), "timeout_rate_high").otherwise(F.col("rejection_reason")), "accepted": known & F.coalesce("accepted", F.lit(False))}
    )


def apply_agreed(voted: DataFrame) -> DataFrame:
    """Of accepted probes, what the baseline agreed on replaces what was expected, where it is anything.

    Exact probes agree on their expected answers, sorted and in compared form; consensus probes on name servers.
    """
    agreed = F.split("agreed", ",")
    named = F.col("accepted") & (F.col("agreed") != "")
    return voted.withColumn("expected_nameservers", F.when(named, agreed).otherwise(F.col("expected_nameservers")))


def vote_trail(observations: DataFrame, voted: DataFrame) -> DataFrame:
    """(id, kind, asked, failed, accepted, rejection_reason, agreed, observed): how the vote on each probe came about."""
    failed = F.coalesce(F.col("error"), F.lit("")) != ""
    asked = observations.groupBy("id").agg(F.count("*").alias("asked"), F.count_if(failed).alias("failed"))
    rows = voted.select("id", "kind", "accepted", "rejection_reason", "agreed", "observed").join(asked, "id", "left")
    return rows.withColumns({c: F.coalesce(c, F.lit(0)).cast("long") for c in ("asked", "failed")})


def generation_report(voted: DataFrame) -> DataFrame:
    """(kind, rejection_reason, n); an accepted probe has no reason."""
    return voted.groupBy("kind", "rejection_reason").agg(F.count("*").alias("n"))


def check_minimums(counts: dict[str, int], minimums: dict[str, int] = MINIMUMS) -> None:
    """Raises with all kinds that have too few probes."""
    if not sum(counts.values()):
        raise ValueError("the corpus is empty")
    short = [f"{k}: {counts.get(k, 0)} of {n}" for k, n in minimums.items() if counts.get(k, 0) < n]
    if short:
        raise ValueError("too few probes: " + ", ".join(short))


def logic_errors(probes: DataFrame) -> DataFrame:
    """probes with `errors`: kind and mode must fit, negatives need a parent zone, ids are unique."""
    mode = {"positive_exact": "exact_rrset", "positive_consensus": "consensus_match", "negative_generated": "nxdomain"}
    fits = F.create_map(*[F.lit(x) for p in mode.items() for x in p])
    twice = duplicate_ids(probes, "id").select("id", F.lit(True).alias("_twice"))
    errors = F.array_compact(
        F.array(
            F.when(~F.col("kind").isin(*mode), "unknown kind"),
            F.when(F.col("kind").isin(*mode) & (F.try_element_at(fits, F.col("kind")) != F.col("expected_mode")), "kind and expected_mode differ"),
            F.when((F.col("kind") == "negative_generated") & F.col("parent_zone").isNull(), "negative probe without parent_zone"),
            F.when(F.col("_twice"), "duplicate id"),
        )
    )
    return probes.join(twice, "id", "left").withColumn("errors", errors).drop("_twice")


def builtin_corpus(spark: SparkSession, zone: str | None = None) -> DataFrame:
    """The fallback questions, or those of a controlled zone. Fixed values."""
    if zone:
        rows = [("positive", "A", f"a.{zone}"), ("positive", "AAAA", f"aaaa.{zone}"), ("positive", "TXT", f"txt.{zone}"), ("positive", "CNAME", f"cname.{zone}"), ("nxdomain", "A", None)]
        template = f"{{uuid}}.{zone}"
    else:
        rows = [("positive", t, n) for n, t in (("example.com.", "A"), ("example.com.", "AAAA"), ("iana.org.", "A"), ("com.", "NS"), ("org.", "NS"), ("net.", "NS"))]
        rows += [("nxdomain", "A", None), ("nxdomain", "AAAA", None)]
        template = "{uuid}.invalid."
    table = [(k, kind, f"{kind}-{rdtype}-{k}", name, None if name else template, rdtype) for k, (kind, rdtype, name) in enumerate(rows)]
    return spark.createDataFrame(table, "position int, kind string, label string, qname string, qname_template string, rdtype string")


def build_corpus(spark: SparkSession, mode: str, zone: str | None = None, external: DataFrame | None = None, allow_fallback: bool = False) -> DataFrame:
    """controlled needs a zone, external a corpus; without it the fallback is taken only if allowed. Other modes raise."""
    if mode not in ("controlled", "external", "fallback"):
        raise ValueError(f"unknown corpus mode: {mode}")
    if mode == "controlled":
        if not zone:
            raise ValueError("a controlled corpus needs a zone")
        return builtin_corpus(spark, zone)
    if mode == "external" and external is not None:
        return external
    if mode == "external" and not allow_fallback:
        raise ValueError("an external corpus needs a document")
    return builtin_corpus(spark)
