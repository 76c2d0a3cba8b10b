"""The user-level jobs: compositions of the operators, from tables to tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import PLAIN_TRANSPORTS, endpoint_order
from ..operators import analyze, corpus, dedup, evaluate, export, history
from ..operators.score import score_probes
from ..sources import history_store as store
from ..sources import readers
from .lineage import checkpointed


def discover(sources: list) -> tuple[DataFrame, DataFrame]:
    """(candidates, rejected): sources in order, hosts and URLs normalised and kept once."""
    found, out = readers.discover(sources)
    plain, bad_hosts = dedup.normalize_hosts(found.where(F.col("transport").isin(*PLAIN_TRANSPORTS)))
    urls, bad_urls = dedup.normalize_urls(found.where(F.col("transport") == "doh"))
    rejected = bad_hosts.unionByName(bad_urls)
    return plain.unionByName(urls), rejected if out is None else out.unionByName(rejected)


def validate(candidates: DataFrame, plan: DataFrame, observations: DataFrame, baseline: DataFrame | None = None, metrics: DataFrame | None = None) -> DataFrame:
    """Scored candidates (candidate_id, ...) from a probe plan with expectations and the observed answers."""
    positive = evaluate.evaluate_positive(plan.where("kind = 'positive'"), observations, baseline)
    negative = evaluate.evaluate_negative(plan.where("kind = 'nxdomain'"), observations)
    columns = ["candidate_id", "seq", "probe_id", "ok", "error"]
    probes = positive.select(columns).unionByName(negative.select(columns)).join(observations.select("probe_id", "latency_ms"), "probe_id", "left")
    scored = score_probes(probes, ["candidate_id"], metrics)
    return candidates.join(scored.drop("transport", "reliability"), "candidate_id", "left")


def split_candidates(candidates: DataFrame, n: int, path: str) -> DataFrame:
    return export.write_shards(export.assign_shards(candidates, n, endpoint_order()), path)


def export_format(results: DataFrame, kind: str) -> DataFrame:
    """Lines of one format: json, text, urls, backends or forwarders."""
    kinds = {
        "json": lambda: export.json_lines(results.where("status = 'accepted'"), endpoint_order()), "text": lambda: export.plain_list(results),
        "urls": lambda: export.plain_list(results, True), "backends": lambda: export.backend_lines(results), "forwarders": lambda: export.forwarder_lines(results),
    }
    return kinds[kind]()


def generate_corpus(roots: DataFrame, delegations: DataFrame, zones: DataFrame, observations: DataFrame, quorum: int = 2) -> tuple[DataFrame, DataFrame]:
    """(accepted probes, report) from seeds and the answers of baseline resolvers."""
    parts = [corpus.exact_probes(roots, delegations), corpus.consensus_probes(delegations), corpus.negative_probes(zones)]
    made = parts[0].unionByName(parts[1], allowMissingColumns=True).unionByName(parts[2], allowMissingColumns=True)
    voted = checkpointed(corpus.apply_agreed(corpus.vote(made, observations, quorum)))
    return voted.where("accepted"), corpus.generation_report(voted)


def build_and_write(
    roots: DataFrame, delegations: DataFrame, zones: DataFrame, observations: DataFrame, path: str, header: dict, quorum: int = 2, minimums: dict[str, int] = corpus.MINIMUMS
) -> DataFrame:
    """Generates a corpus, checks it and writes its documents; raises if it has logic errors or too few probes. Returns the probes."""
    kept, report = generate_corpus(roots, delegations, zones, observations, quorum)
    kinds = F.array_position(F.array(*[F.lit(k) for k in ("positive_exact", "positive_consensus", "negative_generated")]), F.col("kind"))
    placed = checkpointed(export.in_slices(kept.withColumn("_kind", kinds), [], [F.col("_kind"), F.col("id")]).withColumn("position", F.col("_at")).drop("_at", "_slice", "_kind"))
    wrong = validate_corpus(placed, minimums).limit(20).collect()
    if wrong:
        raise ValueError("logic errors: " + "; ".join(f"{r['id']}: {', '.join(r['errors'])}" for r in wrong))
    export.write_corpus(placed, report, path, header)
    return placed


def validate_corpus(probes: DataFrame, minimums: dict[str, int] = corpus.MINIMUMS) -> DataFrame:
    """Rows with logic errors; raises if a kind has too few probes. Kinds are three, so their counts fit the driver."""
    corpus.check_minimums({r["kind"]: r["n"] for r in probes.groupBy("kind").agg(F.count("*").alias("n")).collect()}, minimums)
    return corpus.logic_errors(probes).where(F.size("errors") > 0)


def update_history(spark: SparkSession, base: str, runs: DataFrame, run_status: DataFrame, run_date: Column, days: int = 30, keep: int = 2, cut: bool = False) -> None:
    """Puts runs into the history, rebuilds the rollups of their days, drops old days and moves the quarantine on.

    runs (run_id, run_date, ...) and run_status (run_id, ...) replace those of the same run ids, whatever day those had:
    the stored runs tell in which days an id is, and both its old and its new day are rebuilt. All other days keep
    their folders; days before the last `days` up to run_date go. The quarantine steps once for run_date, from the
    hosts' outcomes of that day and their streak of 14 rejected days. All of it takes effect in one commit at the end:
    a job that fails earlier changes nothing, and repeating a job leaves the tables as they are. Two rows of one
    run id are the caller's fault; the days of a job and of the history are few, so they are listed on the driver.
    cut: the rows are checkpointed already, or as cheap to read again.
    """
    today = spark.range(1).select(run_date.alias("d")).first()["d"]
    first = str(today - timedelta(days=days - 1))
    number, commit = store.head(spark, base)
    runs, run_status = (runs, run_status) if cut else (checkpointed(runs), checkpointed(run_status))
    new_ids = runs.select("run_id").distinct()
    before = store.read_table(spark, base, commit, "runs").select("run_id", "run_date").join(F.broadcast(new_ids) if runs.count() <= 100_000 else new_ids, "run_id", "left_semi")
    touched = {str(r["run_date"]) for r in before.select("run_date").unionByName(runs.select("run_date")).distinct().collect()}
    dated = run_status.drop("run_date").join(runs.select("run_id", "run_date"), "run_id")
    job = uuid.uuid4().hex

    def rebuilt(table: str, rows: DataFrame) -> dict[str, str]:
        """The commit's days of a table with the touched ones in new folders; a day without rows is left out."""
        written = store.write_table(rows, base, table, job)
        others = {day: folder for day, folder in commit.get(table, {}).items() if day not in touched}
        return {day: folder for day, folder in (others | written).items() if day >= first}

    def others(table: str) -> DataFrame:
        return store.read_table(spark, base, commit, table, touched).join(new_ids, "run_id", "left_anti")

    after = {table: rebuilt(table, new.unionByName(others(table), allowMissingColumns=True)) for table, new in (("runs", runs), ("run_status", dated))}
    whole = [store.read_table(spark, base, after, table, touched) for table in ("runs", "run_status")]
    after["daily"] = rebuilt("daily", history.daily_rollup(*whole))
    outcomes = history.rejected_streak(history.host_day(store.read_table(spark, base, after, "daily"))).where(F.col("run_date") == run_date)
    state = store.read_table(spark, base, commit, "quarantine")
    after["quarantine"] = store.write_table(history.quarantine_step(outcomes, state, run_date), base, "quarantine", job)
    store.publish(spark, base, number + 1, after)
    store.sweep(spark, base, keep)


def refresh(sources: list, plan: Callable[[DataFrame], DataFrame], answers: Callable[[DataFrame], DataFrame], metrics: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(results, rejected): discover and validate in one go; `plan` makes probes of candidates, `answers` observes them."""
    candidates, rejected = discover(sources)
    candidates = checkpointed(candidates.withColumn("candidate_id", F.monotonically_increasing_id()))
    made = plan(candidates)
    return validate(candidates, made, answers(made), metrics=metrics), rejected


def materialize(results: DataFrame, filtered: DataFrame | None, path: str, max_bytes: int | None = None) -> None:
    """Every format of scored results below `path`: JSON by status (in parts of at most max_bytes), lists, filtered rows."""
    export.write_results(results, f"{path}/results", ("accepted", "candidate", "rejected"), pruned="probes" in results.columns, max_bytes=max_bytes)
    for kind in ("text", "urls", "backends", "forwarders"):
        export_format(results, kind).write.text(f"{path}/{kind}")
    if filtered is not None:
        export.write_filtered(filtered, f"{path}/filtered")


def apply_quarantine(candidates: DataFrame, filtered: DataFrame | None, state: DataFrame, run_date: Column) -> tuple[DataFrame, DataFrame]:
    eligible, out = history.apply_quarantine(candidates, state, run_date)
    return eligible, out if filtered is None else filtered.unionByName(out)


def score_report(results: DataFrame) -> dict[str, DataFrame]:
    return {
        "bands": analyze.score_bands(results), "histogram": analyze.score_histogram(results), "reasons": analyze.band_reasons(results),
        "averages": analyze.band_averages(results), "confidence": analyze.confidence_stats(results), "caps": analyze.top_caps(results),
    }


def history_report(daily: DataFrame, metrics: DataFrame, run_date: Column) -> dict[str, DataFrame]:
    return {
        "transports": analyze.transport_breakdown(daily), "depth": analyze.seen_in_last_n(daily), "capped": analyze.capped_count(daily, metrics, run_date),
    }
