"""The history job: upserts by run id across days, and one commit for all tables."""

import datetime

import pytest
from pyspark.sql import functions as F

from endpointlens.operators import history
from endpointlens.plans import pipelines
from endpointlens.sources import history_store as store
from endpointlens.sources import readers

FIRST = datetime.date(2024, 1, 1)
TABLES = ("runs", "run_status", "daily", "quarantine")


def day(n):
    return FIRST + datetime.timedelta(days=n)


def put(spark, base, n, rows, on=None):
    """rows: (run, key, host, status); all runs are of day n, or of the day that `on` names for them."""
    runs = spark.createDataFrame([(r, day((on or {}).get(r, n))) for r in sorted({row[0] for row in rows})], "run_id string, run_date date")
    status = spark.createDataFrame([(r, k, h, "dns-udp", s, [] if s == "accepted" else ["timeout_or_error"]) for r, k, h, s in rows], "run_id string, resolver_key string, host string, transport string, status string, reasons array<string>")
    pipelines.update_history(spark, base, runs, status, F.lit(day(n)).cast("date"))


def shown(spark, base):
    return {t: sorted(map(str, readers.read_history(spark, base, t).collect())) for t in TABLES}


def test_a_moved_run_leaves_its_old_day(spark, tmp_path):
    base = str(tmp_path / "h")
    put(spark, base, 5, [("r1", "k1", "a", "accepted"), ("r2", "k1", "a", "rejected"), ("r3", "k2", "b", "accepted")])
    put(spark, base, 6, [("r1", "k1", "a", "accepted"), ("r3", "k2", "b", "rejected")])
    runs = readers.read_history(spark, base, "runs")
    assert sorted((r["run_id"], r["run_date"]) for r in runs.collect()) == [("r1", day(6)), ("r2", day(5)), ("r3", day(6))]
    status = readers.read_history(spark, base, "run_status")
    assert sorted((r["run_id"], r["run_date"], r["status"]) for r in status.collect()) == [("r1", day(6), "accepted"), ("r2", day(5), "rejected"), ("r3", day(6), "rejected")]
    daily = readers.read_history(spark, base, "daily")
    assert sorted((r["run_date"], r["resolver_key"], r["runs"], r["day_status"]) for r in daily.collect()) == [(day(5), "k1", 1, "rejected"), (day(6), "k1", 1, "accepted"), (day(6), "k2", 1, "rejected")]
    put(spark, base, 6, [("r2", "k1", "a", "rejected")])  # day 5 has no run any more
    assert {r["run_date"] for t in TABLES[:3] for r in readers.read_history(spark, base, t).collect()} == {day(6)}


def test_equals_a_rebuild_from_the_last_word_of_each_run(spark, tmp_path):
    import random

    rng, base, last = random.Random(4), str(tmp_path / "h"), {}
    for n in range(4):
        names = {f"r{rng.randint(0, 5)}" for _ in range(3)}
        on = {r: rng.randint(0, n) for r in names}
        rows = [(r, f"k{k}", f"h{k % 2}", rng.choice(["accepted", "rejected", "candidate"])) for r in names for k in range(3) if rng.random() < 0.8] or [("r9", "k", "h", "accepted")]
        on = {r: on.get(r, n) for r in {row[0] for row in rows}}
        put(spark, base, n, rows, on)
        last |= {r: (on[r], [row for row in rows if row[0] == r]) for r in on}
    runs = spark.createDataFrame([(r, day(d)) for r, (d, _) in last.items()], "run_id string, run_date date")
    status = spark.createDataFrame([(r, k, h, "dns-udp", s, [] if s == "accepted" else ["timeout_or_error"], None, None, None) for _, rows in last.values() for r, k, h, s in rows], "run_id string, resolver_key string, host string, transport string, status string, reasons array<string>, p50_latency_ms double, p95_latency_ms double, jitter_ms double")
    columns = ["run_date", "resolver_key", "host", "day_status", "runs", "successful_runs", "failed_runs", "reasons_signature"]
    want = sorted(map(tuple, history.daily_rollup(runs, status).select(columns).collect()))
    assert sorted(map(tuple, readers.read_history(spark, base, "daily").select(columns).collect())) == want


@pytest.mark.parametrize("step", ["runs", "run_status", "daily", "quarantine", "commit"])
def test_a_job_that_dies_changes_nothing(spark, tmp_path, monkeypatch, step):
    base = str(tmp_path / "h")
    for n in range(14):
        put(spark, base, n, [(f"r{n}", "k", "h", "rejected")]) if n in (0, 12, 13) else None
    before, write = shown(spark, base), store.write_table

    def dying(df, base, table, job):
        if table == step:
            df.sparkSession.range(3).write.parquet(f"{base}/data/{job}/{table}/_day=half")
            raise OSError("lost")
        return write(df, base, table, job)

    def lost(*_):
        raise OSError("lost")

    with monkeypatch.context() as patched:
        patched.setattr(store, "publish", lost) if step == "commit" else patched.setattr(store, "write_table", dying)
        with pytest.raises(OSError):
            put(spark, base, 13, [("r13", "k", "h", "accepted"), ("r14", "k2", "h2", "accepted")])
    assert shown(spark, base) == before
    put(spark, base, 13, [("r13", "k", "h", "accepted"), ("r14", "k2", "h2", "accepted")])
    assert {(r["run_id"], r["status"]) for r in readers.read_history(spark, base, "run_status").where(F.col("run_date") == F.lit(day(13))).collect()} == {("r13", "accepted"), ("r14", "accepted")}
    assert not store.paths(spark, f"{base}/data/*/*/_day=half")  # what the dead job left is swept away


def test_readers_keep_the_commit_they_opened(spark, tmp_path):
    base = str(tmp_path / "h")
    put(spark, base, 1, [("a", "k", "h", "accepted")])
    opened = readers.read_history(spark, base, "daily")
    put(spark, base, 1, [("a", "k", "h", "rejected")])
    assert [r["day_status"] for r in opened.collect()] == ["accepted"]
    assert [r["day_status"] for r in readers.read_history(spark, base, "daily").collect()] == ["rejected"]
    put(spark, base, 2, [("b", "k", "h", "rejected")])
    assert len(store.commit_files(spark, base)) == 2
    kept = {f for file in store.commit_files(spark, base) for folders in store.read_commit(spark, file).values() for f in folders.values()}
    on_disk = {"/".join(p.split("/")[-4:]) for p in store.paths(spark, f"{base}/data/*/*/_day=*")} | {"/".join(p.split("/")[-3:]) for p in store.paths(spark, f"{base}/data/*/quarantine")}
    assert on_disk == kept


def test_only_one_of_two_jobs_commits(spark, tmp_path):
    base = str(tmp_path / "h")
    put(spark, base, 1, [("a", "k", "h", "accepted")])
    number, commit = store.head(spark, base)
    store.publish(spark, base, number + 1, commit)
    with pytest.raises(Exception):
        store.publish(spark, base, number + 1, {})
    assert store.head(spark, base) == (number + 1, commit)
    assert readers.read_history(spark, str(tmp_path / "none"), "daily").count() == 0
