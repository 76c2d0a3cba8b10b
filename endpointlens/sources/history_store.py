"""The history's tables under one commit pointer.

A commit is a small JSON text, `commits/00000012.json`: for every table the folder of each day, or one folder for the
quarantine. A job writes the days it touches into new folders, then renames its commit into place; that rename is the
only step that readers can see. Until then they keep reading the folders of the commit before, so a job that dies
between any two writes leaves the old state whole. Days that a job leaves alone are named again, not copied. Folders
that the last commits don't name are deleted afterwards. Two jobs at a time can't both succeed: the second finds its
commit's number taken and fails.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas

#: A commit: {table: {day: folder below the base}}; the quarantine's only day is "".
Commit = dict[str, dict[str, str]]


def _path(spark: SparkSession, name: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(name)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def paths(spark: SparkSession, pattern: str) -> list[str]:
    """The paths that a pattern names."""
    path, fs = _path(spark, pattern)
    return [str(f.getPath()) for f in fs.globStatus(path) or []]


def delete(spark: SparkSession, name: str) -> None:
    path, fs = _path(spark, name)
    fs.delete(path, True)


def commit_files(spark: SparkSession, base: str) -> list[str]:
    """From the oldest to the newest."""
    return sorted(p for p in paths(spark, f"{base}/commits/*.json"))


def read_commit(spark: SparkSession, file: str) -> Commit:
    return json.loads(spark.read.text(file, wholetext=True).first()[0])


def head(spark: SparkSession, base: str) -> tuple[int, Commit]:
    """The newest commit's number and content; 0 and nothing before the first."""
    files = commit_files(spark, base)
    if not files:
        return 0, {}
    return int(files[-1].rsplit("/", 1)[1].removesuffix(".json")), read_commit(spark, files[-1])


def read_table(spark: SparkSession, base: str, commit: Commit, table: str, days: set[str] | None = None) -> DataFrame:
    """The rows of a table in one commit; only the folders of the wanted days are opened."""
    folders = [f"{base}/{folder}" for day, folder in sorted(commit.get(table, {}).items()) if days is None or day in days]
    if not folders:
        return spark.createDataFrame([], schemas.HISTORY[table])
    return spark.read.schema(schemas.HISTORY[table]).parquet(*folders)


def write_table(df: DataFrame, base: str, table: str, job: str) -> dict[str, str]:
    """Writes the rows into new folders, one a day of run_date; returns those folders."""
    spark, target = df.sparkSession, f"data/{job}/{table}"
    shaped = df.select(*[F.col(f.name) if f.name in df.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in spark.createDataFrame([], schemas.HISTORY[table]).schema])
    if "run_date" not in shaped.columns:
        shaped.write.parquet(f"{base}/{target}")
        return {"": target}
    # the rows of a day go to few files: large days are split, small ones share a task
    shaped.withColumn("_day", F.col("run_date")).hint("rebalance", "_day").write.partitionBy("_day").parquet(f"{base}/{target}")
    days = [p.rsplit("=", 1)[1] for p in paths(spark, f"{base}/{target}/_day=*")]
    return {day: f"{target}/_day={day}" for day in days}


def publish(spark: SparkSession, base: str, number: int, commit: Commit) -> None:
    """Moves the pointer to a commit; fails if its number is taken."""
    draft, fs = _path(spark, f"{base}/commits/_draft-{uuid.uuid4().hex}")
    out = fs.create(draft, True)
    out.write(bytearray(json.dumps(commit, sort_keys=True).encode()))
    out.close()
    final, _ = _path(spark, f"{base}/commits/{number:08d}.json")
    kind = getattr(spark._jvm.org.apache.hadoop.fs, "Options$Rename")
    none = spark._sc._gateway.new_array(kind, 0)
    spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration()).rename(draft, final, none)


def sweep(spark: SparkSession, base: str, keep: int = 2) -> None:
    """Deletes all but the last commits, and the folders that none of those names."""
    files = commit_files(spark, base)
    for file in files[:-keep]:
        delete(spark, file)
    named = {folder for file in files[-keep:] for folders in read_commit(spark, file).values() for folder in folders.values()}
    for pattern in ("data/*/quarantine", "data/*/*/_day=*"):
        for found in paths(spark, f"{base}/{pattern}"):
            if "/".join(found.split("/")[-pattern.count("/") - 1 :]) not in named:
                delete(spark, found)
    for job in paths(spark, f"{base}/data/*"):
        tables = paths(spark, f"{job}/*")
        if not any(t.endswith("/quarantine") or paths(spark, f"{t}/_day=*") for t in tables):
            delete(spark, job)
