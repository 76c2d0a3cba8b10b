"""Helpers shared by the text operators: lineage cuts in the shared folder, whole-row guards, ASCII case and words."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import AbstractContextManager, contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word is a run of anything but the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def shared_dir(spark: SparkSession) -> str:
    """The folder for checkpoints that all executors share.

    spark.checkpoint.dir names it. Only a local session may go without; any other session raises.
    """
    sc = spark.sparkContext
    current = sc._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get()
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        named = "/tmp/checkpoints"
    sc.setCheckpointDir(named)
    return sc._jsc.sc().getCheckpointDir().get()


def written(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it back: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def holding(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """The setting has this value inside."""
    before = spark.conf.get(key)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def settled(df: DataFrame, name: str) -> DataFrame:
    """Written, with the shuffle files of the write removed at its end."""
    with holding(df.sparkSession, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true"):
        return written(df, name)


def few_at_once(spark: SparkSession, rows: int = 128) -> AbstractContextManager:
    """What is written inside sends few rows at a time to Python: for rows as large as a picture, of which the usual 10,000 take a worker's memory."""
    return holding(spark, "spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def forget(*tables: DataFrame) -> None:
    """Deletes written tables that no later step reads."""
    for df in tables:
        jvm, conf = df.sparkSession._jvm, df.sparkSession._jsc.hadoopConfiguration()
        for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            path = jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(conf).delete(path, True)


def checkpointed(df: DataFrame) -> DataFrame:
    """Reliable checkpoint for narrow tables."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z only, whatever the locale or script."""
    return F.translate(c, UPPER, LOWER)


def fold_of(doc_id: Column, folds: int) -> Column:
    """crc32 of the id's decimal text, modulo the number of folds; 0 is held out."""
    return (F.crc32(doc_id.cast("string").cast("binary")) % folds).cast("int")
