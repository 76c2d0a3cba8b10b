"""Lineage cuts for iterative plans, in the checkpoint folder that all executors share."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share; spark.checkpoint.dir names it, and only a local session may go without."""
    sc = spark.sparkContext
    if not sc._jsc.sc().getCheckpointDir().isDefined():
        named = spark.conf.get("spark.checkpoint.dir", None)
        if not named:
            if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
                raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
            named = "/tmp/checkpoints"
        sc.setCheckpointDir(named)
    return sc._jsc.sc().getCheckpointDir().get()


def checkpointed(df: DataFrame) -> DataFrame:
    """A reliable checkpoint in the shared folder."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def new_folder(spark: SparkSession, name: str) -> str:
    """The path of a folder in the shared one that nothing else uses."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
