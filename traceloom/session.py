"""Session helpers: reading tables and cutting lineage on shared storage."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, base: str, name: str) -> DataFrame:
    """One Parquet table of a data directory."""
    return spark.read.parquet(f"{base}/{name}.parquet")


def checkpoint_dir(spark: SparkSession) -> str:
    """The folder for checkpoints.

    A cluster names its shared folder in ``spark.checkpoint.dir``; that always
    wins. Only where neither it nor a checkpoint directory is set (tests on one
    machine) a local folder is made.
    """
    sc = spark.sparkContext
    shared = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    current = sc.getCheckpointDir()
    if current:
        return current
    if not shared:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        shared = tempfile.mkdtemp(prefix="traceloom-ckpt-")
    sc.setCheckpointDir(shared)
    return sc.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """Materialise ``df`` once on shared storage and drop its lineage."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def shared_path(spark: SparkSession, name: str) -> str:
    """A path below the checkpoint folder for a table written between stages."""
    return os.path.join(checkpoint_dir(spark), name)
