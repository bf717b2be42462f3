"""The folder that driver and executors share."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile

from pyspark.sql import DataFrame, SparkSession


def root(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; a temporary folder for a local master without the setting, an error for any other."""
    at = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not at:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        at = tempfile.mkdtemp(prefix="zonalis-")
        atexit.register(shutil.rmtree, at, ignore_errors=True)
        spark.sparkContext.setCheckpointDir(at)
    elif not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(at)
    return at.rstrip("/")


def fresh(spark: SparkSession, name: str) -> str:
    return f"{root(spark)}/{name}-{os.urandom(6).hex()}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read again: its lineage ends there, and lost executors lose nothing."""
    at = fresh(df.sparkSession, name)
    df.write.parquet(at)
    return df.sparkSession.read.schema(df.schema).parquet(at)
