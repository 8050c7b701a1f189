"""Intermediate tables in the folder that driver and executors share (spark.checkpoint.dir)."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def new_folder(spark: SparkSession, name: str) -> str:
    """A folder of its own below the session's checkpoint folder.

    Where that is unset a local session gets a temporary one; on a cluster executors would not see it, so that raises.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root and not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
    if not root:
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="spark-"))
        root = spark.sparkContext.getCheckpointDir()
    return f"{root.rstrip('/')}/staged/{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write df as Parquet and read it back: loops stay short in lineage and plans know the table's size."""
    spark = df.sparkSession
    path = new_folder(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
