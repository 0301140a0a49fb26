"""Boundaries between the stages of a plan."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def new_folder(spark: SparkSession, name: str) -> str:
    """A folder name of its own in the folder of spark.checkpoint.dir, which driver and
    executors share.  Only on one machine (master local, as in tests) may it be unset."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="spark-stages-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return f"{folder.rstrip('/')}/stage-{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """Writes `df` to a shared folder and reads it back, so that what is used many times is
    computed once and the plan after it stays short.  Such tables are packed with zstd."""
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path, compression="zstd")
    return df.sparkSession.read.schema(df.schema).parquet(path)
