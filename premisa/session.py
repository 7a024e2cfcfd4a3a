"""Where reliable intermediate tables go."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; a temporary one only in local mode."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    folder = tempfile.mkdtemp(prefix="premisa-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def scratch_path(spark: SparkSession, what: str) -> str:
    return f"{shared_folder(spark)}/premisa/{what}-{uuid.uuid4().hex}"


def written(df: DataFrame, what: str) -> DataFrame:
    """Write a table to the shared folder and read it back: short lineage that survives lost executors."""
    path = scratch_path(df.sparkSession, what)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
