"""Intermediate tables that several passes read: written to the shared checkpoint folder, so that a lost executor costs no
recomputation and every later read sees the same rows."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from topicloom.runtime import checkpoint_dir


def folder(spark: SparkSession) -> str:
    """A new place below ``spark.checkpoint.dir``. The caller of an operator may delete ``topicloom-*`` folders there
    once it has used the result."""
    return f"{checkpoint_dir(spark).rstrip('/')}/topicloom-{uuid.uuid4().hex}"


def stage(df: DataFrame) -> DataFrame:
    """``df`` as a written table."""
    path = folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
