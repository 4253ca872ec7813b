"""Session helpers shared by every operator: size-checked broadcast, reliable
lineage cuts and the canonical partitioning of a corpus."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# A lookup table is broadcast only after it was counted and found to be within this many rows and bytes.
BROADCAST_ROW_LIMIT = 500_000
BROADCAST_BYTE_LIMIT = 128 << 20

# k x V factors are held by the driver and every task only within this many cells (8 bytes each); larger ones stay tables of term ranges.
FACTOR_CELL_LIMIT = 16_000_000


class DataValidationError(ValueError):
    """The input table breaks a rule it was checked against."""


def bounded(table: DataFrame, max_rows: int = BROADCAST_ROW_LIMIT) -> DataFrame:
    """Hint ``table`` for broadcast if a count proves it small; otherwise leave the join to
    the shuffle strategies, where adaptive execution splits skewed keys. The table is cached,
    so that counting it does not compute it twice."""
    kept = table if table.storageLevel.useMemory or table.storageLevel.useDisk else table.persist()
    return F.broadcast(kept) if is_small(kept, max_rows) else kept


def is_small(table: DataFrame, max_rows: int = BROADCAST_ROW_LIMIT) -> bool:
    """True if the cached ``table`` has at most ``max_rows`` rows and takes at most BROADCAST_BYTE_LIMIT bytes. The count fills
    the cache, whose size Spark then knows; it is combined in the map tasks, so no task reads the rows of another."""
    if table.count() > max_rows:
        return False
    size = table._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    return int(str(size)) <= BROADCAST_BYTE_LIMIT


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder of the session. Only a local session without one gets a
    temporary folder; on a cluster the folder has to be configured."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        configured = tempfile.mkdtemp(prefix="topicloom-checkpoint-")
    sc.setCheckpointDir(configured)
    return configured


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` reliably, so that later stages survive the loss of executors."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[str]:
    """A folder of its own below the checkpoint folder, for tables that one call writes and reads; deleted when the call ends."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/topicloom-{uuid.uuid4().hex}"
    try:
        yield path
    finally:
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def by_document(df: DataFrame, key: str = "doc_id") -> DataFrame:
    """Hash-partition a corpus by its document key. One shuffle of the compact rows here makes
    the later per-document groupings, windows and joins free of exchanges."""
    return df.repartition(F.col(key))


def row_count(df: DataFrame) -> Column:
    """Number of rows of ``df`` as a scalar subquery: no action, no cross join."""
    return df.agg(F.count(F.lit(1))).scalar()


def keys_repeat(df: DataFrame, key: str = "doc_id") -> bool:
    """True if a key is null or on more than one row; only the keys are read."""
    return not df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).filter((F.col("n") > 1) | F.col(key).isNull()).isEmpty()


def merge_partitions(df: DataFrame, wanted: int) -> DataFrame:
    """Merge partitions without a shuffle if ``df`` has more than ``wanted`` (and more than the cores), so that
    repeated passes over a small table do not pay for many near-empty tasks."""
    wanted = max(wanted, df.sparkSession.sparkContext.defaultParallelism)
    return df.coalesce(wanted) if df.rdd.getNumPartitions() > wanted else df


def spread_partitions(df: DataFrame, wanted: int) -> DataFrame:
    """``df`` in at least ``wanted`` partitions, for passes whose work is large although the table is small: adaptive execution merges
    partitions by their bytes."""
    return df if df.rdd.getNumPartitions() >= wanted else df.repartition(wanted)
