"""Neighbours in a distributed sorted order."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from topicloom.llm.staging import stage


def sorted_neighbours(rows: DataFrame, keys: list[str], back: int = 1) -> DataFrame:
    """``rows`` with ``earlier``: an array of the ``back`` rows before each in the order of ``keys`` over all partitions, the
    nearest first, null where there is none. ``keys`` should tell rows apart, so that no range takes many equal ones; the
    last rows of a range are carried to the next one."""
    parts = max(1, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    names = rows.columns
    ordered = stage(rows.repartitionByRange(parts, *keys).withColumn("part", F.spark_partition_id()))
    filled = [r[0] for r in ordered.select("part").distinct().orderBy("part").collect()]  # no more than the partitions
    seen = ordered.withColumn("carried", F.lit(False))
    if len(filled) > 1:
        following = F.create_map(*[F.lit(x) for ends in zip(filled, filled[1:]) for x in ends])
        last = Window.partitionBy("part").orderBy(*[F.desc(k) for k in keys])
        tails = ordered.withColumn("n", F.row_number().over(last)).filter(F.col("n") <= back).drop("n")
        carried = tails.withColumn("part", following[F.col("part")]).filter("part IS NOT NULL")
        seen = seen.unionByName(carried.withColumn("carried", F.lit(True)))
    within = Window.partitionBy("part").orderBy(*keys)
    earlier = F.array(*[F.lag(F.struct(*names), k).over(within) for k in range(1, back + 1)])
    return seen.withColumn("earlier", earlier).filter("NOT carried").drop("part", "carried")
