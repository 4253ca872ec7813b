"""Filters, ordered limits, per-group top-k and set operations on plain tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def filter_equal(df: DataFrame, key: str, value, sort_by: str | None = None, row_id: str | None = None):
    """Rows whose ``key`` equals ``value`` (null matches null) and their count as a second table.
    Sorting treats a missing value as 0 and keeps the order of ``row_id`` among equals."""
    kept = df.filter(F.col(key).eqNullSafe(F.lit(value)))
    if sort_by:
        order = [F.coalesce(F.col(sort_by), F.lit(0))]
        kept = kept.orderBy(*order, *([row_id] if row_id else []))
    return kept, kept.agg(F.count(F.lit(1)).alias("n_matches"))


def top_n(df: DataFrame, n: int, *order: Column) -> DataFrame:
    """The first ``n`` rows of an order, as a bounded heap per task."""
    return df.orderBy(*order).limit(n)


def top_per_group(df: DataFrame, keys: list[str], n: int, *order: Column, rank: str = "rank") -> DataFrame:
    """The first ``n`` rows of every group. Each task keeps its own ``n`` best rows per group before
    the shuffle, so a group holding a large share of the rows reaches one task already reduced."""
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(window)).filter(F.col(rank) <= n)


def union_distinct(left: DataFrame, right: DataFrame) -> DataFrame:
    return left.union(right).distinct()


def difference(left: DataFrame, right: DataFrame) -> DataFrame:
    """Distinct rows of ``left`` that are not in ``right``."""
    return left.subtract(right)


def head(df: DataFrame, n: int, key: str = "doc_id") -> DataFrame:
    """The first ``n`` rows by key, for trial runs."""
    return df.orderBy(key).limit(n)


def latest(history: DataFrame, n: int, ts: str, *tie: str, per: str | None = None) -> DataFrame:
    """The ``n`` newest rows, overall or per value of a column."""
    order = [F.col(ts).desc(), *[F.col(c).desc() for c in tie]]
    return top_per_group(history, [per], n, *order) if per else top_n(history, n, *order)
