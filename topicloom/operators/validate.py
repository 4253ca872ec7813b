"""Table checks, table cleaning and profiles."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from topicloom.functions.text import trim_whitespace
from topicloom.runtime import BROADCAST_ROW_LIMIT, DataValidationError, cut_lineage


def missing_columns(df: DataFrame, expected: Iterable[str]) -> set[str]:
    return set(expected) - set(df.columns)


def require_columns(df: DataFrame, expected: Iterable[str]) -> DataFrame:
    missing = missing_columns(df, expected)
    if missing:
        raise DataValidationError(f"missing columns: {sorted(missing)}")
    return df


def profile(df: DataFrame) -> DataFrame:
    """Rows, columns and nulls of every column in one pass: (column_name, n_nulls, n_rows, n_columns)."""
    counts = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count_if(F.col(f"`{c}`").isNull()).alias(f"n{i}") for i, c in enumerate(df.columns)],
    )
    entries = F.array(
        *[F.struct(F.lit(c).alias("column_name"), F.col(f"n{i}").alias("n_nulls")) for i, c in enumerate(df.columns)]
    )
    return counts.select("_rows", F.explode(entries).alias("entry")).select(
        "entry.column_name",
        "entry.n_nulls",
        F.col("_rows").alias("n_rows"),
        F.lit(len(df.columns)).cast("bigint").alias("n_columns"),
    )


def require_no_nulls(df: DataFrame) -> DataFrame:
    found = profile(df).filter(F.col("n_nulls") > 0).collect()  # one row per column at most
    if found:
        raise DataValidationError(f"missing values: { {r.column_name: r.n_nulls for r in found} }")
    return df


def fingerprint(df: DataFrame) -> Column:
    """Two seeded 64-bit hashes of all values of a row. Equal rows have equal ones; nulls leave no trace, so different rows may too."""
    columns = [F.col(f"`{c}`") for c in df.columns]
    return F.struct(*[F.xxhash64(F.lit(seed), *columns).alias(f"h{seed}") for seed in (1, 2)])


def _suspects(df: DataFrame) -> tuple[DataFrame, DataFrame, str, DataFrame]:
    """(counts, marked, name, repeated): rows by fingerprint; ``df`` with its fingerprint in a column of a new name; the fingerprints seen
    more than once. Only fingerprints are shuffled; the repeated ones are broadcast if a count finds them within
    BROADCAST_ROW_LIMIT (of two numbers each), and met by shuffle beyond it."""
    name = "_fingerprint"
    while name in df.columns:
        name = f"_{name}"
    marked = df.withColumn(name, fingerprint(df))
    counts = marked.groupBy(name).agg(F.count(F.lit(1)).alias("_n"))
    repeated = cut_lineage(counts.filter("_n > 1").select(name))
    return counts, marked, name, F.broadcast(repeated) if repeated.count() <= BROADCAST_ROW_LIMIT else repeated


def duplicate_count(df: DataFrame) -> DataFrame:
    """Rows beyond the first of each group of equal rows: (n_rows, n_duplicates). Whole rows move, and are compared, only where their
    fingerprint was seen twice."""
    counts, marked, name, repeated = _suspects(df)
    groups = marked.join(repeated, name, "left_semi").groupBy(*[f"`{c}`" for c in df.columns]).agg(F.count(F.lit(1)).alias(name))
    duplicates = groups.agg(F.coalesce(F.sum(F.col(name) - 1), F.lit(0))).scalar()
    return counts.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("n_rows")).select("n_rows", duplicates.alias("n_duplicates"))


def require_no_duplicates(df: DataFrame) -> DataFrame:
    n = duplicate_count(df).first()["n_duplicates"]
    if n > 0:
        raise DataValidationError(f"{n} duplicate rows")
    return df


def require_unique(df: DataFrame, key: str) -> DataFrame:
    n = duplicate_count(df.select(key)).first()["n_duplicates"]
    if n > 0:
        raise DataValidationError(f"{n} rows repeat a {key}")
    return df


def drop_duplicates(df: DataFrame) -> DataFrame:
    """``df`` with one of each group of equal rows. Rows whose fingerprint is their own stay where they are."""
    _, marked, name, repeated = _suspects(df)
    alone = marked.join(repeated, name, "left_anti").drop(name)
    return alone.unionByName(marked.join(repeated, name, "left_semi").drop(name).dropDuplicates())


def trim_strings(df: DataFrame) -> DataFrame:
    """Strip white space of all kinds from both ends of every string column."""
    return df.select(
        *[
            trim_whitespace(F.col(f"`{f.name}`")).alias(f.name)
            if isinstance(f.dataType, T.StringType)
            else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )


def quality_summary(raw: DataFrame, preprocessed: DataFrame) -> DataFrame:
    """Rows, columns and total nulls of both sides."""

    def side(name: str, df: DataFrame) -> DataFrame:
        return profile(df).agg(
            F.lit(name).alias("side"),
            F.max("n_rows").alias("n_rows"),
            F.max("n_columns").alias("n_columns"),
            F.sum("n_nulls").alias("n_nulls"),
        )

    return side("raw", raw).unionByName(side("preprocessed", preprocessed))


def validated(
    df: DataFrame,
    expected: Iterable[str] = (),
    allow_duplicates: bool = False,
    extra_checks: Iterable[Callable[[DataFrame], DataFrame]] = (),
    key: str | None = None,
) -> DataFrame:
    """Columns, nulls, duplicates, then the caller's checks; returns the trimmed table. A check takes
    the table and returns it, or raises. A ``key`` has to be unique in any case, and rows that differ in nothing
    but the key are duplicates."""
    require_no_nulls(require_columns(df, expected))
    if key is not None:
        require_unique(df, key)
    if not allow_duplicates:
        require_no_duplicates(df if key is None else df.drop(key))
    for check in extra_checks:
        df = check(df)
    return trim_strings(df)
