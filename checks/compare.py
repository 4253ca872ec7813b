"""Run registered queries beside their DuckDB statements: ``python -m checks.compare SF_DIR [name ...]``."""

from __future__ import annotations

import sys
import time
import traceback

import duckdb
import pandas as pd
from pyspark.sql import SparkSession

from checks.catalog import QUERIES
from checks.oracle import ORACLE

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def canonical(df: pd.DataFrame) -> pd.DataFrame:
    df = df[sorted(df.columns)].copy()
    for c in df.columns:
        if pd.api.types.is_float_dtype(df[c]):
            df[c] = df[c].map(lambda x: "null" if pd.isna(x) else repr(float(x) + 0.0))
        else:
            df[c] = df[c].map(lambda x: "null" if pd.isna(x) else repr(int(x)) if isinstance(x, (int, float)) else str(x))
    return df.sort_values(list(df.columns)).reset_index(drop=True)


def compare(spark: SparkSession, con: duckdb.DuckDBPyConnection, sf: str, name: str) -> str:
    start = time.time()
    mine = QUERIES[name](spark, sf).toPandas()
    took = time.time() - start
    if name not in ORACLE:
        return f"rows {len(mine)} {took:.1f}s (no statement)"
    start = time.time()
    theirs = con.sql(ORACLE[name]).df()
    ref = time.time() - start
    if sorted(mine.columns) != sorted(theirs.columns):
        return f"FAIL columns {sorted(mine.columns)} {sorted(theirs.columns)}"
    if len(mine) != len(theirs):
        return f"FAIL rows {len(mine)} {len(theirs)}"
    a, b = canonical(mine), canonical(theirs)
    if not a.equals(b):
        bad = (a != b).any(axis=1)
        return f"FAIL values in {int(bad.sum())} of {len(a)} rows\n{a[bad].head(3).to_string()[:1500]}\n{b[bad].head(3).to_string()[:1500]}"
    types = {c: (str(mine[c].dtype), str(theirs[c].dtype)) for c in mine.columns if mine[c].dtype != theirs[c].dtype}
    return f"ok rows {len(mine)} {took:.1f}s duckdb {ref:.1f}s {types or ''}"


def main() -> None:
    sf, names = sys.argv[1], sys.argv[2:] or list(QUERIES)
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    for name in names:
        try:
            result = compare(spark, con, sf, name)
        except Exception:  # noqa: BLE001
            result = "FAIL " + traceback.format_exc()[-900:]
        print(f"{name}: {result}", flush=True)
        spark.catalog.clearCache()


if __name__ == "__main__":
    main()
