"""Corpus and topic readers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from topicloom.functions.text import WHITESPACE
from topicloom.functions.tokens import split_words
from topicloom.runtime import DataValidationError


def read_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str | None = None,
    delimiter: str = ",",
    encoding: str = "utf-8",
    multiline: bool = False,
) -> DataFrame:
    """Quoted CSV with a header. Without a schema all columns are strings, so that no extra pass
    infers types. ``multiline=True`` is for files with line breaks inside quotes; Spark then reads each
    file in one task."""
    reader = spark.read.options(
        header=True, sep=delimiter, encoding=encoding, quote='"', escape='"', multiLine=multiline
    )
    return (reader.schema(schema) if schema is not None else reader).csv(path)


def _unquoted_lines(spark: SparkSession, path: str) -> tuple[list[str], DataFrame]:
    """Header fields and the other non-empty lines. The first line of every file is its header; a later line equal to it
    is a row. The CSV reader, given a separator that no text holds, knows where a file starts."""
    header = spark.read.text(path).first()
    if header is None:
        raise DataValidationError(f"no header in {path}")
    whole = {"header": "true", "sep": "\u0001\u0002\u0001", "quote": "", "escape": "", "comment": "", "enforceSchema": "true"}
    rows = spark.read.schema("value string").options(**whole).csv(path)
    return header.value.split("\t"), rows.filter("value IS NOT NULL AND value != ''")


def read_tsv(spark: SparkSession, path: str) -> DataFrame:
    """Tab-separated text without quoting. Lines with too many fields are skipped, short ones are
    filled with nulls, and an empty field is null."""
    names, lines = _unquoted_lines(spark, path)
    rows = lines.select(F.split("value", "\t").alias("_parts")).filter(F.size("_parts") <= len(names))
    return rows.select(*[F.nullif(F.get("_parts", F.lit(i)), F.lit("")).alias(n) for i, n in enumerate(names)])


def read_ragged_tsv(
    spark: SparkSession, path: str, fields: int = 4, max_rows: int | None = None
) -> DataFrame:
    """Tab-separated salvage read: keep lines with at least ``fields`` fields, the first ones only."""
    names, lines = _unquoted_lines(spark, path)
    kept = split_ragged(lines, "value", names[:fields])
    return kept if max_rows is None else kept.limit(max_rows)


def split_ragged(lines: DataFrame, line: str, names: Sequence[str]) -> DataFrame:
    """The salvage rule on a column of tab-separated lines."""
    parts = F.split(F.col(line), "\t")
    return (
        lines.withColumn("_parts", parts)
        .filter(F.size("_parts") >= len(names))
        .select(
            *[c for c in lines.columns if c != line],
            *[F.get("_parts", F.lit(i)).alias(name) for i, name in enumerate(names)],
        )
    )


def read_corpus(spark: SparkSession, path: str | None = None, format: str = "parquet", **options) -> DataFrame:
    """Any built-in source: parquet, orc, json, text, csv, jdbc."""
    reader = spark.read.format(format).options(**options)
    return reader.load(path) if path is not None else reader.load()


def corpus_from_list(spark: SparkSession, texts: Sequence[str]) -> DataFrame:
    """In-memory texts; their position becomes the document id."""
    rows = [(i, str(text)) for i, text in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id bigint, text string")


def parse_list_column(df: DataFrame, column: str) -> DataFrame:
    """Turn a list rendered as text (``['a', "b"]``) into an array of strings."""
    quoted = F.regexp_extract_all(F.col(column), F.lit("'([^']*)'|\"([^\"]*)\""), F.lit(0))
    return df.withColumn(column, F.transform(quoted, lambda q: F.substr(q, F.lit(2), F.length(q) - 2)))


def load_tokens(df: DataFrame) -> DataFrame:
    """Add or convert ``tokens`` of a preprocessed table: from ``tokens``, else ``cleaned_tokens``,
    else ``cleaned_text`` split on white space."""
    for column in ("tokens", "cleaned_tokens"):
        if column in df.columns:
            named = df.withColumn("tokens", F.col(column))
            return named if isinstance(df.schema[column].dataType, T.ArrayType) else parse_list_column(named, "tokens")
    if "cleaned_text" not in df.columns:
        raise DataValidationError("the table has neither tokens nor cleaned_tokens nor cleaned_text")
    return df.withColumn("tokens", split_words(F.col("cleaned_text")))


def parse_topics(df: DataFrame, words: str = "words") -> DataFrame:
    """Topic rows with words rendered as ``[('term', weight), ...]`` to (topic_id, rank, term, weight)."""
    pattern = F.lit(rf"\('([^']*)',[{WHITESPACE}]*([-+0-9.eE]+)\)")
    terms = F.regexp_extract_all(F.col(words), pattern, F.lit(1))
    weights = F.regexp_extract_all(F.col(words), pattern, F.lit(2))
    pairs = F.arrays_zip(terms.alias("term"), weights.alias("weight"))
    return df.select(F.col("topic_id").cast("int"), F.posexplode(pairs).alias("pos", "pair")).select(
        "topic_id",
        (F.col("pos") + 1).alias("rank"),
        F.col("pair.term").alias("term"),
        F.col("pair.weight").cast("double").alias("weight"),
    )


def read_topics_csv(spark: SparkSession, path: str) -> DataFrame:
    return parse_topics(read_csv(spark, path, "topic_id int, words string"))
