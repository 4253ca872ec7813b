"""From raw documents to token digests: language, repeated lines, near-duplicates, benchmark passages, byte-level BPE.

Every stage takes all rows its predecessor kept and returns the columns of ``documents``, the last one doc_id and the token
digests. A stage is written and read again before the next one starts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from topicloom.llm.byte_bpe import encode_documents
from topicloom.llm.decontaminate import find_contamination, remove
from topicloom.llm.language_cnn import UNKNOWN, identify
from topicloom.llm.line_runs import dedup_lines
from topicloom.llm.minhash_forest import keep_one
from topicloom.llm.staging import stage

# A text is rejected if the network is less sure of its language than this, or if it has no letter.
MIN_SCORE = 0.5
# Documents are near-duplicates from this percentage of common shingles on (op4's own contract is 85).
SIMILAR = 80

# The language model cannot be expressed in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Leave out texts without a known language."""
    told = identify(docs, into="__language")
    sure = (F.col("__language.lang_pred") != UNKNOWN) & (F.col("__language.score") >= MIN_SCORE)
    return told.filter(sure).drop("__language")


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Delete later copies of repeated line runs; documents of which nothing is left go."""
    cut = dedup_lines(docs, into="__lines")
    left = cut.filter("`__lines`.n_removed = 0 OR `__lines`.n_removed < `__lines`.n_lines")
    length = F.when(F.col("__lines.n_removed") > 0, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars"))
    return left.withColumn("n_chars", length).select(docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the first document of each group of near-duplicates."""
    return keep_one(docs, SIMILAR)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Leave out documents that hold a passage of the benchmark."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return remove(find_contamination(docs, items, into="__hits"), "documents", contamination="__hits")


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Encode by byte-level BPE and decode again."""
    return encode_documents(docs.select("doc_id", "text")).select("doc_id", "tokens.*")


STAGES = [
    ("language", language),
    ("line_dedup", lines),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("byte_bpe", tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, function in STAGES:
        docs = stage(function(spark, docs, sf_dir))
    return docs
