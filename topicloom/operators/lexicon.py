"""Lemmas and word classes from user-supplied lexicons."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from topicloom.runtime import bounded


def token_rows(docs: DataFrame) -> DataFrame:
    """(doc_id, pos, token); a document without tokens keeps one row with null."""
    return docs.select("doc_id", F.posexplode_outer("tokens").alias("pos", "token"))


def collect_tokens(rows: DataFrame) -> DataFrame:
    """Token rows back to (doc_id, tokens) in position order; null tokens vanish."""
    entry = F.when(F.col("token").isNotNull(), F.struct("pos", "token"))
    ordered = F.array_sort(F.collect_list(entry))
    return rows.groupBy("doc_id").agg(F.transform(ordered, lambda e: e["token"]).alias("tokens"))


def lemmatize(rows: DataFrame, lexicon: DataFrame) -> DataFrame:
    """Replace tokens found in (surface, lemma) by their lemma. ``lexicon`` has one row per surface."""
    table = bounded(lexicon.select(F.col("surface").alias("token"), "lemma"))
    joined = rows.join(table, "token", "left")
    return joined.select("doc_id", "pos", F.lower(F.coalesce("lemma", "token")).alias("token"))


def keep_classes(rows: DataFrame, lexicon: DataFrame, classes: Sequence[str]) -> DataFrame:
    """Keep tokens that (surface, pos) lists with one of the word classes."""
    table = lexicon.filter(F.col("pos").isin(list(classes))).select(F.col("surface").alias("token")).distinct()
    return rows.join(bounded(table), "token", "left_semi")


def lemmas_by_class(
    rows: DataFrame,
    classes_lexicon: DataFrame,
    lemma_lexicon: DataFrame,
    stopwords: Sequence[str],
    classes: Sequence[str] = ("NOUN", "ADJ", "VERB", "ADV"),
    min_length: int = 3,
) -> DataFrame:
    """Word-class filter, then lemmas, then the stopword and length test on the lemma."""
    lemmas = lemmatize(keep_classes(rows.filter(F.col("token").rlike(r"^\p{L}+$")), classes_lexicon, classes), lemma_lexicon)
    return lemmas.filter((F.length("token") >= min_length) & ~F.col("token").isin(list(stopwords)))
