"""Term statistics, dictionaries, bags of words and corpus-derived stopwords.

Corpora are tables (doc_id, tokens) with ``tokens`` an array of strings and ``doc_id`` unique."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from topicloom.functions.tokens import raw_words
from topicloom.runtime import BROADCAST_ROW_LIMIT, bounded, by_document, cut_lineage, is_small, row_count


def term_counts(docs: DataFrame) -> DataFrame:
    """Occurrences of every token: (term, cf). Counts are combined before the shuffle."""
    return docs.select(F.explode("tokens").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("cf"))


def top_terms(docs: DataFrame, n: int = 25) -> DataFrame:
    return term_counts(docs).orderBy(F.col("cf").desc(), "term").limit(n)


def word_frequencies(texts: DataFrame, text: str = "text", n: int = 50) -> DataFrame:
    """Top words of at least two ASCII letters in a cleaned text column."""
    words = F.regexp_extract_all(F.col(text), F.lit(r"\b[a-zA-Z]{2,}\b"), F.lit(0))
    return top_terms(texts.select(words.alias("tokens")), n)


def term_stats(docs: DataFrame) -> DataFrame:
    """Document and corpus frequency of every term: (term, df, cf).

    Each document contributes its tokens and then its distinct tokens, told apart by position, so
    both counts come out of one pass and only combined terms are shuffled, never documents."""
    both = F.concat("tokens", F.array_distinct("tokens"))
    marked = docs.select(F.size("tokens").alias("n"), F.posexplode(both).alias("pos", "term"))
    return marked.groupBy("term").agg(
        F.count_if(F.col("pos") >= F.col("n")).alias("df"),
        F.count_if(F.col("pos") < F.col("n")).alias("cf"),
    )


def document_frequency(docs: DataFrame) -> DataFrame:
    """Documents per term: (term, df)."""
    distinct = docs.select(F.explode(F.array_distinct("tokens")).alias("term"))
    return distinct.groupBy("term").agg(F.count(F.lit(1)).alias("df"))


def share_of(limit: int | float, n_docs: Column) -> Column:
    """A frequency limit: a fraction of all documents if it is a float, else a count."""
    return F.lit(limit) * n_docs if isinstance(limit, float) else F.lit(limit)


def filter_extremes(stats: DataFrame, n_docs: Column, no_below: int = 5, no_above: float = 0.5) -> DataFrame:
    """Keep terms found in at least ``no_below`` documents and at most a share ``no_above`` of them."""
    return stats.filter((F.col("df") >= no_below) & (F.col("df") <= F.lit(float(no_above)) * n_docs))


def with_term_ids(terms: DataFrame, max_rows: int | None = None) -> DataFrame:
    """Add dense ids in term order. A table capped at ``max_rows`` within the broadcast bound is ranked in one
    task. Any other one is range-partitioned by term, which is balanced as terms are unique, and materialised
    so that the ranges stay fixed; terms are ranked inside their range and shifted by the sizes of the
    ranges before it, a table of one row per partition."""
    if max_rows is not None and max_rows <= BROADCAST_ROW_LIMIT:
        return terms.withColumn("term_id", F.row_number().over(Window.orderBy("term")).cast("bigint") - 1)
    placed = cut_lineage(terms.repartitionByRange("term").withColumn("_part", F.spark_partition_id()))
    sizes = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    inside = F.row_number().over(Window.partitionBy("_part").orderBy("term"))
    ranked = placed.withColumn("_rank", inside).join(F.broadcast(offsets), "_part")
    return ranked.withColumn("term_id", F.col("_offset") + F.col("_rank") - 1).drop("_part", "_rank", "_offset")


def dictionary(docs: DataFrame, no_below: int | None = None, no_above: float | None = None) -> DataFrame:
    """Terms with ids and frequencies: (term, df, cf, term_id)."""
    stats = term_stats(docs)
    if no_below is not None or no_above is not None:
        limit = 1.0 if no_above is None else no_above
        stats = filter_extremes(stats, row_count(docs), no_below or 1, limit)
    return with_term_ids(stats)


def doc_term(docs: DataFrame, partitioned: bool = False) -> DataFrame:
    """Term counts per document: (doc_id, term, tf). Documents are hashed by id as compact rows
    (unless the caller says they are already), so the exploded tokens are never shuffled."""
    placed = docs if partitioned else by_document(docs.select("doc_id", "tokens"))
    return (
        placed.select("doc_id", F.explode("tokens").alias("term"))
        .groupBy("doc_id", "term")
        .agg(F.count(F.lit(1)).alias("tf"))
    )


def bag_of_words(docs: DataFrame, vocab: DataFrame, partitioned: bool = False) -> DataFrame:
    """(doc_id, term_id, tf); tokens outside the dictionary are dropped."""
    ids = bounded(vocab).select("term", "term_id")
    return doc_term(docs, partitioned).join(ids, "term").select("doc_id", "term_id", "tf")


def corpus_stopwords(
    texts: DataFrame,
    defaults: Sequence[str],
    text: str = "text",
    top_n: int = 100,
    low_n: int = 100,
    doc_share: float = 0.6,
) -> DataFrame:
    """Words that this corpus marks as stopwords beyond ``defaults``: the most frequent, those in more
    than ``doc_share`` of the documents and those of lowest mean TF-IDF. One column ``word``, cached.

    The words of a text are told once and kept, hashed by ``doc_id``, until the result is known; so are the frequencies of all words."""
    from topicloom.operators.tfidf import mean_tfidf, smooth_idf, weigh

    words = by_document(texts.select("doc_id", raw_words(F.col(text)).alias("tokens"))).persist()
    counted = term_stats(words).persist()
    frequent = counted.orderBy(F.col("cf").desc(), "term").limit(top_n).select("term")

    docs = words.select("doc_id", F.filter("tokens", lambda t: F.length(t) >= 2).alias("tokens"))
    n_docs = row_count(words)
    stats = counted.filter(F.length("term") >= 2)
    common = stats.filter(F.col("df") > F.lit(float(doc_share)) * n_docs).select("term")

    idf = stats.select("term", smooth_idf(F.col("df"), n_docs).alias("idf"))
    weights = weigh(doc_term(docs, partitioned=True), F.broadcast(idf) if is_small(counted) else idf)
    # sums of floating numbers end differently in other partitions: ties are told on rounded ones
    means = mean_tfidf(weights, n_docs).withColumn("mean_tfidf", F.round("mean_tfidf", 12))
    light = means.orderBy("mean_tfidf", "term").limit(low_n).select("term")

    found = frequent.union(common).union(light).distinct()
    found = found.filter(~F.col("term").isin(list(defaults))).select(F.col("term").alias("word")).persist()
    found.count()
    counted.unpersist()
    words.unpersist()
    return found
