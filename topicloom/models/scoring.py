"""Topic prediction for a table of texts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from topicloom.models.lda import LdaTopics
from topicloom.models.nmf import NmfModel
from topicloom.models.online_lda import OnlineLda
from topicloom.operators.tfidf import TfidfModel
from topicloom.plans.preprocess import preprocess_new


def top_topics(distributions: DataFrame, n: int = 5, w: str = "w") -> DataFrame:
    """The ``n`` heaviest topics per document: (doc_id, topics, dominant_topic, confidence). Sorting stays inside
    the row; ties go to the lower topic id. Without topics the dominant one is null and the confidence 0."""
    entries = F.transform(w, lambda x, i: F.struct((-x).alias("neg"), i.alias("topic_id"), x.alias("probability")))
    best = F.slice(F.array_sort(entries), 1, n)
    return distributions.select("doc_id", best.alias("best")).select(
        "doc_id",
        F.transform("best", lambda e: F.struct(e["topic_id"].alias("topic_id"), e["probability"].alias("probability"))).alias("topics"),
        F.get("best", F.lit(0))["topic_id"].alias("dominant_topic"),
        F.coalesce(F.get("best", F.lit(0))["probability"], F.lit(0.0)).alias("confidence"),
    )


def attach_words(predictions: DataFrame, topics: DataFrame, n: int = 10) -> DataFrame:
    """Add the top words of each predicted topic. The topics table is folded to one map (k entries) and looked
    up inside the row, so predictions are neither exploded nor joined."""
    word = F.struct("rank", F.col("term").alias("word"), "weight")
    per_topic = topics.filter(F.col("rank") <= n).groupBy("topic_id").agg(F.array_sort(F.collect_list(word)).alias("words"))
    words = F.transform("words", lambda e: F.struct(e["word"].alias("word"), e["weight"].alias("weight")))
    table = per_topic.agg(F.map_from_entries(F.collect_list(F.struct("topic_id", words.alias("words"))))).scalar()
    held = predictions.withColumn("_words", table)
    joined = F.transform(
        "topics",
        lambda e: F.struct(
            e["topic_id"].alias("topic_id"),
            e["probability"].alias("probability"),
            F.try_element_at("_words", e["topic_id"]).alias("topic_words"),
        ),
    )
    return held.withColumn("topics", joined).drop("_words")


def distributions(
    docs: DataFrame,
    model: LdaTopics | OnlineLda | NmfModel,
    vectorizer: TfidfModel,
    phrase_tables: Sequence[DataFrame] = (),
    text: str = "text",
    stopwords: Sequence[str] | None = None,
    lexicon: DataFrame | None = None,
) -> DataFrame:
    """Topic weights (doc_id, w) of raw texts, with the phrases and the vocabulary of the training. NMF gives raw
    weights, LDA probabilities."""
    tokens = preprocess_new(docs, phrase_tables, text, stopwords, lexicon=lexicon)
    if isinstance(model, (LdaTopics, OnlineLda)):
        return model.transform(vectorizer.bags(tokens))
    return model.transform(vectorizer.arrays(tokens, partitioned=True))


def predict(docs: DataFrame, model: LdaTopics | OnlineLda | NmfModel, vectorizer: TfidfModel, num_topics: int = 5, **options) -> DataFrame:
    """Top topics with their words for every document: (doc_id, topics, dominant_topic, confidence)."""
    scored = top_topics(distributions(docs, model, vectorizer, **options), num_topics)
    return attach_words(scored, model.topics(10))


def predict_batch(
    docs: DataFrame, model: LdaTopics | OnlineLda | NmfModel, vectorizer: TfidfModel, num_topics: int = 5, text: str = "text", **options
) -> DataFrame:
    """Predictions for a whole table; a row that cannot be scored keeps its id and text and gets an ``error``."""
    usable = docs.filter(F.col(text).isNotNull())
    scored = predict(usable, model, vectorizer, num_topics, text=text, **options)
    prediction = F.struct("topics", "dominant_topic", "confidence").alias("prediction")
    joined = docs.select("doc_id", F.col(text).alias("text")).join(scored.select("doc_id", prediction), "doc_id", "left")
    return joined.withColumn("error", F.when(F.col("text").isNull(), F.lit("text is null")))


def batch_counts(batch: DataFrame) -> DataFrame:
    return batch.agg(
        F.count(F.lit(1)).alias("total_texts"), F.count_if(F.col("error").isNull()).alias("successful_predictions")
    )
