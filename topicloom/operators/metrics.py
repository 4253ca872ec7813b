"""Topic metrics, model comparison and the tables behind their charts.

Topics are (topic_id, rank, term, weight); metrics are the long table (model, model_ord, metric, value, error)
with one row per model and metric and ``model_ord`` the order in which models were given."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from topicloom.operators.vocab import term_counts
from topicloom.runtime import bounded

COMPARED = ("topic_diversity", "coherence_score", "silhouette_score")
LOWER_IS_BETTER = ("perplexity",)


def argmax(values: Column) -> Column:
    """Position of the largest element, the lowest one on ties."""
    return (F.array_position(values, F.array_max(values)) - 1).cast("int")


def topic_diversity(topics: DataFrame, n: int = 10) -> DataFrame:
    """Distinct share of the top words of all topics: one row (diversity)."""
    top = topics.filter(F.col("rank") <= n)
    share = F.count_distinct("term") / F.count("term")
    return top.agg(F.when(F.count("term") > 0, share).otherwise(0.0).alias("diversity"))


def topic_intrusion(docs: DataFrame, topics: DataFrame, n: int = 10) -> DataFrame:
    """Mean over topics of min(1, mean corpus frequency of their top words / 100): one row (intrusion). The
    corpus is reduced to the topic words in the scan and counted once for all topics."""
    top = topics.filter(F.col("rank") <= n).select("topic_id", "term")
    wanted = bounded(top.select("term").distinct())
    counts = docs.select(F.explode("tokens").alias("term")).join(wanted, "term").groupBy("term").agg(F.count(F.lit(1)).alias("cf"))
    scored = top.join(counts, "term", "left").groupBy("topic_id").agg(F.avg(F.coalesce("cf", F.lit(0))).alias("freq"))
    return scored.agg(F.coalesce(F.avg(F.least(F.lit(1.0), F.col("freq") / 100)), F.lit(0.0)).alias("intrusion"))


def topic_sizes(doc_topics: DataFrame) -> DataFrame:
    """Documents per dominant topic: (dominant_topic, n_docs)."""
    return doc_topics.groupBy("dominant_topic").agg(F.count(F.lit(1)).alias("n_docs"))


def topic_consistency(per_topic: DataFrame) -> DataFrame:
    """Mean and population deviation of a per-topic coherence."""
    return per_topic.agg(F.avg("coherence").alias("mean"), F.stddev_pop("coherence").alias("std"))


def topic_prevalence(doc_topics: DataFrame, lengths: DataFrame) -> DataFrame:
    """Share of all tokens per topic from (doc_id, topic_id, weight) and (doc_id, doc_len)."""
    mass = doc_topics.join(lengths, "doc_id").groupBy("topic_id").agg(F.sum(F.col("weight") * F.col("doc_len")).alias("mass"))
    total = mass.agg(F.sum("mass")).scalar()
    return mass.select("topic_id", "mass", (F.col("mass") / total).alias("prevalence"))


def term_relevance(topic_terms: DataFrame, counts: DataFrame, lam: float = 0.6, n: int = 30) -> DataFrame:
    """The ``n`` most relevant terms per topic, relevance = lam ln(phi) + (1 - lam) ln(phi / p). ``topic_terms`` is
    (topic_id, term, phi) and ``counts`` is (term, cf)."""
    total = counts.agg(F.sum("cf")).scalar()
    share = F.col("cf") / total
    scored = topic_terms.join(counts, "term").filter(F.col("phi") > 0)
    scored = scored.withColumn("relevance", lam * F.log("phi") + (1 - lam) * F.log(F.col("phi") / share))
    order = Window.partitionBy("topic_id").orderBy(F.col("relevance").desc(), "term")
    ranked = scored.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= n)
    return ranked.select("topic_id", "rank", "term", "relevance")


def _usable(metrics: DataFrame) -> DataFrame:
    """Values of models that did not fail."""
    return metrics.filter(F.col("error").isNull() & F.col("value").isNotNull() & ~F.isnan("value"))


def _listed(metrics: DataFrame, names: Sequence[str]) -> DataFrame:
    rows = [(name, i) for i, name in enumerate(names)]
    return F.broadcast(metrics.sparkSession.createDataFrame(rows, "metric string, metric_ord int"))  # a few names


def metric_winners(
    metrics: DataFrame, names: Sequence[str] = COMPARED + LOWER_IS_BETTER, lower_is_better: Sequence[str] = LOWER_IS_BETTER
) -> DataFrame:
    """Best model per metric, the first given one on ties: (metric, model, score); ('N/A', 0) without a value."""
    signed = F.when(F.col("metric").isin(list(lower_is_better)), F.col("value")).otherwise(-F.col("value"))
    best = _usable(metrics).groupBy("metric").agg(
        F.min(F.struct(signed.alias("s"), "model_ord", "model", "value")).alias("w")
    )
    return _listed(metrics, names).join(best, "metric", "left").select(
        "metric", F.coalesce("w.model", F.lit("N/A")).alias("model"), F.coalesce("w.value", F.lit(0.0)).alias("score")
    )


def metric_summary(metrics: DataFrame, names: Sequence[str] = COMPARED + LOWER_IS_BETTER) -> DataFrame:
    """Mean, population deviation, minimum and maximum per metric, zeros without a value."""
    stats = _usable(metrics).groupBy("metric").agg(
        F.avg("value").alias("mean"), F.stddev_pop("value").alias("std"), F.min("value").alias("min"), F.max("value").alias("max")
    )
    filled = [F.coalesce(c, F.lit(0.0)).alias(c) for c in ("mean", "std", "min", "max")]
    return _listed(metrics, names).join(stats, "metric", "left").select("metric", *filled)


def metric_matrix(
    metrics: DataFrame, names: Sequence[str] = ("topic_diversity", "coherence_score", "perplexity", "silhouette_score", "num_topics")
) -> DataFrame:
    """One row per model with a column per metric; nulls are 0 and silhouette is floored at 0."""
    value = F.when(F.col("metric") == "silhouette_score", F.greatest("value", F.lit(0.0))).otherwise(F.col("value"))
    wide = metrics.filter(F.col("error").isNull()).groupBy("model").pivot("metric", list(names)).agg(F.first(value))
    return wide.na.fill(0.0, list(names))


def radar_scores(metrics: DataFrame) -> DataFrame:
    """Metrics scaled for a radar chart: (model, topic_diversity, coherence_score, perplexity_inverted, silhouette_score)."""
    wide = metrics.filter(F.col("error").isNull()).groupBy("model").pivot("metric", [*COMPARED, *LOWER_IS_BETTER]).agg(F.first("value"))
    p = F.col("perplexity")
    return wide.select(
        "model",
        F.coalesce("topic_diversity", F.lit(0.0)).alias("topic_diversity"),
        F.coalesce("coherence_score", F.lit(0.0)).alias("coherence_score"),
        F.when(p > 0, F.greatest(F.lit(0.0), 1 - p / 1000)).otherwise(0.0).alias("perplexity_inverted"),
        F.greatest(F.lit(0.0), F.coalesce("silhouette_score", F.lit(0.0))).alias("silhouette_score"),
    )
