"""Evaluation of one model and comparison of several."""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from topicloom.operators import metrics as M
from topicloom.operators.coherence import model_coherence
from topicloom.operators.silhouette import silhouette, silhouette_squared

METRICS = "model string, model_ord int, metric string, value double, error string"

HOOK_ROWS = 1_000

# A custom metric: (topics, doc_topics, docs) -> DataFrame(metric, value).
Hook = Callable[[DataFrame, DataFrame, DataFrame], DataFrame]


@dataclass
class Candidate:
    """What an evaluation needs from a model: its top words (topic_id, rank, term, weight), its document weights
    (doc_id, w) and the measures only one kind of model has."""

    name: str
    topics: DataFrame
    doc_weights: DataFrame
    perplexity: float | None = None
    reconstruction_error: float | None = None


def _number(df: DataFrame) -> float | None:
    value = df.first()[0]
    return None if value is None else float(value)


def evaluate(
    candidate: Candidate, docs: DataFrame, order: int = 0, squared_silhouette: bool = True, hooks: Sequence[Hook] = ()
) -> DataFrame:
    """The metric record of one model in long form. A metric that fails is null with the reason in ``error`` and does not stop
    the others. The silhouette is the linear one of squared distances under its own name; ``squared_silhouette=False``
    asks for the exact one, whose work grows with the square of the documents."""
    spark = docs.sparkSession
    started = time.time()
    topics = candidate.topics.persist()
    weights = candidate.doc_weights.persist()
    points = weights.select(F.col("w").alias("vector"), M.argmax(F.col("w")).alias("label"))
    measures: dict[str, Callable[[], float | None]] = {
        "coherence_score": lambda: _number(model_coherence(docs, topics)),
        "topic_diversity": lambda: _number(M.topic_diversity(topics)),
        "topic_intrusion_score": lambda: _number(M.topic_intrusion(docs, topics)),
        "perplexity": lambda: candidate.perplexity,
        "reconstruction_error": lambda: candidate.reconstruction_error,
        "num_topics": lambda: _number(topics.agg(F.count_distinct("topic_id").cast("double"))),
    }
    if squared_silhouette:
        measures["silhouette_squared"] = lambda: _number(silhouette_squared(points))
    else:
        measures["silhouette_score"] = lambda: _number(silhouette(points))

    def measured(name: str) -> tuple:
        try:
            return (candidate.name, order, name, measures[name](), None)
        except Exception as error:  # noqa: BLE001 - a failed metric is reported as null
            return (candidate.name, order, name, None, f"{type(error).__name__}: {error}"[:500])

    # The metrics are independent jobs of many short stages; run together they fill each other's gaps.
    with ThreadPoolExecutor(len(measures)) as pool:
        rows = list(pool.map(measured, measures))
    for hook in hooks:
        found = hook(topics, weights, docs).take(HOOK_ROWS + 1)
        if len(found) > HOOK_ROWS:
            raise ValueError(f"a custom metric returns at most {HOOK_ROWS} numbers")
        rows += [(candidate.name, order, row.metric, float(row.value), None) for row in found]
    rows.append((candidate.name, order, "evaluation_time", time.time() - started, None))
    topics.unpersist()
    weights.unpersist()
    return spark.createDataFrame(rows, METRICS)


def failed(spark: SparkSession, name: str, order: int, error: str) -> DataFrame:
    """The record of a model that could not be evaluated: zeros and the error."""
    names = ("topic_diversity", "coherence_score", "perplexity", "silhouette_score", "num_topics")
    return spark.createDataFrame([(name, order, metric, 0.0, error) for metric in names], METRICS)


def compare(
    candidates: Sequence[tuple[str, Callable[[], Candidate]]], docs: DataFrame, **options
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Evaluate each model once; returns metrics, winners and summary. A candidate is built by its function, so that
    a model that cannot be loaded is reported and the others go on."""
    spark = docs.sparkSession
    metrics = spark.createDataFrame([], METRICS)
    for order, (name, build) in enumerate(candidates):
        try:
            found = evaluate(build(), docs, order, **options)
        except Exception as error:  # noqa: BLE001
            found = failed(spark, name, order, str(error))
        metrics = metrics.unionByName(found)
    return metrics, M.metric_winners(metrics), M.metric_summary(metrics)


def model_status(metrics: DataFrame) -> DataFrame:
    """One row per model with its error, if any: (model, error). A model failed if it has no metric without error; one metric
    that failed does not fail the model."""
    whole = F.when(F.count_if(F.col("error").isNull()) == 0, F.max("error"))
    return metrics.groupBy("model").agg(whole.alias("error"))
