"""Latent Dirichlet allocation with Spark ML's online variational Bayes."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import LDA, LDAModel, LocalLDAModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from topicloom.operators.metrics import argmax
from topicloom.runtime import DataValidationError, merge_partitions

DOCUMENTS_PER_TASK = 5_000

SLICE = 1_000  # documents the bound is worked out for at a time

# The settings of the two trainers.
PRESETS = {
    "standard": dict(k=10, passes=20, chunk_size=2000),
    "small": dict(k=5, passes=10, chunk_size=100),
}


@dataclass
class LdaTopics:
    """A fitted model and its dictionary (term_id, term)."""

    model: LDAModel
    vocab: DataFrame

    def topics(self, n: int = 10) -> DataFrame:
        """Top terms per topic (topic_id, rank, term, weight); weights sum to 1 over a whole topic."""
        described = self.model.describeTopics(n)
        pairs = F.arrays_zip(F.col("termIndices").alias("i"), F.col("termWeights").alias("w"))
        rows = described.select(F.col("topic").alias("topic_id"), F.posexplode(pairs).alias("pos", "e"))
        named = rows.select(
            "topic_id", (F.col("pos") + 1).alias("rank"), F.col("e.i").cast("bigint").alias("term_id"), F.col("e.w").alias("weight")
        )
        names = self.vocab.select("term_id", "term")
        return named.join(names, "term_id").select("topic_id", "rank", "term", F.round("weight", 4).alias("weight"))

    def transform(self, bags: DataFrame) -> DataFrame:
        """Topic distribution per document: (doc_id, w); zeros for a document without known terms."""
        scored = self.model.transform(bags)
        return scored.select("doc_id", vector_to_array("topicDistribution").alias("w"))

    def log_perplexity(self, bags: DataFrame) -> float:
        """Per-word likelihood bound, negative."""
        return likelihood_bound(self.model, bags)


def _special_functions():
    """Digamma and log-gamma of positive arrays from their asymptotic series after shifting the argument up by 8.
    Defined inside a function to be shipped to the tasks by value."""

    def digamma(x):
        import numpy as np

        shift = sum(1 / (x + i) for i in range(8))
        y = x + 8
        z = 1 / (y * y)
        return np.log(y) - 0.5 / y - z * (1 / 12 - z * (1 / 120 - z * (1 / 252 - z / 240))) - shift

    def log_gamma(x):
        import numpy as np

        shift = sum(np.log(x + i) for i in range(8))
        y = x + 8
        z = 1 / (y * y)
        series = (1 / 12 - z * (1 / 360 - z * (1 / 1260 - z / 1680))) / y
        return (y - 0.5) * np.log(y) - y + 0.5 * np.log(2 * np.pi) + series - shift

    return digamma, log_gamma


def likelihood_bound(model: LDAModel, bags: DataFrame) -> float:
    """Variational bound on the log likelihood divided by the number of tokens. The parameters of a document follow
    from its topic distribution, as their sum is that of the prior plus the document length, so one pass with
    work linear in the entries is enough; Spark ML's own measure touches the whole vocabulary per document."""
    digamma, log_gamma = _special_functions()
    topics = model.topicsMatrix().toArray().T  # k x V, bounded when the model was fitted
    alpha, eta = model.estimatedDocConcentration().toArray(), float(model.getTopicConcentration())
    log_beta = digamma(topics) - digamma(topics.sum(axis=1, keepdims=True))
    shared = bags.sparkSession.sparkContext.broadcast((log_beta, alpha))

    def document_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np
        import pyarrow as pa

        log_beta, alpha = shared.value
        for batch in batches:
            bound = tokens = 0.0
            for part in (batch.slice(a, SLICE) for a in range(0, batch.num_rows, SLICE)):
                lengths = np.diff(part.column("idx").offsets.to_numpy())
                columns = part.column("idx").flatten().to_numpy(zero_copy_only=False)
                values = part.column("val").flatten().to_numpy(zero_copy_only=False)
                theta = part.column("w").flatten().to_numpy(zero_copy_only=False).reshape(part.num_rows, len(alpha))
                theta, lengths = theta[lengths > 0], lengths[lengths > 0]
                if not len(lengths):
                    continue
                n = np.add.reduceat(values, np.cumsum(lengths) - lengths)
                gamma = theta * (alpha.sum() + n)[:, None]
                log_theta = digamma(gamma) - digamma(gamma.sum(axis=1, keepdims=True))
                scores = np.repeat(log_theta, lengths, axis=0) + log_beta.T[columns]
                top = scores.max(axis=1)
                bound += float(values @ (top + np.log(np.exp(scores - top[:, None]).sum(axis=1))))
                bound += float(((alpha - gamma) * log_theta + log_gamma(gamma) - log_gamma(alpha)).sum())
                bound += float((log_gamma(alpha.sum()) - log_gamma(gamma.sum(axis=1))).sum())
                tokens += float(n.sum())
            yield pa.RecordBatch.from_arrays([pa.array([bound]), pa.array([tokens])], names=["bound", "tokens"])

    vector = F.unwrap_udt("features")
    scored = model.transform(bags).select(
        vector["indices"].alias("idx"), vector["values"].alias("val"), vector_to_array("topicDistribution").alias("w")
    )
    sums = scored.mapInArrow(document_parts, "bound double, tokens double").agg(F.sum("bound"), F.sum("tokens")).first()
    width = topics.shape[1]
    topic_part = ((eta - topics) * log_beta + log_gamma(topics) - log_gamma(np.float64(eta))).sum()
    topic_part += (log_gamma(np.float64(eta * width)) - log_gamma(topics.sum(axis=1))).sum()
    shared.unpersist()
    return float((sums[0] + topic_part) / sums[1])


def dominant_topics(distributions: DataFrame, w: str = "w") -> DataFrame:
    """Most probable topic per document, -1 for an empty distribution."""
    heaviest = F.array_max(w)
    topic = F.when(heaviest.isNull() | (heaviest <= 0), F.lit(-1)).otherwise(argmax(F.col(w)))
    return distributions.select("doc_id", topic.alias("dominant_topic"))


def fit_lda(
    bags: DataFrame,
    vocab: DataFrame,
    k: int = 10,
    passes: int = 20,
    chunk_size: int = 2000,
    decay: float = 0.5,
    offset: float = 10.0,
    learn_priors: bool = True,
    topic_prior: float | None = None,
    seed: int = 42,
) -> LdaTopics:
    """Fit on (doc_id, features) of term counts. A pass is ``documents / chunk_size`` batches. Every batch reads the whole
    cached table and samples it with replacement, so a large corpus wants a ``chunk_size`` that grows with it, and a pass
    does not meet every document exactly once. ``topic_prior`` is 1/k unless given.

    Spark ML keeps the k x V topic weights on the driver and in every task: the caller bounds the dictionary.
    ``bags`` stays cached if it was; otherwise it is cached for the fit only."""
    if vocab.isEmpty():
        raise DataValidationError("the dictionary is empty")
    cached = bags.storageLevel.useMemory or bags.storageLevel.useDisk
    held = bags if cached else bags.persist()
    try:
        n = held.count()
        if n == 0:
            raise DataValidationError("no documents")
        batches = max(1, math.ceil(n / chunk_size))
        lda = LDA(
            k=k, maxIter=passes * batches, optimizer="online", subsamplingRate=min(1.0, 1.0 / batches), learningDecay=decay,
            learningOffset=offset, optimizeDocConcentration=learn_priors, seed=seed, featuresCol="features",
            topicConcentration=1.0 / k if topic_prior is None else topic_prior,
        )
        model = lda.fit(merge_partitions(held, n // DOCUMENTS_PER_TASK))
    finally:
        if not cached:
            held.unpersist()
    return LdaTopics(model, vocab.select("term_id", "term"))


def save_lda(fitted: LdaTopics, path: str) -> str:
    fitted.model.write().overwrite().save(f"{path}/model")
    fitted.vocab.write.mode("overwrite").parquet(f"{path}/vocab")
    return path


def load_lda(spark: SparkSession, path: str) -> LdaTopics:
    return LdaTopics(LocalLDAModel.load(f"{path}/model"), spark.read.parquet(f"{path}/vocab"))
