"""Headline timings on one machine: prints one JSON line."""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.catalog import QUERIES
from topicloom.functions.stopwords import merged_stopwords
from topicloom.functions.text import clean
from topicloom.models import nmf as N
from topicloom.models import online_lda as O
from topicloom.models import scoring as S
from topicloom.operators import coherence as C
from topicloom.operators import phrases as P
from topicloom.operators import tfidf as I
from topicloom.plans.evaluate import Candidate, evaluate
from topicloom.plans.preprocess import preprocess, tokenize

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")


def run(df: DataFrame) -> None:
    """Compute every row without keeping any."""
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("bench")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.driver.memory", "16g")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds: dict[str, float] = {}

    def timed(name, job):
        start = time.time()
        result = job()
        seconds[name] = round(time.time() - start, 3)
        return result

    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    run(docs.select(clean(F.col("text"))).limit(100))  # starts the Python workers

    timed("clean_text", lambda: run(docs.select("doc_id", clean(F.col("text")))))
    timed("preprocess", lambda: run(preprocess(docs)))
    spark.catalog.clearCache()

    tokens = tokenize(docs).persist()
    timed("tokenize", lambda: run(tokens))
    timed("phrases_learn", lambda: run(P.learn_phrases(tokens)))

    def fit_and_weigh():
        model = I.fit_tfidf(tokens, stop_words=merged_stopwords(), **I.PRESETS["tfidf"])
        run(model.transform(tokens, partitioned=True))
        return model

    vectorizer = timed("tfidf_fit_transform", fit_and_weigh)
    rows = vectorizer.arrays(tokens, partitioned=True).persist()
    timed("tfidf_arrays", lambda: run(rows))

    nmf = timed("nmf_fit_20_passes", lambda: N.fit_nmf(rows, vectorizer.vocab, k=8, max_iter=20, tol=0.0))
    bags = vectorizer.bags(tokens).persist()
    lda = timed("lda_fit_20_passes", lambda: O.fit_online_lda(bags, vectorizer.vocab, k=10, passes=20))
    timed("coherence_cv", lambda: C.model_coherence(tokens, nmf.topics()).collect())
    timed(
        "evaluate_nmf",
        lambda: evaluate(Candidate("NMF", nmf.topics(), nmf.transform(rows), None, nmf.reconstruction_error), tokens).collect(),
    )
    timed(
        "evaluate_lda",
        lambda: evaluate(Candidate("LDA", lda.topics(), lda.transform(bags), lda.log_perplexity(bags)), tokens).collect(),
    )
    timed("predict_batch_nmf", lambda: run(S.predict_batch(docs.select("doc_id", "text"), nmf, vectorizer)))
    spark.catalog.clearCache()

    for name in ("corpus_stopwords", "tfidf_ngram", "doc_vectors", "reconstruction_error", "silhouette", "term_relevance"):
        timed(name, lambda name=name: run(QUERIES[name](spark, SF_DIR)))
        spark.catalog.clearCache()

    print(
        json.dumps(
            {"metric": "total_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds, "sf": os.path.basename(SF_DIR).removeprefix("sf")}
        )
    )


if __name__ == "__main__":
    main()
