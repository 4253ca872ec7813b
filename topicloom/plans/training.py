"""The full batch job: check, preprocess, train both models, evaluate, compare and store the results."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from topicloom.functions.stopwords import merged_stopwords
from topicloom.models.nmf import NmfModel, dominant_topic, fit_nmf, save_nmf
from topicloom.models.online_lda import OnlineLda, fit_online_lda, save_online_lda
from topicloom.models.tuning import grid_search_lda
from topicloom.operators import metrics as M
from topicloom.operators.tfidf import PRESETS, TfidfModel, fit_tfidf, save_tfidf
from topicloom.operators.validate import quality_summary, validated
from topicloom.plans.evaluate import Candidate, compare, model_status
from topicloom.plans.preprocess import fit_preprocess
from topicloom.sources import writers


@dataclass(frozen=True)
class Trained:
    lda: OnlineLda
    nmf: NmfModel
    dictionary: TfidfModel
    vectorizer: TfidfModel
    phrases: list[DataFrame]
    metrics: DataFrame
    winners: DataFrame
    summary: DataFrame
    quality: DataFrame


def train(
    docs: DataFrame,
    path: str | None = None,
    text: str = "text",
    lda_topics: int = 10,
    nmf_topics: int = 10,
    preset: str = "tfidf",
    dictionary_size: int | None = None,
    stopwords: Sequence[str] | None = None,
    allow_duplicates: bool = False,
    lda_options: dict | None = None,
    nmf_options: dict | None = None,
    squared_silhouette: bool = True,
    optimize_counts: Iterable[int] | None = None,
    **preprocessing,
) -> Trained:
    """Train LDA on term counts and NMF on TF-IDF of (doc_id, text) and compare them. The LDA dictionary holds every term of
    the corpus unless ``dictionary_size`` limits it to the most frequent ones. With ``optimize_counts`` (for instance
    ``TOPIC_ONLY_COUNTS``) the number of LDA topics is the one of the best c_v among them. ``doc_id`` has to be unique;
    texts that repeat are rejected unless ``allow_duplicates``. With ``path`` (shared storage) everything is written below it.
    ``preprocessing`` goes to ``fit_preprocess``: ``lexicon``, ``cleaner``, ``splitter``, ``min_count``, ``threshold`` and so on."""
    checked = validated(docs, ["doc_id", text], allow_duplicates, key="doc_id")
    done = fit_preprocess(checked, text=text, stopwords=stopwords, **preprocessing)
    tokens = done.tokens
    words = merged_stopwords() if stopwords is None else list(stopwords)

    dictionary = fit_tfidf(tokens, (1, 1), 1, 1.0, dictionary_size)
    bags = dictionary.bags(tokens).persist()
    options = {"k": lda_topics, **(lda_options or {})}
    if optimize_counts is not None:
        options.pop("k")
        lda = grid_search_lda(tokens, bags, dictionary.vocab, optimize_counts, **options).model
    else:
        lda = fit_online_lda(bags, dictionary.vocab, **options)

    vectorizer = fit_tfidf(tokens, stop_words=words, **PRESETS[preset])
    rows = vectorizer.arrays(tokens, partitioned=True).persist()
    nmf = fit_nmf(rows, vectorizer.vocab, **{"k": nmf_topics, **(nmf_options or {})})

    candidates = {
        "lda": lambda: Candidate("lda", lda.topics(), lda.transform(bags), lda.log_perplexity(bags)),
        "nmf": lambda: Candidate("nmf", nmf.topics(), nmf.transform(rows), None, nmf.reconstruction_error),
    }
    metrics, winners, summary = compare(list(candidates.items()), tokens, squared_silhouette=squared_silhouette)
    quality = quality_summary(docs, done.corpus)
    result = Trained(lda, nmf, dictionary, vectorizer, done.phrases, metrics, winners, summary, quality)
    if path is not None:
        _store(result, done.corpus, dominant_topic(nmf.transform(rows)), checked, path)
    bags.unpersist()
    rows.unpersist()
    return result


def _store(result: Trained, corpus: DataFrame, dominant: DataFrame, docs: DataFrame, path: str) -> None:
    writers.write_corpus(corpus, f"{path}/preprocessed")
    save_online_lda(result.lda, f"{path}/lda_model")
    save_nmf(result.nmf, f"{path}/nmf_model")
    save_tfidf(result.dictionary, f"{path}/dictionary")
    save_tfidf(result.vectorizer, f"{path}/vectorizer")
    for i, phrases in enumerate(result.phrases):
        phrases.write.mode("overwrite").parquet(f"{path}/phrases/pass={i}")
    topics = {"lda": result.lda.topics(), "nmf": result.nmf.topics()}
    for name, table in topics.items():
        writers.write_topics(table, f"{path}/{name}_topics", "csv")
    both = topics["lda"].withColumn("model", F.lit("lda")).unionByName(topics["nmf"].withColumn("model", F.lit("nmf")))
    writers.write_json(writers.evaluation_report(result.metrics, both), f"{path}/evaluation")
    writers.write_json(result.winners, f"{path}/comparison/winners")
    writers.write_json(result.summary, f"{path}/comparison/summary")
    writers.write_json(writers.comparison_counts(model_status(result.metrics)), f"{path}/comparison/counts")
    writers.write_json(M.metric_matrix(result.metrics), f"{path}/comparison/matrix")
    writers.write_json(M.radar_scores(result.metrics), f"{path}/comparison/radar")
    writers.write_documents_with_topics(docs, dominant, f"{path}/documents_with_topics")
