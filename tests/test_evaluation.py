"""Coherence, silhouette, metrics and comparison."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from topicloom.operators import coherence as C
from topicloom.operators import metrics as M
from topicloom.operators import silhouette as H
from topicloom.plans import evaluate as G
from topicloom.sources import writers

TOPICS = "topic_id int, rank int, term string, weight double"


def topics_of(spark, *topics):
    return spark.createDataFrame([(t, i + 1, w, 0.1) for t, words in enumerate(topics) for i, w in enumerate(words)], TOPICS)


def all_windows(docs, size):
    for d in docs:
        if d:
            for start in range(max(1, len(d) - size + 1)):
                yield set(d[start : start + size])


def brute_counts(docs, words, size):
    windows = list(all_windows(docs, size))
    n = {(a, b): sum(a in w and b in w for w in windows) for a in words for b in words}
    return n, len(windows)


def brute_npmi(n, total, a, b):
    if n[a, a] == 0 or n[b, b] == 0:
        return 0.0
    p = n[a, b] / total + C.EPSILON
    return math.log(p / (n[a, a] / total * n[b, b] / total)) / -math.log(p)


@pytest.fixture
def random_docs():
    rng = random.Random(5)
    sizes = [0, 1, 2, 9, 10, 11, 109, 110, 111, 250]
    return [[rng.choice("abcdefghijklmnop") for _ in range(n)] for n in sizes] + [["a"] * 130]


@pytest.mark.parametrize("size", [1, 10, 110, C.WHOLE_DOCUMENT])
def test_window_counts(spark, corpus, random_docs, size):
    topics = topics_of(spark, "abcz", "cd")
    words = "abcdz"
    n, total = brute_counts(random_docs, words, min(size, 10_000))
    docs = corpus(*random_docs)
    assert C.window_total(docs, size).first().total == total
    for r in C.pair_probabilities(docs, topics, size).collect():
        assert (r.n_a, r.n_b, r.n_ab, r.total) == (n[r.a, r.a], n[r.b, r.b], n[r.a, r.b], total)


def test_coherence_measures(spark, corpus, random_docs):
    lists = ["abcz", "cdef"]
    topics, docs = topics_of(spark, *lists), corpus(*random_docs)
    n, total = brute_counts(random_docs, "abcdefz", 110)
    got = {r.topic_id: r.coherence for r in C.coherence_cv(docs, topics).collect()}
    for t, words in enumerate(lists):
        v = np.array([[brute_npmi(n, total, a, b) for b in words] for a in words])
        s = v.sum(axis=0)
        cos = [x @ s / np.linalg.norm(x) / np.linalg.norm(s) if x.any() else 0.0 for x in v]
        assert got[t] == pytest.approx(np.mean(cos), abs=1e-9)
    n, total = brute_counts(random_docs, "abcdefz", 10)
    got = {r.topic_id: r.coherence for r in C.coherence_npmi(docs, topics).collect()}
    for t, words in enumerate(lists):
        pairs = [(a, b) for a in words for b in words if a < b]
        assert got[t] == pytest.approx(np.mean([brute_npmi(n, total, a, b) for a, b in pairs]))
    n, _ = brute_counts(random_docs, "abcdefz", 10_000)
    got = {r.topic_id: r.coherence for r in C.coherence_umass(docs, topics).collect()}
    for t, words in enumerate(lists):
        pairs = [(words[i], words[j]) for i in range(4) for j in range(i) if n[words[j], words[j]]]
        assert got[t] == pytest.approx(np.mean([math.log((n[a, b] + 1) / n[b, b]) for a, b in pairs]))
    mean = C.model_coherence(docs, topics, "c_uci").first().coherence
    assert mean == pytest.approx(C.coherence_uci(docs, topics).agg(F.avg("coherence")).first()[0])


def brute_silhouette(x, labels, power):
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(2)) ** power
    out = []
    for i in range(len(x)):
        own = labels == labels[i]
        if own.sum() == 1:
            out.append(0.0)
            continue
        a = d[i][own].sum() / (own.sum() - 1)
        b = min(d[i][labels == c].mean() for c in set(labels) - {labels[i]})
        out.append((b - a) / max(a, b) if max(a, b) > 0 else 0.0)
    return np.mean(out)


def test_silhouette(spark):
    rng = np.random.default_rng(0)
    labels = np.append(rng.integers(0, 3, 60), 9)  # one singleton
    x = np.round(rng.normal(size=(61, 4)) + labels[:, None], 1)
    x[20:50] = x[20]  # a block of copies
    labels[20:50] = 1
    points = spark.createDataFrame([(r.tolist(), int(c)) for r, c in zip(x, labels)], "vector array<double>, label int")
    for block in (4096, 7):
        assert H.silhouette(points, block).first().silhouette == pytest.approx(brute_silhouette(x, labels, 1), abs=1e-7)
    assert H.silhouette_squared(points).first().silhouette == pytest.approx(brute_silhouette(x, labels, 2), abs=1e-9)
    single = points.filter("label = 1")
    assert H.silhouette(single).first().silhouette is None and H.silhouette_squared(single).first().silhouette is None


def test_diversity_and_intrusion(spark, corpus):
    topics = topics_of(spark, "ab", "bc")
    assert M.topic_diversity(topics).first().diversity == 0.75
    assert M.topic_diversity(topics, 1).first().diversity == 1.0
    assert M.topic_diversity(topics.limit(0)).first().diversity == 0.0
    docs = corpus(["a"] * 300, ["b"] * 20)
    # Topic 0: (300 + 20) / 2 is above 100; topic 1: (20 + 0) / 2.
    assert M.topic_intrusion(docs, topics).first().intrusion == pytest.approx((1.0 + 0.1) / 2)
    assert M.topic_intrusion(docs, topics.limit(0)).first().intrusion == 0.0


# A recorded comparison of two models and the report made of it.
RECORDED = {
    "LDA Model": (0.48594953521328443, 0.79, 0.5269428491592407, -8.204944526018688, 10.0),
    "NMF Model": (0.7348012378434315, 0.925, 0.4202939093321704, None, 8.0),
}
NAMES = ("coherence_score", "topic_diversity", "silhouette_score", "perplexity", "num_topics")
SUMMARY = {
    "topic_diversity": (0.8575, 0.0675, 0.79, 0.925),
    "coherence_score": (0.610375386528358, 0.12442585131507355, 0.48594953521328443, 0.7348012378434315),
    "silhouette_score": (0.4736183792457056, 0.05332446991353515, 0.4202939093321704, 0.5269428491592407),
    "perplexity": (-8.204944526018688, 0.0, -8.204944526018688, -8.204944526018688),
}
WINNERS = {
    "topic_diversity": ("NMF Model", 0.925),
    "coherence_score": ("NMF Model", 0.7348012378434315),
    "silhouette_score": ("LDA Model", 0.5269428491592407),
    "perplexity": ("LDA Model", -8.204944526018688),
}


@pytest.fixture
def recorded(spark):
    rows = [(m, i, n, v, None) for i, (m, vs) in enumerate(RECORDED.items()) for n, v in zip(NAMES, vs)]
    return spark.createDataFrame(rows, G.METRICS)


def test_recorded_report(spark, recorded):
    metrics = recorded.unionByName(G.failed(spark, "broken", 2, "no file"))
    assert {r.metric: (r.model, r.score) for r in M.metric_winners(metrics).collect()} == WINNERS
    for r in M.metric_summary(metrics).collect():
        assert (r["mean"], r["std"], r["min"], r["max"]) == pytest.approx(SUMMARY[r.metric])
    assert tuple(writers.comparison_counts(G.model_status(metrics)).first()) == (3, 2, 1)
    matrix = {r.model: r for r in M.metric_matrix(metrics).collect()}
    assert matrix["NMF Model"].perplexity == 0.0 and matrix["NMF Model"].num_topics == 8.0 and len(matrix) == 2
    radar = {r.model: r for r in M.radar_scores(metrics).collect()}
    assert radar["LDA Model"].perplexity_inverted == 0.0 and radar["LDA Model"].silhouette_score == pytest.approx(0.52694285)


def test_no_values_and_ties(spark):
    rows = [("a", 0, "coherence_score", None, None), ("b", 2, "topic_diversity", 0.5, None), ("c", 1, "topic_diversity", 0.5, None)]
    metrics = spark.createDataFrame(rows, G.METRICS)
    won = {r.metric: (r.model, r.score) for r in M.metric_winners(metrics).collect()}
    assert won["coherence_score"] == ("N/A", 0.0) and won["perplexity"] == ("N/A", 0.0) and won["topic_diversity"] == ("c", 0.5)
    empty = {r.metric: r for r in M.metric_summary(metrics).collect()}["perplexity"]
    assert (empty["mean"], empty["std"], empty["min"], empty["max"]) == (0.0, 0.0, 0.0, 0.0)
    higher = M.metric_winners(spark.createDataFrame([("a", 0, "perplexity", -8.0, None), ("b", 1, "perplexity", -7.0, None)], G.METRICS),
                              lower_is_better=())
    assert {r.metric: r.model for r in higher.collect()}["perplexity"] == "b"


def test_prevalence_and_relevance(spark):
    theta = spark.createDataFrame([(0, 0, 0.25), (0, 1, 0.75), (1, 0, 1.0)], "doc_id bigint, topic_id int, weight double")
    lengths = spark.createDataFrame([(0, 8), (1, 2)], "doc_id bigint, doc_len int")
    assert {r.topic_id: r.prevalence for r in M.topic_prevalence(theta, lengths).collect()} == {0: 0.4, 1: 0.6}
    phi = spark.createDataFrame([(0, "a", 0.9), (0, "b", 0.1), (0, "c", 0.0)], "topic_id int, term string, phi double")
    counts = spark.createDataFrame([("a", 90), ("b", 1), ("c", 9)], "term string, cf bigint")
    ranked = M.term_relevance(phi, counts, lam=0.5, n=2).orderBy("rank").collect()
    assert [r.term for r in ranked] == ["b", "a"]
    assert ranked[0].relevance == pytest.approx(0.5 * math.log(0.1) + 0.5 * math.log(0.1 / 0.01))


def test_compare(spark, corpus):
    docs = corpus(*(["a b c"] * 5 + ["d e f"] * 5))
    weights = spark.createDataFrame([(i, [1.0, 0.0] if i < 5 else [0.0, 1.0]) for i in range(10)], "doc_id bigint, w array<double>")
    good = G.Candidate("good", topics_of(spark, "abc", "def"), weights, reconstruction_error=1.5)

    def hook(topics, doc_topics, tokens):
        return tokens.agg(F.lit("n").alias("metric"), F.count(F.lit(1)).alias("value"))

    metrics, winners, _ = G.compare([("good", lambda: good), ("bad", lambda: 1 / 0)], docs, hooks=[hook], squared_silhouette=False)
    values = {(r.model, r.metric): r.value for r in metrics.collect()}
    assert values["good", "topic_diversity"] == 1.0 and values["good", "silhouette_score"] == pytest.approx(1.0, abs=1e-7)
    assert values["good", "coherence_score"] == pytest.approx(1.0) and values["good", "perplexity"] is None
    assert values["good", "reconstruction_error"] == 1.5 and values["good", "n"] == 10.0 and values["good", "num_topics"] == 2.0
    assert values["bad", "topic_diversity"] == 0.0
    assert {r.model for r in winners.filter("metric = 'topic_diversity'").collect()} == {"good"}
