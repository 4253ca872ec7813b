"""Shapes of physical plans, and the whole training job."""

import os

import pytest
from pyspark.sql import functions as F

from topicloom.functions.text import clean_light
from topicloom.functions.tokens import split_words
from topicloom.models.scoring import predict
from topicloom.operators import relational as R
from topicloom.operators import vocab as V
from topicloom.operators.coherence import occurrences, topic_pairs, window_counts
from topicloom.operators.phrases import apply_phrases
from topicloom.operators.tfidf import fit_tfidf, load_tfidf
from topicloom.plans.preprocess import fit_preprocess, tokenize
from topicloom.plans.training import train

SF = "/root/testdata/sf0.001"
needs_data = pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")


def plan(df):
    text = df._jdf.queryExecution().executedPlan().toString()
    return "\n".join(line for line in text.splitlines() if "InMemoryRelation" not in line)


def own_exchanges(df):
    """Hash exchanges of a plan above its cached inputs."""
    lines, depth, count = df._jdf.queryExecution().executedPlan().toString().splitlines(), None, 0
    for line in lines:
        indent = len(line) - len(line.lstrip(" :+-*()0123456789"))
        if depth is not None and indent > depth:
            continue
        depth = indent if "InMemoryRelation" in line else None
        count += "Exchange hashpartitioning" in line
    return count


@pytest.fixture
def placed(spark):
    docs = spark.createDataFrame([(i, "new york and new jersey " * 3) for i in range(40)], "doc_id bigint, text string")
    cached = tokenize(docs).persist()
    cached.count()
    return cached


def test_a_hashed_corpus_is_not_shuffled_again(spark, placed):
    loose = spark.createDataFrame([(0, ["a"])], "doc_id bigint, tokens array<string>")
    assert own_exchanges(V.doc_term(loose)) == 1
    assert own_exchanges(V.doc_term(placed)) == 0  # Spark sees that hashing it again is not needed
    assert own_exchanges(V.doc_term(placed, partitioned=True)) == 0
    model = fit_tfidf(placed, (1, 2), 1, 1.0, 100)
    assert own_exchanges(model.transform(placed, partitioned=True)) == 0
    assert own_exchanges(model.arrays(placed, partitioned=True)) == 0
    phrases = spark.createDataFrame([("york", "jersey")], "w1 string, w2 string")
    merging = plan(apply_phrases(spark.createDataFrame([(0, ["a", "b"])], "doc_id bigint, tokens array<string>"), phrases))
    assert "Exchange" not in merging and "Join" not in merging and "Window" not in merging and "Aggregate" not in merging
    topics = spark.createDataFrame([(0, 1, "york", 1.0), (0, 2, "jersey", 1.0)], "topic_id int, rank int, term string, weight double")
    pairs = topic_pairs(topics).persist()
    found = occurrences(placed, topics.select(F.col("term").alias("word")))
    assert own_exchanges(window_counts(found, pairs, 110)) == 1  # the summed counts


@needs_data
def test_scans_are_pruned_and_filtered(spark):
    text = plan(tokenize(spark.read.parquet(f"{SF}/documents.parquet")))
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in text
    kept, _ = R.filter_equal(spark.read.parquet(f"{SF}/events.parquet"), "event_type", "click")
    assert "EqualNullSafe(event_type,click)" in plan(kept.select("event_id"))


def test_counts_are_combined_before_the_shuffle(placed):
    text = plan(V.term_stats(placed))
    assert "partial_count" in text and text.index("partial_count") > text.index("Exchange hashpartitioning(term")


def test_top_k_is_cut_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 2).alias("k"), F.col("id").alias("v"))
    assert "WindowGroupLimit" in plan(R.top_per_group(df, ["k"], 5, F.col("v").desc()))


def test_cleaner_and_splitter_are_pluggable(spark):
    docs = spark.createDataFrame([(0, "It's ONE-two")], "doc_id bigint, text string")
    assert tokenize(docs, stopwords=[], min_length=1, cleaner=clean_light).first().tokens == ["it", "s", "one", "two"]
    assert tokenize(docs, stopwords=[], min_length=1, cleaner=lambda c: c, splitter=split_words).first().tokens == ["It's", "ONE-two"]


def test_texts_are_not_shuffled(spark):
    docs = spark.createDataFrame([(i, "New York is a new town " * 3) for i in range(20)], "doc_id bigint, text string")
    done = fit_preprocess(docs, min_count=1, threshold=0.001, cleaner=clean_light)
    assert "Exchange" not in plan(done.corpus) and "Join" not in plan(done.corpus)
    assert done.tokens.count() == 20 and own_exchanges(V.doc_term(done.tokens)) == 0
    row = done.corpus.first()
    assert row.text.startswith("New York") and row.cleaned_text == " ".join(row.tokens) and "_" in row.cleaned_text


def test_training_job(spark, tmp_path):
    fruit, cars = "apple pear plum fig melon", "car bus train tram lorry"
    docs = spark.createDataFrame(
        [(i, f"{' '.join((fruit if i % 2 else cars).split()[i % 5:])} {fruit if i % 2 else cars} w{i}") for i in range(60)], "doc_id bigint, text string"
    )
    path = str(tmp_path / "out")
    done = train(docs, path, lda_topics=2, nmf_topics=2, lda_options={"passes": 5}, nmf_options={"max_iter": 10})
    values = {(r.model, r.metric): r.value for r in done.metrics.collect()}
    assert values["nmf", "num_topics"] == 2 and values["nmf", "reconstruction_error"] > 0 and values["lda", "perplexity"] < 0
    assert {r.metric: r.model for r in done.winners.collect()}["perplexity"] == "lda"
    assert {r.side: (r.n_rows, r.n_nulls) for r in done.quality.collect()} == {"raw": (60, 0), "preprocessed": (60, 0)}
    stored = spark.read.parquet(f"{path}/documents_with_topics")
    groups = stored.groupBy((F.col("doc_id") % 2).alias("g")).agg(F.count_distinct("dominant_topic").alias("n")).collect()
    assert {r.n for r in groups} == {1}
    report = spark.read.json(f"{path}/evaluation")
    assert {r.model for r in report.collect()} == {"lda", "nmf"}
    assert spark.read.json(f"{path}/comparison/counts").first().successful_evaluations == 2
    again = load_tfidf(spark, f"{path}/vectorizer")
    assert again.ngram_range == (1, 1) and again.vocab.count() == done.vectorizer.vocab.count()
    unseen = spark.createDataFrame([(0, "a pear and a plum"), (1, "bus")], "doc_id bigint, text string")
    by_doc = {r.doc_id: r.dominant_topic for r in predict(unseen, done.nmf, again).collect()}
    assert by_doc[0] != by_doc[1]
