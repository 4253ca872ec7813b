"""Lexicons, phrases, vocabularies, TF-IDF and vectors."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from topicloom.operators import embed as E
from topicloom.operators import lexicon as X
from topicloom.operators import phrases as P
from topicloom.operators import tfidf as I
from topicloom.operators import vocab as V
from topicloom.plans.preprocess import preprocess, preprocess_new, tokenize
from topicloom.runtime import DataValidationError, row_count


def tokens_of(df):
    return {r.doc_id: r.tokens for r in df.collect()}


def scan(tokens, pairs):
    out, i = [], 0
    while i < len(tokens):
        if i + 1 < len(tokens) and (tokens[i], tokens[i + 1]) in pairs:
            out.append(tokens[i] + "_" + tokens[i + 1])
            i += 2
        else:
            out.append(tokens[i])
            i += 1
    return out


@pytest.mark.parametrize("limit", [P.BROADCAST_ROW_LIMIT, 0])
def test_merge_equals_a_left_to_right_scan(spark, corpus, monkeypatch, limit):
    monkeypatch.setattr(P, "BROADCAST_ROW_LIMIT", limit)
    rng = random.Random(1)
    docs = [[rng.choice("abc") for _ in range(rng.randrange(0, 25))] for _ in range(300)] + [list("aaaa"), list("abc"), []]
    pairs = {("a", "a"), ("a", "b"), ("b", "c")}
    phrases = spark.createDataFrame(sorted(pairs), "w1 string, w2 string")
    merged = tokens_of(P.apply_phrases(corpus(*docs), phrases))
    assert merged == {i: scan(d, pairs) for i, d in enumerate(docs)}


def test_phrases_of_odd_rows(spark):
    rows = [(0, None, 1), (1, ["a", "b"], 2), (1, ["a", "b"], 2), (None, ["b", None, "a", "b"], 3), (2, [], 4)]
    docs = spark.createDataFrame(rows, "doc_id bigint, tokens array<string>, w1 int")
    phrases = spark.createDataFrame([("a", "b"), (None, "b"), ("b", None), ("a", "b")], "w1 string, w2 string")
    merged = [(r.doc_id, r.tokens, r.w1) for r in P.apply_phrases(docs, phrases).collect()]
    wanted = [(0, None, 1), (1, ["a_b"], 2), (1, ["a_b"], 2), (None, ["b", None, "a_b"], 3), (2, [], 4)]
    assert sorted(merged, key=lambda r: r[2]) == sorted(wanted, key=lambda r: r[2])
    assert P.apply_phrases(docs, phrases.limit(0)).filter("w1 = 2").first().tokens == ["a", "b"]
    assert P.apply_phrases(docs.limit(0), phrases).count() == 0


def test_phrases_that_agree_in_one_hash():
    table = [np.array([3, 3, 9], np.uint64), np.array([1, 5, 2], np.uint64)]
    keys = [np.array([3, 3, 3, 9, 9, 10], np.uint64), np.array([5, 1, 2, 2, 1, 2], np.uint64)]
    assert P._is_phrase(table, keys).tolist() == [True, True, False, True, False, False]


def test_learn_phrases(corpus):
    docs = [["new", "york"]] * 8 + [["w%d" % i, "v%d" % i] for i in range(200)] + [["new"], []]
    found = P.learn_phrases(corpus(*docs), min_count=5, threshold=1.0).collect()
    v = (2 + 400) + (1 + 200)
    assert [(r.w1, r.w2, r.n) for r in found] == [("new", "york", 8)]
    assert found[0].score == pytest.approx((8 - 5) * v / (9 * 8))


def test_second_pass_can_join_two_bigrams(corpus):
    docs = corpus(*([["a", "b", "c", "d"]] * 10))
    merged, tables = P.build_ngrams(docs, min_count=1, threshold=0.1)
    assert len(tables) == 2
    assert set(map(tuple, tokens_of(merged).values())) == {("a_b_c_d",)}
    only, tables = P.build_ngrams(docs, bigrams=False, min_count=1, threshold=0.1)
    assert len(tables) == 1 and set(map(tuple, tokens_of(only).values())) == {("a_b", "c_d")}


def test_lexicons(spark, corpus):
    docs = corpus("cats the run", [], "running")
    lexicon = spark.createDataFrame([("cats", "CAT"), ("running", "the")], "surface string, lemma string")
    rows = X.token_rows(docs)
    assert tokens_of(X.collect_tokens(X.lemmatize(rows, lexicon))) == {0: ["cat", "the", "run"], 1: [], 2: ["the"]}
    classes = spark.createDataFrame([("cats", "NOUN"), ("running", "VERB"), ("the", "DET")], "surface string, pos string")
    kept = X.lemmas_by_class(rows, classes, lexicon, ["the"])
    assert [(r.doc_id, r.token) for r in kept.collect()] == [(0, "cat")]


def test_tokenize_tests_the_surface(spark):
    docs = spark.createDataFrame([(0, "Running the cats"), (1, None)], "doc_id bigint, text string")
    lexicon = spark.createDataFrame([("running", "the")], "surface string, lemma string")
    assert tokens_of(tokenize(docs, stopwords=["the"], lexicon=lexicon)) == {0: ["the", "cats"], 1: []}


def test_preprocess(spark):
    docs = spark.createDataFrame([(i, "High definition <b>TV</b> it's") for i in range(10)], "doc_id bigint, text string")
    rows = preprocess(docs, min_count=1, threshold=0.01).collect()
    assert len(rows) == 10 and rows[0].tokens == ["high_definition_tv"] and rows[0].cleaned_text == "high_definition_tv"
    tables = [spark.createDataFrame([("high", "definition")], "w1 string, w2 string")]
    new = spark.createDataFrame([(7, "a high definition show")], "doc_id bigint, text string")
    assert tokens_of(preprocess_new(new, tables)) == {7: ["high_definition", "show"]}


def test_term_counts(corpus):
    docs = corpus("a b a", "a c", [])
    assert {(r.term, r.df, r.cf) for r in V.term_stats(docs).collect()} == {("a", 2, 3), ("b", 1, 1), ("c", 1, 1)}
    assert [(r.term, r.cf) for r in V.top_terms(docs, 2).collect()] == [("a", 3), ("b", 1)]
    assert {(r.term, r.df) for r in V.document_frequency(docs).collect()} == {("a", 2), ("b", 1), ("c", 1)}
    kept = V.filter_extremes(V.term_stats(docs), row_count(docs), no_below=1, no_above=0.5)
    assert {r.term for r in kept.collect()} == {"b", "c"}


def test_term_ids_are_dense_and_sorted(spark):
    rng = random.Random(3)
    words = sorted({"".join(rng.choice("abé") for _ in range(rng.randrange(1, 8))) for _ in range(2000)})
    terms = spark.createDataFrame([(w,) for w in words], "term string").repartition(5)
    for cap in (None, 10_000):
        ids = {r.term: r.term_id for r in V.with_term_ids(terms, cap).collect()}
        assert ids == {w: i for i, w in enumerate(sorted(words, key=lambda w: w.encode()))}


def test_bag_of_words_drops_unknown_terms(corpus):
    vocab = V.dictionary(corpus("a b"))
    assert sorted(map(tuple, V.bag_of_words(corpus("b x b", "y"), vocab).collect())) == [(0, 1, 2)]


def brute_tfidf(docs, n_vocab=None):
    n = len(docs)
    df = {t: sum(t in d for d in docs) for d in docs for t in d}
    out = {}
    for i, d in enumerate(docs):
        w = {t: d.count(t) * (math.log((1 + n) / (1 + df[t])) + 1) for t in d}
        norm = math.sqrt(sum(x * x for x in w.values()))
        out.update({(i, t): x / norm for t, x in w.items()})
    return out


def test_tfidf_micro(corpus):
    docs = [["all", "x", "x"], ["all", "y"], ["all", "y", "z"], []]
    model = I.fit_tfidf(corpus(*docs), (1, 1), 1, 1.0, None)
    got = {(r.doc_id, r.term): r.w for r in model.transform(corpus(*docs)).collect()}
    want = brute_tfidf(docs)
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k]) for k in want)
    rows = {r.doc_id: r for r in model.arrays(corpus(*docs)).collect()}
    assert rows[3].idx == [] and rows[3].val == []
    assert [r.term for r in model.feature_names().collect()] == ["all", "x", "y", "z"]
    assert rows[0].idx == [0, 1]
    mean = {r.term: r.mean_tfidf for r in I.mean_tfidf(model.transform(corpus(*docs)), row_count(corpus(*docs))).collect()}
    assert mean["x"] == pytest.approx(want[(0, "x")] / 4)


def test_large_vocabulary_is_joined_the_same(corpus, monkeypatch):
    docs = corpus("a b a", "b c", "c c d")
    model = I.fit_tfidf(docs, (1, 2), 1, 1.0, None)
    small = sorted(map(tuple, model.transform(docs).collect()))
    monkeypatch.setattr("topicloom.runtime.is_small", lambda *_: False)
    assert sorted(map(tuple, model.transform(docs).collect())) == small


def test_pruning(corpus):
    docs = corpus("a b c", "a b", "a d", "a d e")
    terms = lambda **o: [r.term for r in I.fit_tfidf(docs, **o).feature_names().collect()]
    assert terms(ngram_range=(1, 1), min_df=2, max_df=0.9) == ["b", "d"]
    assert terms(ngram_range=(1, 1), min_df=2, max_df=2) == ["b", "d"]
    assert terms(ngram_range=(1, 1), min_df=1, max_df=1.0, max_features=2) == ["a", "b"]
    assert terms(ngram_range=(1, 2), min_df=2, max_df=1.0, stop_words=["b"]) == ["a", "a d", "d"]
    with pytest.raises(DataValidationError):
        I.fit_tfidf(docs.limit(0))


def test_corpus_stopwords(spark):
    texts = spark.createDataFrame([(i, f"the word{i} common x") for i in range(10)], "doc_id bigint, text string")
    found = {r.word for r in V.corpus_stopwords(texts, ["the"], top_n=1, low_n=1).collect()}
    # common is the first of three most frequent words and in over 60 % of the texts, word0 the first of the lightest.
    assert found == {"common", "word0"}


def test_mean_vectors(spark, corpus):
    vectors = spark.createDataFrame([("a", [1.0, 0.0]), ("b", [0.0, 4.0])], "word string, vec array<float>")
    rows = {r.doc_id: r.vector for r in E.mean_word_vectors(corpus("a b b x", "x", []), vectors, 2).collect()}
    assert rows[0] == pytest.approx([1 / 3, 8 / 3]) and rows[1] == [0.0, 0.0] and rows[2] == [0.0, 0.0]


def test_batch_vectors(spark):
    docs = spark.createDataFrame([(0, "abc"), (1, "  "), (2, None)], "doc_id bigint, text string")

    def load():
        return lambda texts: [[float(len(t)), 1.0] for t in texts]

    rows = {r.doc_id: r.vector for r in E.batch_vectors(docs, load, 2).collect()}
    assert rows == {0: [3.0, 1.0], 1: [0.0, 0.0], 2: [0.0, 0.0]}


def test_one_token_may_hold_a_third_of_all_rows(spark, corpus):
    docs = [["hot"] * 50 + [f"w{i}", f"w{i % 7}"] for i in range(200)]
    model = I.fit_tfidf(corpus(*docs), (1, 1), 1, 1.0, None)
    want = brute_tfidf(docs)
    got = {(r.doc_id, r.term): r.w for r in model.transform(corpus(*docs)).collect()}
    assert got.keys() == want.keys() and max(abs(got[k] - want[k]) for k in want) < 1e-12
    found = P.learn_phrases(corpus(*docs), min_count=0, threshold=0.0)
    assert found.filter(F.col("w1") == "hot").agg(F.sum("n")).first()[0] == sum(
        a == "hot" for d in docs for a, _ in zip(d, d[1:])
    )
