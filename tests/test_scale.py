"""That work and rows moved follow the input: the steps that a review found to outgrow it."""

import time

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F


def test_a_mini_batch_moves_only_its_words(spark):
    from topicloom.models import online_lda as O

    width = 50_000
    rows = spark.createDataFrame([(1, [7, 40_000], [1.0, 2.0]), (2, [7, 9], [3.0, 1.0])], "doc_id bigint, idx array<int>, val array<double>")
    vocab = spark.range(width).select(F.col("id").alias("term_id"), F.col("id").cast("string").alias("term"))
    params = O.LdaParams(k=3, iterations=2, threshold=0.0)
    lam = np.random.default_rng(4).gamma(100.0, 0.01, (3, width))
    model = O.OnlineLda(params, vocab, np.full(3, 1 / 3), lam.copy(), np.full(width, 1 / 3))
    words = O._words_of(rows)
    assert words.tolist() == [7, 9, 40_000]
    beta = np.exp(O._log_beta(lam))[:, words].T
    assert np.allclose(O._beta_of(model, words), beta)
    stats, log_theta, docs = O._sums_of_batch(rows, words, [(params, model.alpha)], [beta])[0]
    gamma, et, norm = O.infer(np.array([2, 2]), np.array([1.0, 2.0, 3.0, 1.0]), beta[[0, 2, 0, 1]], model.alpha, 2, 0.0)
    expected = np.zeros((3, 3))
    for place, doc, count, n in zip([0, 2, 0, 1], [0, 0, 1, 1], [1.0, 2.0, 3.0, 1.0], norm):
        expected[place] += count / n * et[doc]
    assert docs == 2 and np.allclose(stats, expected) and np.allclose(log_theta, O._log_theta(gamma).sum(axis=0))
    moved = model.update(rows, 0.25, 10)
    whole = np.zeros((3, width))
    whole[:, words] = (expected * beta).T * 5
    after = 0.75 * lam + 0.25 * (1 / 3 + whole)
    assert np.allclose(moved.lam, after) and (model.lam == lam).all()
    logs = O._log_beta(after)
    assert np.allclose(moved.eta, O.newton_step(np.full(width, 1 / 3), logs.mean(axis=0), 3, 0.25))


def test_silhouette_sends_sums_without_vectors(spark, monkeypatch):
    from topicloom.operators import silhouette as H

    rng = np.random.default_rng(1)
    x, label = rng.integers(0, 4, (60, 3)).astype(float), rng.integers(0, 3, 60)
    scored, score = [], H._score
    monkeypatch.setattr(H, "_score", lambda sums, sizes: scored.append(sums.columns) or score(sums, sizes))
    points = spark.createDataFrame([(v.tolist(), int(c)) for v, c in zip(x, label)], "vector array<double>, label int")
    found = [H.silhouette(points, rows).first()[0] for rows in (7, 2048)]
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(axis=2))
    expected = []
    for i, c in enumerate(label):
        a = d[i, label == c].sum() / ((label == c).sum() - 1)
        b = min(d[i, label == o].mean() for o in set(label) - {c})
        expected.append((b - a) / max(a, b) if max(a, b) > 0 else 0.0)
    assert np.allclose(found, np.mean(expected))
    assert not any("vector" in columns for columns in scored)


def test_clean_raw_reads_a_long_word_once(spark):
    from topicloom.functions.text import clean_raw

    texts = ["x" * 300_000 + " a@b c", "@ab d", "e f@", "g@@ h", "@@i j", "k@ l@m n", "see www.x.org http://y o"]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string")
    start = time.time()
    found = [r.c for r in rows.select("i", clean_raw(F.col("text")).alias("c")).orderBy("i").collect()]
    assert time.time() - start < 30
    assert found == ["x" * 300_000 + " c", "ab d", "e f", "h", "j", "k n", "see o"]


def test_phrases_are_looked_up_in_pieces(monkeypatch):
    from topicloom.operators import phrases as P

    monkeypatch.setattr(P, "PIECE", 50)
    sizes, is_phrase = [], P._is_phrase
    monkeypatch.setattr(P, "_is_phrase", lambda table, keys, *a: sizes.append(len(keys[0])) or is_phrase(table, keys, *a))
    rng = np.random.default_rng(2)
    docs = [rng.integers(0, 5, n).tolist() for n in (0, 30, 30, 0, 200, 1, 40, 2, 0)]
    words = pa.array(docs[:3] + [None] + docs[3:], pa.list_(pa.int64()))
    table = [np.sort(P._pair_keys(np.array([1, 3]), np.array([2, 3])))] * 2
    found = P._scan(table).func(words, words).to_pylist()
    for doc, starts in zip(words.to_pylist(), found):
        expected, i = [], 0
        while i + 1 < len(doc or []):
            hit = (doc[i], doc[i + 1]) in {(1, 2), (3, 3)}
            expected += [i] if hit else []
            i += 2 if hit else 1
        assert starts == expected
    assert max(sizes) < 200 and len(sizes) > 3


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_tfidf_is_weighed_inside_the_row(spark, corpus):
    from topicloom.operators import tfidf as I

    docs = corpus("a b a c", "", "b b d", "x", "c a b d")
    model = I.fit_tfidf(docs, (1, 2), 1, 1.0, 6)
    named = model.transform(docs, partitioned=True)
    by_document = "windowspecdefinition(doc_id"
    assert by_document not in _plan(named) and by_document not in _plan(model.arrays(docs, partitioned=True))
    slow = I.weigh(I.doc_term(I.select_grams(docs, (1, 2), ())), model.vocab.select("term", "term_id", "idf"))
    key = lambda df: sorted((r.doc_id, r.term_id, r.term, round(r.w, 12)) for r in df.collect())
    assert key(named) == key(slow.select("doc_id", "term_id", "term", "w"))
    # rows of one doc_id count as one document, as before
    twice = docs.union(docs)
    assert key(model.transform(twice)) == key(slow.select("doc_id", "term_id", "term", "w"))
    assert model.arrays(twice).count() == 10


def test_windows_are_counted_inside_the_row(spark, corpus, monkeypatch):
    from topicloom.operators import coherence as C

    rng = np.random.default_rng(3)
    docs = corpus(*["".join(rng.choice(list("abcdefg"), n)).replace("", " ").split() for n in (0, 1, 5, 40, 90)])
    topics = spark.createDataFrame([(0, "a"), (0, "b"), (0, "zz"), (1, "b"), (1, "c")], "topic_id int, term string")
    pairs = C.topic_pairs(topics)
    words = topics.select(F.col("term").alias("word")).distinct()

    def counts(found):
        return [sorted(map(tuple, C.window_counts(found, pairs, size).collect())) for size in (3, 10, C.WHOLE_DOCUMENT)]

    found = C.occurrences(docs, words)
    assert "Window" not in C.window_counts(found, pairs, 3)._jdf.queryExecution().executedPlan().toString()
    inside = counts(found)
    assert found.count() <= 5
    monkeypatch.setattr(C, "IN_ROW_PAIRS", 0)
    assert inside == counts(found)
    monkeypatch.setattr(C, "IN_ROW_WORDS", 0)
    assert inside == counts(C.occurrences(docs, words))


def test_document_vectors_are_averaged_inside_the_row(spark, corpus):
    from topicloom.operators.embed import mean_word_vectors

    docs = corpus("a b a", "x", "", "b")
    vectors = spark.createDataFrame([("a", [1.0, 2.0]), ("b", [4.0, 8.0])], "word string, vec array<double>")
    found = mean_word_vectors(docs, vectors, 2, partitioned=True)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Aggregate" not in plan and "Join" not in plan
    expected = [[2.0, 4.0], [0.0, 0.0], [0.0, 0.0], [4.0, 8.0]]
    assert [r.vector for r in found.orderBy("doc_id").collect()] == expected
    twice = mean_word_vectors(docs.union(docs), vectors, 2)
    assert [r.vector for r in twice.orderBy("doc_id").collect()] == [v for v in expected for _ in range(2)]


def test_nmf_rows_are_solved_in_blocks_of_bounded_size(monkeypatch):
    from topicloom.models import nmf as N

    rng = np.random.default_rng(4)
    lengths = np.array([0, 3, 40, 1, 3, 0, 200, 41, 7, 2000, 3])
    columns, values, h = rng.integers(0, 50, lengths.sum()), rng.random(lengths.sum()), rng.random((3, 50))
    seen, like_rows = [], N._like_rows
    monkeypatch.setattr(N, "BLOCK", 300)
    monkeypatch.setattr(N, "_like_rows", lambda *a: (seen.append(places.shape) or (rows, places) for rows, places in like_rows(*a)))
    rows = np.repeat(np.arange(len(lengths)), lengths)
    add = lambda x: np.stack([np.bincount(rows, c, len(lengths)) for c in x.T], 1)
    params = N.NmfParams(k=3, beta_loss="kullback-leibler", inner_iter=5, alpha_w=0.1, l1_ratio=0.5)
    mass = h.sum(axis=1)
    expected = add(values[:, None] * h.T[columns]) / (mass * mass.mean() + N.EPSILON)
    for _ in range(5):
        ratio = values / ((expected[rows] * h.T[columns]).sum(axis=1) + N.EPSILON)
        expected *= add(ratio[:, None] * h.T[columns]) / (mass + 0.05 + 0.05 * expected + N.EPSILON)
    w, fitted = N._solve(columns, values, lengths, h, h.T.copy(), params)
    assert np.allclose(w, expected, rtol=1e-12) and np.allclose(fitted, (expected[rows] * h.T[columns]).sum(axis=1), rtol=1e-12)
    assert all(n == 1 or 3 * n * most <= 300 for n, most in seen) and sum(n * most for n, most in seen) < 1.3 * lengths.sum()
    _, products = N._solve(columns, values, lengths, h, h.T.copy(), N.NmfParams(k=3, inner_iter=5))
    assert np.allclose(products, add(values[:, None] * h.T[columns]), rtol=1e-12)


def test_words_for_stopwords_are_told_once(spark, monkeypatch):
    from topicloom.operators import vocab as V

    calls, raw_words = [], V.raw_words
    monkeypatch.setattr(V, "raw_words", lambda *a: calls.append(a) or raw_words(*a))
    texts = [(1, "a a a bb"), (1, "bb cc"), (2, None), (None, "a dd dd"), (3, ""), (4, "É éé a ee")]
    found = V.corpus_stopwords(spark.createDataFrame(texts, "doc_id bigint, text string"), ["dd"], top_n=1, low_n=2, doc_share=0.3)
    # a is the most frequent, bb in two of six texts, ee and éé tie for the lightest with cc behind them
    assert len(calls) == 1
    assert sorted(r.word for r in found.collect()) == ["a", "bb", "cc", "ee"]


def test_rare_pairs_are_not_kept(corpus, monkeypatch):
    from topicloom.operators import phrases as P

    docs = corpus(*["x y"] * 6, "p q r s t u v w", "q p s r u t w v")
    held, persist = [], type(docs).persist
    monkeypatch.setattr(type(docs), "persist", lambda df, *a: held.append(df) or persist(df, *a))
    found = P.learn_phrases(docs, min_count=5, threshold=0.1).collect()
    # ten different words and fifteen different pairs
    assert [(r.w1, r.w2, r.n, round(r.score, 9)) for r in found] == [("x", "y", 6, round(25 / 36, 9))]
    assert [df.count() for df in held if {"w2", "pair"} & set(df.columns)] == [2, 1]


def test_entries_are_added_up_before_they_meet_documents(spark, monkeypatch):
    from topicloom.models import nmf as N

    cells = [(0, "a", 1.0), (0, "b", 2.0), (1, "a", 3.0), (1, "a", 1.0), *[(2, f"z{i}", 1.0) for i in range(16)], (None, "a", 5.0)]
    entries = spark.createDataFrame(cells, "doc_id bigint, term string, w double")
    joined, join = [], type(entries).join
    monkeypatch.setattr(type(entries), "join", lambda df, other, on=None, *a: joined.append((on, df)) or join(df, other, on, *a))
    docs = spark.createDataFrame([(0, 0, 0.5), (0, 1, 1.0), (1, 1, 2.0), (3, 0, 1.0)], "doc_id bigint, topic_id int, weight double")
    topics = spark.createDataFrame([(0, "a", 1.0), (0, "b", 0.5), (1, "a", 0.25), (1, "c", 2.0)], "topic_id int, term string, weight double")
    found = N.reconstruction_error(entries, docs, topics)
    w, h = np.array([[0.5, 1], [0, 2], [1, 0]]), np.array([[1, 0.5, 0], [0.25, 0, 2]])
    fitted = w @ h
    squares = 1 + 4 + 9 + 1 + 16 + 25 - 2 * (fitted[0, 0] + 2 * fitted[0, 1] + 4 * fitted[1, 0]) + (fitted**2).sum()
    assert abs(found.first()[0] - np.sqrt(squares)) < 1e-9
    assert [df.count() for on, df in joined if on == "doc_id"] == [7]  # a row for each document and topic, not for each of the 21 entries


def test_lda_infers_documents_of_like_length_together(monkeypatch):
    """In blocks of bounded size, with the numbers that each document has on its own."""
    from topicloom.models import online_lda as O

    rng = np.random.default_rng(3)
    lengths, alpha = np.array([3, 40, 1, 7, 38, 6, 41]), np.array([0.1, 0.5, 0.2])
    values, eb = rng.integers(1, 5, lengths.sum()).astype(float), rng.gamma(0.5, 1.0, (lengths.sum(), 3))
    blocks, like_rows = [], O._like_rows
    monkeypatch.setattr(O, "CELLS", 250)
    monkeypatch.setattr(O, "_like_rows", lambda *a: (blocks.append(places.shape) or (rows, places) for rows, places in like_rows(*a)))
    gamma, theta, norm = O.infer(lengths, values, eb, alpha, 800, 1e-3)
    assert 1 < len(blocks) < len(lengths) and all(3 * m * n <= 250 for m, n in blocks)
    ends = np.cumsum(lengths)
    for d, (a, b) in enumerate(zip(ends - lengths, ends)):
        g = alpha + values[a:b].sum() / 3
        for _ in range(800):
            t = np.exp([O.digamma(x) - O.digamma(g.sum()) for x in g])
            moved = alpha + t * ((values[a:b] / (eb[a:b] @ t)) @ eb[a:b])
            done, g = np.abs(moved - g).mean() < 1e-3, moved
            if done:
                break
        t = np.exp([O.digamma(x) - O.digamma(g.sum()) for x in g])
        assert np.allclose(gamma[d], g, rtol=1e-9) and np.allclose(theta[d], t, rtol=1e-9) and np.allclose(norm[a:b], eb[a:b] @ t, rtol=1e-9)


def test_bags_of_a_large_vocabulary_move_words_of_blocks(spark, corpus, monkeypatch, capsys):
    """No exchange has documents, tokens or counts as rows; repeated and null ids are counted as before."""
    from topicloom.operators import tfidf as I

    docs = corpus("a b b c", "c d", "", "x a", ["z"], "d d d a").withColumn("tokens", F.when(F.col("doc_id") != 4, F.col("tokens")))
    model = I.fit_tfidf(docs.filter("doc_id < 4"), (1, 1), 1, 1.0, None)
    plain = {r.doc_id: r.features for r in model.bags(docs.filter("doc_id <> 4")).collect()}
    twice = docs.unionByName(docs.filter("doc_id = 0")).unionByName(docs.filter("doc_id = 1").withColumn("doc_id", F.lit(None).cast("bigint")))
    monkeypatch.setattr(I, "BROADCAST_ROW_LIMIT", 2)
    monkeypatch.setattr(I, "BLOCK_TOKENS", 4)
    found = model.bags(docs)
    rows = {r.doc_id: r.features for r in found.collect()}
    assert rows.pop(4).numNonzeros() == 0 and rows == plain
    found.explain()
    moved = [line for line in capsys.readouterr().out.splitlines() if "Exchange" in line]
    assert moved and not any("doc_id" in line for line in moved)
    again = sorted((r.doc_id if r.doc_id is not None else -1, r.features.values.tolist()) for r in model.bags(twice).collect())
    assert again == [(-1, []), (0, [2.0, 4.0, 2.0]), (0, [2.0, 4.0, 2.0]), (1, [1.0, 1.0]), (2, []), (3, [1.0, 1.0]), (4, []), (5, [1.0, 3.0])]
