"""NMF, LDA, scoring and tuning."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from topicloom.models import lda as L
from topicloom.models import nmf as N
from topicloom.models import online_lda as O
from topicloom.models import scoring as S
from topicloom.models import tuning as U
from topicloom.operators import tfidf as I
from topicloom.runtime import DataValidationError

ROWS = "doc_id bigint, idx array<int>, val array<double>"


def sparse(spark, x, partitions=4):
    rows = [(i, np.flatnonzero(r).tolist(), r[np.flatnonzero(r)].tolist()) for i, r in enumerate(x)]
    return spark.createDataFrame(rows, ROWS).repartition(partitions)


def vocab(spark, n):
    return spark.createDataFrame([(i, f"t{i:03d}") for i in range(n)], "term_id bigint, term string")


@pytest.fixture
def planted():
    rng = np.random.default_rng(2)
    w = rng.random((60, 2)) * (rng.random((60, 2)) < 0.6)
    h = rng.random((2, 30)) * (rng.random((2, 30)) < 0.5)
    return w @ h


def weights(model, rows):
    return np.array([r.w for r in model.transform(rows).orderBy("doc_id").collect()])


def test_nmf_recovers_a_planted_product(spark, planted):
    rows = sparse(spark, planted)
    model = N.fit_nmf(rows, vocab(spark, 30), k=2, max_iter=60, tol=1e-9, inner_iter=100)
    losses = np.array(model.losses)
    assert (np.diff(losses) <= 1e-9 * losses[0]).all()
    assert model.reconstruction_error < 0.02 * np.linalg.norm(planted)
    w = weights(model, rows)
    assert (w >= 0).all() and (model.h >= 0).all()
    assert np.linalg.norm(planted - w @ model.h) == pytest.approx(model.reconstruction_error, abs=1e-6)


def test_nmf_does_not_depend_on_partitions(spark, planted):
    fits = [N.fit_nmf(sparse(spark, planted, p), vocab(spark, 30), k=3, max_iter=8, tol=0.0) for p in (1, 8)]
    assert np.allclose(fits[0].h, fits[1].h, rtol=1e-8, atol=1e-10)


def test_nmf_works_in_small_pieces(spark, planted, monkeypatch):
    whole = N.fit_nmf(sparse(spark, planted), vocab(spark, 30), k=2, max_iter=5)
    monkeypatch.setattr(N, "PIECE", 20)
    cut = N.fit_nmf(sparse(spark, planted), vocab(spark, 30), k=2, max_iter=5)
    assert np.allclose(whole.h, cut.h)
    assert np.allclose(weights(whole, sparse(spark, planted)), weights(cut, sparse(spark, planted)))


@pytest.mark.parametrize("loss", ["frobenius", "kullback-leibler"])
def test_nmf_by_term_ranges_is_the_same(spark, tmp_path, planted, monkeypatch, loss):
    """H beyond the limit stays a table of ranges: same losses, weights and files, slices of a few entries."""
    from topicloom.models import ranges

    monkeypatch.setattr(ranges, "width_of", lambda k: 7)
    monkeypatch.setattr(N, "width_of", lambda k: 7)
    monkeypatch.setattr(N, "PIECE", 60)
    x = np.vstack([planted, np.zeros(30)])
    rows = sparse(spark, x)
    options = dict(k=3, max_iter=4, tol=0.0, beta_loss=loss, alpha_w=0.01, alpha_h=0.02, l1_ratio=0.5, inner_iter=8)
    dense = N.fit_nmf(rows, vocab(spark, 30), **options)
    monkeypatch.setattr(N, "FACTOR_CELL_LIMIT", 10)
    ranged = N.fit_nmf(rows, vocab(spark, 30), **options)
    assert ranged.h is None and ranged.table.count() == 5
    assert ranged.losses == pytest.approx(dense.losses, rel=1e-9)
    assert ranged.reconstruction_error == pytest.approx(dense.reconstruction_error, rel=1e-9)
    assert np.allclose(weights(ranged, rows), weights(dense, rows), rtol=1e-8, atol=1e-12)
    terms = {(r.topic_id, r.term_id): r.weight for r in ranged.topic_terms().collect()}
    assert len(terms) == 90 and all(terms[t, c] == pytest.approx(dense.h[t, c], rel=1e-8, abs=1e-14) for t, c in terms)
    N.save_nmf(ranged, str(tmp_path / "m"))
    again = N.load_nmf(spark, str(tmp_path / "m"))
    assert again.h is None and np.allclose(weights(again, rows), weights(dense, rows), rtol=1e-8, atol=1e-12)


def test_nmf_models_share_passes(spark, planted, monkeypatch):
    """Models fitted together are those fitted alone, in as many passes as the longest needs; no cache stays."""
    rows = sparse(spark, planted)
    settings = [N.NmfParams(k=2, max_iter=3), N.NmfParams(k=3, max_iter=6, tol=0.0), N.NmfParams(k=2, max_iter=50, beta_loss="kullback-leibler", tol=0.01)]
    alone = [N.fit_nmf(rows, vocab(spark, 30), p) for p in settings]
    calls, passes = [], N._passes
    monkeypatch.setattr(N, "_passes", lambda rows, factors, params: calls.append(len(factors)) or passes(rows, factors, params))
    before = spark.sparkContext._jsc.getPersistentRDDs().size()
    together = N.fit_models(rows, vocab(spark, 30), settings)
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == before
    needed = [len(m.losses) + (len(m.losses) == p.max_iter) for m, p in zip(alone, settings)]
    assert len(calls) == max(needed) and sum(calls) == sum(needed)
    for a, b in zip(alone, together):
        assert b.losses == pytest.approx(a.losses, rel=1e-12) and np.allclose(a.h, b.h, rtol=1e-9) and b.reconstruction_error == pytest.approx(a.reconstruction_error)
    monkeypatch.setattr(N, "FACTOR_CELL_LIMIT", 100)
    calls.clear()
    N.fit_models(rows, vocab(spark, 30), settings[:2])
    assert set(calls) == {1}  # 60 and 90 cells do not fit together


def test_nmf_kullback_leibler(spark, planted):
    rows = sparse(spark, planted)
    model = N.fit_nmf(rows, vocab(spark, 30), k=2, max_iter=40, tol=0.0, beta_loss="kullback-leibler", inner_iter=60)
    assert model.losses[-1] < model.losses[0] and (np.diff(model.losses) <= 1e-6 * abs(model.losses[0])).all()
    w = weights(model, rows)
    x, y = planted, w @ model.h + 1e-12
    loss = np.where(x > 0, x * np.log(np.maximum(x, 1e-300) / y), 0) - x + y
    assert np.sqrt(2 * max(loss.sum(), 0)) == pytest.approx(model.reconstruction_error, abs=1e-3)


def test_nmf_penalties_shrink_the_factors(spark, planted):
    rows = sparse(spark, planted)
    plain = N.fit_nmf(rows, vocab(spark, 30), k=2, max_iter=15)
    lasso = N.fit_nmf(rows, vocab(spark, 30), k=2, max_iter=15, alpha_w=0.1, alpha_h=0.1, l1_ratio=0.5)
    assert weights(lasso, rows).sum() * lasso.h.sum() < weights(plain, rows).sum() * plain.h.sum()


def test_nmf_guards(spark):
    with pytest.raises(DataValidationError, match="empty"):
        N.fit_nmf(spark.createDataFrame([], ROWS), vocab(spark, 3), k=2)
    with pytest.raises(DataValidationError, match="zeros"):
        N.fit_nmf(spark.createDataFrame([(0, [], [])], ROWS), vocab(spark, 3), k=2)


def test_nmf_tables(spark, tmp_path, planted):
    rows = sparse(spark, np.vstack([planted, np.zeros(30)]))
    model = N.fit_nmf(rows, vocab(spark, 30), k=2, max_iter=5)
    last = model.document_topics(rows).filter("doc_id = 60").first()
    assert (last.dominant_topic, last.dominant_probability, last.topic_distribution) == (0, 0.0, [0.0, 0.0])
    top = model.topics(3).filter("topic_id = 1").orderBy("rank").collect()
    order = np.argsort(-model.h[1], kind="stable")[:3]
    assert [r.term for r in top] == [f"t{i:03d}" for i in order]
    N.save_nmf(model, str(tmp_path / "m"))
    again = N.load_nmf(spark, str(tmp_path / "m"))
    assert again.params == model.params and (again.h == model.h).all() and again.losses == model.losses


def test_topic_of_zeros_lists_the_first_terms(spark):
    terms = spark.createDataFrame([(0, f"t{i}", 0.0) for i in (2, 0, 1)], "topic_id int, term string, weight double")
    assert [(r.term, r.weight) for r in N.top_terms_per_topic(terms, 2).orderBy("rank").collect()] == [("t0", 0.0), ("t1", 0.0)]


def test_document_topics_and_ties(spark):
    rows = spark.createDataFrame([(0, [1.0, 3.0]), (1, [2.0, 2.0])], "doc_id bigint, w array<double>")
    got = {r.doc_id: (r.dominant_topic, r.dominant_probability, r.topic_distribution) for r in N.document_topics(rows).collect()}
    assert got == {0: (1, 0.75, [0.25, 0.75]), 1: (0, 0.5, [0.5, 0.5])}
    assert {r.doc_id: r.dominant_topic for r in N.dominant_topic(rows).collect()} == {0: 1, 1: 0}


def test_reconstruction_error(spark):
    rng = np.random.default_rng(4)
    x, w, h = (rng.random(s) * (rng.random(s) < 0.6) for s in ((6, 5), (6, 2), (2, 5)))
    long = lambda m, a, b, c: spark.createDataFrame(
        [(i, j, float(m[i, j])) for i in range(m.shape[0]) for j in range(m.shape[1]) if m[i, j]], f"{a} bigint, {b} bigint, {c} double"
    )
    got = N.reconstruction_error(long(x, "doc_id", "term", "w"), long(w, "doc_id", "topic_id", "weight"), long(h, "topic_id", "term", "weight"))
    assert got.first().reconstruction_error == pytest.approx(np.linalg.norm(x - w @ h))


@pytest.fixture
def two_topics(corpus):
    rng = np.random.default_rng(0)
    a, b = ["apple", "pear", "plum", "fig"], ["car", "bus", "train", "tram"]
    docs = [list(rng.choice(a if i % 2 else b, 30)) for i in range(60)] + [[]]
    return corpus(*[[str(t) for t in d] for d in docs])


@pytest.fixture
def fruit_model(two_topics):
    vectorizer = I.fit_tfidf(two_topics, (1, 1), 1, 1.0, None)
    return two_topics, vectorizer, N.fit_nmf(vectorizer.arrays(two_topics), vectorizer.vocab, k=2, max_iter=20)


def test_lda(spark, tmp_path, two_topics):
    vectorizer = I.fit_tfidf(two_topics, (1, 1), 1, 1.0, None)
    bags = vectorizer.bags(two_topics)
    fitted = L.fit_lda(bags, vectorizer.vocab, k=2, passes=20, chunk_size=20)
    theta = {r.doc_id: r.w for r in fitted.transform(bags).collect()}
    assert all(sum(w) == pytest.approx(1) for i, w in theta.items() if i != 60) and sum(theta[60]) == 0
    top = {r.doc_id: r.dominant_topic for r in L.dominant_topics(fitted.transform(bags)).collect()}
    assert top.pop(60) == -1
    assert len({t for i, t in top.items() if i % 2}) == 1 and len({t for i, t in top.items() if not i % 2}) == 1
    assert fitted.log_perplexity(bags) == pytest.approx(-fitted.model.logPerplexity(bags), rel=1e-3) and fitted.log_perplexity(bags) < 0
    words = {t: {r.term for r in fitted.topics(4).filter(f"topic_id = {t}").collect()} for t in (0, 1)}
    assert {"apple", "pear", "plum", "fig"} in words.values()
    assert [r.rank for r in fitted.topics(4).filter("topic_id = 0").orderBy("rank").collect()] == [1, 2, 3, 4]
    L.save_lda(fitted, str(tmp_path / "lda"))
    again = L.load_lda(spark, str(tmp_path / "lda"))
    assert {r.doc_id: r.w for r in again.transform(bags).collect()}[0] == pytest.approx(theta[0])


def by_hand(docs, k, width, passes, alpha, eta, lam, iterations, decay=0.5, offset=10.0, learn=True):
    """Online variational Bayes over one batch, word by word."""
    def psi(x):
        return float(O._digamma_by_series(np.array(float(x))))

    for t in range(passes):
        rate = (offset + 2 * t) ** -decay
        log_beta = np.array([[psi(lam[a, v]) - psi(lam[a].sum()) for v in range(width)] for a in range(k)])
        stats, logs = np.zeros((k, width)), np.zeros(k)
        for counts in docs:
            gamma = np.array([a + sum(counts.values()) / k for a in alpha])
            for _ in range(iterations):
                theta = np.exp([psi(g) - psi(gamma.sum()) for g in gamma])
                phi = {v: theta * np.exp(log_beta[:, v]) / (theta * np.exp(log_beta[:, v])).sum() for v in counts}
                gamma = alpha + sum(n * phi[v] for v, n in counts.items())
            log_theta = np.array([psi(g) - psi(gamma.sum()) for g in gamma])
            theta = np.exp(log_theta)
            for v, n in counts.items():
                stats[:, v] += n * theta * np.exp(log_beta[:, v]) / (theta * np.exp(log_beta[:, v])).sum()
            logs += log_theta
        if learn:
            alpha = O.newton_step(alpha, logs / len(docs), len(docs), rate)
        lam = (1 - rate) * lam + rate * (eta + stats)
        if learn:
            means = np.array([np.mean([psi(lam[a, v]) - psi(lam[a].sum()) for a in range(k)]) for v in range(width)])
            eta = O.newton_step(eta, means, k, rate)
    return alpha, eta, lam


@pytest.fixture
def small_bags(spark):
    rng = np.random.default_rng(5)
    docs = [{int(v): int(n) for v, n in zip(rng.choice(9, 4, replace=False), rng.integers(1, 5, 4))} for _ in range(7)]
    rows = [(i, sorted(d), [float(d[v]) for v in sorted(d)]) for i, d in enumerate(docs)] + [(7, [], [])]
    return docs, spark.createDataFrame(rows, ROWS).repartition(3)


def test_online_lda_step_by_step(spark, small_bags):
    """Three passes with a fixed number of inner iterations, beside plain loops; both priors move."""
    docs, rows = small_bags
    p = O.LdaParams(k=3, passes=3, iterations=4, threshold=0.0)
    fitted = O.fit_online_lda(rows, vocab(spark, 9), p)
    alpha, eta, lam = by_hand(docs, 3, 9, 3, np.full(3, 1 / 3), np.full(9, 1 / 3), O._first_weights(p, 0, 9), 4)
    assert np.allclose(fitted.lam, lam, rtol=1e-9) and np.allclose(fitted.alpha, alpha, rtol=1e-9) and np.allclose(fitted.eta, eta, rtol=1e-9)
    assert not np.allclose(eta, 1 / 3) and not np.allclose(alpha, 1 / 3)


@pytest.mark.parametrize("x", [1e-4, 0.03, 0.5, 1.0, 7.5, 300.0])
def test_special_functions(x):
    import math

    step = 1e-4 * x
    assert O.trigamma(np.array(x)) == pytest.approx((O.digamma(np.array(x + step)) - O.digamma(np.array(x - step))) / (2 * step), rel=1e-6)
    assert O.digamma(np.array(x)) == pytest.approx((math.lgamma(x + step) - math.lgamma(x - step)) / (2 * step), rel=1e-5, abs=1e-6)
    many = np.full((5, 1 << 14), x)
    assert np.allclose(O.digamma(many), O.digamma(np.array(x)), rtol=1e-12)


def test_newton_step_finds_a_dirichlet():
    rng = np.random.default_rng(1)
    true = np.array([0.3, 2.0, 0.9])
    logs = np.log(rng.dirichlet(true, 20_000)).mean(axis=0)
    prior = np.ones(3)
    for _ in range(100):
        prior = O.newton_step(prior, logs, 20_000, 0.5)
    assert prior == pytest.approx(true, rel=0.05)
    assert (O.newton_step(np.array([1e-3, 1.0]), np.array([-1e6, 0.0]), 10, 1.0) > 0).all()


def test_online_lda_meets_every_document_once_a_pass(spark, small_bags, monkeypatch):
    _, rows = small_bags
    seen, sums = [], O._sums_of_batch
    monkeypatch.setattr(O, "_sums_of_batch", lambda rows, *a: seen.append(sorted(r.doc_id for r in rows.collect())) or sums(rows, *a))
    O.fit_online_lda(rows, vocab(spark, 9), k=2, passes=2, chunk_size=2)
    half = len(seen) // 2
    assert seen[:half] == seen[half:] and sorted(x for b in seen[:half] for x in b) == list(range(7)) and half > 1


def test_online_lda_models_share_batches(spark, small_bags):
    _, rows = small_bags
    settings = [dict(k=2, passes=2, chunk_size=3), dict(k=3, passes=2, chunk_size=3, topic_prior=0.1), dict(k=2, passes=1)]
    alone = [O.fit_online_lda(rows, vocab(spark, 9), **s) for s in settings]
    for a, b in zip(alone, O.fit_ldas(rows, vocab(spark, 9), settings)):
        assert np.allclose(a.lam, b.lam, rtol=1e-9) and np.allclose(a.alpha, b.alpha) and a.params == b.params
    assert (alone[1].eta == 0.1).all()


def test_online_lda_by_word_ranges_is_the_same(spark, small_bags, tmp_path, monkeypatch):
    """Topics beyond the limit stay a table: same weights, priors, distributions, bound and files."""
    from topicloom.models import ranges

    monkeypatch.setattr(ranges, "width_of", lambda k: 4)
    monkeypatch.setattr(O, "width_of", lambda k: 4)
    monkeypatch.setattr(O, "PIECE", 12)
    _, rows = small_bags
    options = dict(k=2, passes=2, chunk_size=4)
    dense = O.fit_online_lda(rows, vocab(spark, 9), **options)
    monkeypatch.setattr(O, "FACTOR_CELL_LIMIT", 10)
    ranged = O.fit_online_lda(rows, vocab(spark, 9), **options)
    assert ranged.lam is None and ranged.table.count() == 3
    held = ranged.table.orderBy("part").collect()
    assert np.allclose(np.hstack([np.array(r.m).reshape(2, 4) for r in held])[:, :9], dense.lam, rtol=1e-8)
    assert np.allclose(np.concatenate([r.e for r in held])[:9], dense.eta, rtol=1e-8) and np.allclose(ranged.alpha, dense.alpha, rtol=1e-8)
    assert ranged.log_perplexity(rows) == pytest.approx(dense.log_perplexity(rows), rel=1e-8)
    assert np.allclose(weights(ranged, rows), weights(dense, rows), rtol=1e-8) and sum(weights(dense, rows)[7]) == 0
    assert sorted(map(tuple, ranged.topics(4).collect())) == sorted(map(tuple, dense.topics(4).collect()))
    O.save_online_lda(ranged, str(tmp_path / "m"))
    assert np.allclose(weights(O.load_online_lda(spark, str(tmp_path / "m")), rows), weights(dense, rows), rtol=1e-8)


def test_online_lda(spark, tmp_path, two_topics):
    vectorizer = I.fit_tfidf(two_topics, (1, 1), 1, 1.0, None)
    bags = vectorizer.bags(two_topics)
    before = spark.sparkContext._jsc.getPersistentRDDs().size()
    fitted = O.fit_online_lda(bags, vectorizer.vocab, k=2, passes=20, chunk_size=20)
    theta = {r.doc_id: r.w for r in fitted.transform(bags).collect()}
    assert all(sum(w) == pytest.approx(1) for i, w in theta.items() if i != 60) and sum(theta[60]) == 0
    top = {r.doc_id: r.dominant_topic for r in L.dominant_topics(fitted.transform(bags)).collect()}
    assert top.pop(60) == -1
    assert len({t for i, t in top.items() if i % 2}) == 1 and len({t for i, t in top.items() if not i % 2}) == 1
    assert -2.5 < fitted.log_perplexity(bags) < -1
    words = {t: {r.term for r in fitted.topics(4).filter(f"topic_id = {t}").collect()} for t in (0, 1)}
    assert {"apple", "pear", "plum", "fig"} in words.values()
    assert [r.rank for r in fitted.topics(4).filter("topic_id = 0").orderBy("rank").collect()] == [1, 2, 3, 4]
    O.save_online_lda(fitted, str(tmp_path / "lda"))
    again = O.load_online_lda(spark, str(tmp_path / "lda"))
    assert (again.lam == fitted.lam).all() and (again.eta == fitted.eta).all() and again.params == fitted.params
    assert {r.doc_id: r.w for r in again.transform(bags).collect()}[0] == pytest.approx(theta[0])
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == before


def test_online_lda_guards(spark, small_bags):
    with pytest.raises(DataValidationError, match="no documents"):
        O.fit_online_lda(spark.createDataFrame([], ROWS), vocab(spark, 3), k=2)
    with pytest.raises(DataValidationError, match="no document has"):
        O.fit_online_lda(spark.createDataFrame([(0, [], [])], ROWS), vocab(spark, 3), k=2)
    with pytest.raises(DataValidationError, match="dictionary"):
        O.fit_online_lda(small_bags[1], vocab(spark, 3).filter("false"), k=2)


def test_top_topics(spark):
    rows = spark.createDataFrame([(0, [0.2, 0.5, 0.3]), (1, [0.4, 0.2, 0.4]), (2, [])], "doc_id bigint, w array<double>")
    got = {r.doc_id: r for r in S.top_topics(rows, 2).collect()}
    assert [(t.topic_id, t.probability) for t in got[0].topics] == [(1, 0.5), (2, 0.3)]
    assert [t.topic_id for t in got[1].topics] == [0, 2] and got[1].dominant_topic == 0
    assert got[2].dominant_topic is None and got[2].confidence == 0.0


def test_predict_batch(spark, fruit_model):
    _, vectorizer, model = fruit_model
    docs = spark.createDataFrame([(0, "Apple, pear"), (1, None), (2, "the bus"), (3, "unknown")], "doc_id bigint, text string")
    batch = S.predict_batch(docs, model, vectorizer, 1)
    rows = {r.doc_id: r for r in batch.collect()}
    assert rows[1].error == "text is null" and rows[1].prediction is None and rows[0].error is None
    assert rows[0].prediction.dominant_topic != rows[2].prediction.dominant_topic
    words = {w.word for w in rows[2].prediction.topics[0].topic_words[:4]}
    assert words == {"car", "bus", "train", "tram"}
    assert rows[3].prediction.confidence == 0.0
    assert tuple(S.batch_counts(batch).first()) == (4, 3)


def test_tuning(spark, two_topics):
    vectorizer = I.fit_tfidf(two_topics, (1, 1), 1, 1.0, None)
    rows, bags = vectorizer.arrays(two_topics), vectorizer.bags(two_topics)
    errors = {r.k: r.value for r in U.sweep_nmf(two_topics, rows, vectorizer.vocab, (1, 2, 3), "reconstruction_error").collect()}
    assert errors[2] < 0.8 * errors[1] and errors[3] <= errors[2] * 1.001
    lda = U.sweep_lda(two_topics, bags, vectorizer.vocab, (2, 3), metric="perplexity", passes=3)
    assert [r.k for r in U.sweep_table(lda).collect()] == [2, 3] and all(r.value < 0 for r in lda.collect())
    found = U.grid_search_nmf(two_topics, (4, 8), ("frobenius",), (2,), (1, 1), 1, 1.0, partitioned=False, max_iter=5)
    best = U.best_run(found.runs).first()
    assert found.best["n_topics"] == best.k == 2 and found.best["coherence"] == pytest.approx(best.value)
    grid = U.grid_search_lda(two_topics, bags, vectorizer.vocab, (2, 3), max_combinations=1, passes=2)
    assert grid.runs.count() == 1
    assert len(U.grid_points((1, 2), ("a",), (3, 4, 5), max_combinations=4)) == 4
    assert U.grid_points((1, 2), ("a",), (3, 4), 3, seed=1) == U.grid_points((1, 2), ("a",), (3, 4), 3, seed=1)


def test_best_run_takes_the_first_of_ties(spark):
    runs = spark.createDataFrame([(i, "nmf", None, None, None, None, None, k, "c", v) for i, k, v in [(0, 2, 0.5), (1, 3, 0.9), (2, 4, 0.9)]], U.RUNS)
    assert U.best_run(runs).first().k == 3 and U.best_run(runs, False).first().k == 2


def test_lda_leaves_the_cache_of_its_caller(spark, corpus):
    docs = corpus(*["apple pear plum", "car bus train"] * 12)
    vectorizer = I.fit_tfidf(docs, (1, 1), 1, 1.0, None)
    bags = vectorizer.bags(docs).persist()
    bags.count()
    first = L.fit_lda(bags, vectorizer.vocab, k=2, passes=2, topic_prior=0.1)
    assert bags.storageLevel.useMemory
    loose = vectorizer.bags(docs)
    L.fit_lda(loose, vectorizer.vocab, k=2, passes=2)
    assert bags.storageLevel.useMemory
    assert first.log_perplexity(bags) < 0


def test_bags_of_a_large_vocabulary_are_the_same(spark, corpus, monkeypatch):
    docs = corpus("a b b c", "c d", "", "x a")
    model = I.fit_tfidf(docs, (1, 1), 1, 1.0, None)
    plain = {r.doc_id: r.features for r in model.bags(docs).collect()}
    monkeypatch.setattr(I, "BROADCAST_ROW_LIMIT", 2)
    joined = {r.doc_id: r.features for r in model.bags(docs).collect()}
    assert plain == joined
