import itertools
import math
import re
import zlib
from collections import Counter

import numpy as np

from topicloom.llm import hidden_markov as S


def model(states=3, symbols=5, seed=0):
    rng = np.random.default_rng(seed)
    emit = rng.dirichlet(np.ones(symbols), states).T.copy()
    return S.Model(rng.dirichlet(np.ones(states)), rng.dirichlet(np.ones(states), states), emit, np.array([10, 20, 30, 40], np.uint64))


def test_expected_counts_are_those_of_all_paths():
    m = model()
    words, edges = np.array([10, 20, 99, 30, 40, 10, 10, 30, 20, 40, 98], np.uint64), np.array([0, 4, 5, 11])
    start, moves, emitted, log = S.expected(m, words, edges)
    seen, total = m.symbols(words), 0.0
    a, b, c = np.zeros_like(start), np.zeros_like(moves), np.zeros_like(emitted)
    for x, y in zip(edges, edges[1:]):
        s, every = seen[x:y], []
        for path in itertools.product(range(3), repeat=len(s)):
            p = m.start[path[0]] * np.prod([m.emit[o, k] for o, k in zip(s, path)]) * np.prod([m.step[i, j] for i, j in zip(path, path[1:])])
            every.append((path, p))
        whole = sum(p for _, p in every)
        total += math.log(whole)
        for path, p in every:
            a[path[0]] += p / whole
            for o, k in zip(s, path):
                c[o, k] += p / whole
            for i, j in zip(path, path[1:]):
                b[i, j] += p / whole
    assert math.isclose(log, total)
    assert np.allclose(start, a) and np.allclose(moves, b) and np.allclose(emitted, c)


def tokens(text):
    return [*re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")), None]


def base(rows):
    known = Counter()
    for d, t in rows:
        if d is None or zlib.crc32(str(d).encode()) % 5 != 1:
            known.update(tokens(t))
    n, v = sum(known.values()), len(known)
    return {d: (len(x), sum(known[w] > 0 for w in x), n, sum(math.log10((known[w] + 0.5) / (n + 0.5 * (v + 1))) for w in x)) for d, t in rows for x in [tokens(t)]}


def check(found, rows):
    for d, (n, known, total, log) in base(rows).items():
        r = found[d]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (n, known, total)
        assert math.isclose(r.base_score, log, rel_tol=1e-9, abs_tol=1e-9)
        assert r.score <= 0


def rows_of(prose):
    rows = [(k, prose(40 + k, k % 9)) for k in range(60)]
    return [*rows, (100, None), (101, ""), (102, "Only Unseen"), (103, "long text " * 20_000), (None, "no id"), (104, "twice"), (104, "twice")]


def test_base_score_and_held_out(documents, prose):
    rows = rows_of(prose)
    scored = S.score(documents(*rows), rounds=2, symbols=20, states=3)
    assert scored.columns == ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    found = {r.doc_id: r for r in scored.collect()}
    assert scored.count() == len(rows)
    check(found, rows)
    assert found[0].held_out == (zlib.crc32(b"0") % 5 == 1) and found[None].held_out is False


def test_counts_beyond_the_head_are_joined(documents, prose):
    rows = rows_of(prose)
    few = {r.doc_id: r for r in S.score(documents(*rows), rounds=1, symbols=5, states=2, head_words=8).collect()}
    check(few, rows)
    many = {r.doc_id: r for r in S.score(documents(*rows), rounds=1, symbols=5, states=2).collect()}
    assert all(math.isclose(few[k].score, many[k].score, rel_tol=1e-9) for k in many)


def test_probabilities_add_up(documents):
    """Over all texts of one word (the unseen one included) and the empty text, the first step's mass is 1."""
    m = model()
    seen = m.emit @ np.diag(m.start)
    assert math.isclose(seen.sum(), 1.0)


def test_training_raises_the_likelihood(documents, prose):
    texts = [" ".join(["red blue"] * 20 if k % 2 else ["green white"] * 20) for k in range(80)]
    docs = documents(*enumerate(texts))
    logs = [sum(r.score for r in S.score(docs, rounds=n, symbols=10, states=3).collect()) for n in (0, 2, 4)]
    assert logs[0] < logs[1] < logs[2]


def test_no_rows(documents):
    assert S.score(documents()).count() == 0
