import random
import re
from itertools import combinations

import pytest

from topicloom.llm import minhash_forest as H


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()


def brute(docs):
    sets = [(d, shingles(t)) for d, t in docs]
    root = list(range(len(docs)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for i, j in combinations(range(len(docs)), 2):
        (a, x), (b, y) = sets[i], sets[j]
        if x and y and a is not None and b is not None and 100 * len(x & y) >= 85 * len(x | y):
            root[find(i)] = find(j)
    least = {}
    for k, (d, x) in enumerate(sets):
        if x and d is not None:
            least[find(k)] = min(least.get(find(k), d), d)
    return sorted(((str(d), len(x), str(least.get(find(k), d) if x and d is not None else d)) for k, (d, x) in enumerate(sets)))


def edited(text, *places):
    words = text.split()
    for p in places:
        words[p] = f"new{p}"
    return " ".join(words)


def result(df):
    return sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in df.collect())


def test_against_brute_force(documents, prose):
    docs = []
    for g in range(12):  # copies, near copies on both sides of the threshold, chains
        base = prose(90 + 5 * g, g)
        docs += [(100 * g + k, edited(base, *range(7, 7 + 11 * (k % 4), 11))) for k in range(7)]
    docs += [(5000, None), (5001, ""), (5002, " \n"), (5003, "a b c"), (5004, "A  b\tC"), (5005, "a b"), (5006, prose(30_000, 99)), (5007, prose(30_000, 99) + " end")]
    docs += [(None, docs[0][1]), (0, docs[0][1]), (3, prose(50, 77))]
    found = H.find_groups(documents(*docs))
    assert result(found) == brute(docs)
    kept = {r.doc_id for r in found.filter("kept").collect()}
    assert {5000, 5001, 5002, None} <= kept and 5004 not in kept and 5007 not in kept


def test_one_group_of_most_rows(documents, prose):
    """Near copies of one text, each with own edits, linked through the unedited one."""
    base = prose(200, 5)
    docs = [(k, edited(base, (7 * k) % 200, (13 * k + 50) % 200)) for k in range(1, 300)] + [(999, base)]
    docs += [(2000 + k, prose(60, 1000 + k)) for k in range(100)]
    assert result(H.find_groups(documents(*docs))) == brute(docs)


def test_keep_one(documents, prose):
    a, b = prose(80, 1), prose(80, 2)
    docs = documents((1, a), (2, a.upper()), (3, b), (3, b), (3, edited(b, 3)), (4, None), (None, a), (5, ""))
    left = H.keep_one(docs)
    assert left.columns == docs.columns
    ids = sorted(str(r.doc_id) for r in left.collect())
    assert ids == ["1", "3", "4", "5", "None"]


def test_no_rows(documents):
    assert H.find_groups(documents()).count() == 0
    assert H.keep_one(documents((1, None))).count() == 1


@pytest.mark.parametrize("edges", [[], [("a", "b")], [("a", "b"), ("c", "b"), ("d", "c"), ("e", "d"), ("y", "x")], [(f"n{k:03}", f"n{k + 1:03}") for k in range(40)]])
def test_components(spark, edges):
    rows = spark.createDataFrame([(min(e), max(e)) for e in edges], "a string, b string")
    roots = {}

    def find(k):
        while roots.setdefault(k, k) != k:
            k = roots[k]
        return k

    for a, b in edges:
        x, y = sorted((find(a), find(b)))
        roots[y] = x
    got = {r.id: r.root for r in H.components(rows).collect()}
    assert {k: find(k) for k in roots if find(k) != k} == {k: v for k, v in got.items() if k != v}


def test_crowded_region_of_many_hubs(documents):
    """Bases on one template, each with edits that are linked through their own base only."""
    rng, docs = random.Random(4), []
    for h in range(30):
        base = [f"t{k}" for k in range(400)]
        for p in rng.sample(range(0, 400, 8), 7):
            base[p] = f"b{h}x{p}"
        docs.append((1000 * h + 999, " ".join(base)))
        for k in range(30):
            own = set(rng.sample(range(4, 396, 8), 6))
            docs.append((1000 * h + k, " ".join(f"e{h}x{k}x{p}" if p in own else w for p, w in enumerate(base))))
    assert result(H.find_groups(documents(*docs))) == brute(docs)


def test_unlinked_near_copies_send_no_pairs(spark, documents, prose, monkeypatch):
    """Near copies of one text that are hardly linked: what the last comparison sends grows with the texts, not with their pairs."""
    rng, marks = random.Random(8), []
    linked = H.linked_within
    monkeypatch.setattr(H, "linked_within", lambda docs, sets, marked, percent: marks.append(marked.count()) or linked(docs, sets, marked, percent))
    base = prose(300, 3)
    for n in (150, 300):
        docs = [(k, edited(base, *rng.sample(range(5, 295, 8), 5))) for k in range(n)]
        assert result(H.find_groups(documents(*docs))) == brute(docs)
    assert 0 < marks[1] < 2.6 * marks[0] and marks[1] < 300 * H.TREES < 300 * 299 / 2


def test_forest(monkeypatch):
    """Links of exact sets over small column blocks: as many as join what is linked."""
    import numpy as np
    import pyarrow as pa

    monkeypatch.setattr(H, "COLUMNS", 7)
    rng = np.random.default_rng(2)
    bases = [rng.integers(0, 1 << 60, 40) for _ in range(3)]
    sets = [np.unique(np.concatenate([rng.choice(bases[k % 3], 37, replace=False), rng.integers(0, 1 << 60, k % 2)])) for k in range(24)]
    comp = [k // 2 for k in range(24)]
    for right in ([False] * 24, [k % 4 > 1 for k in range(24)]):
        rows = pa.table({"task": [1] * 24, "right": right, "id": [bytes([k]) for k in range(24)], "comp": comp, "hashes": [s.tolist() for s in sets]})
        links = {(i, j) for i, j in combinations(range(24), 2) if comp[i] != comp[j] and (right[i] != right[j] or not any(right)) and 100 * len(set(sets[i]) & set(sets[j])) >= 85 * len(set(sets[i]) | set(sets[j]))}
        found = [(a[0], b[0]) for batch in H.forest(rows, 85) for a, b in zip(*(c.to_pylist() for c in batch.columns))]
        assert set(found) <= links and len(found) < 12

        def groups(pairs):
            label = list(comp)
            for i, j in pairs:
                label = [label[i] if x == label[j] else x for x in label]
            return {frozenset(k for k in range(24) if label[k] == x) for x in label}

        assert groups(found) == groups(links)


def test_agreements():
    assert [H.agreements(p)[1] for p in (85, 80)] == [86, 78]
