import re
from bisect import bisect_left

import numpy as np
import pytest

from topicloom.llm import sparse_suffixes as X
from topicloom.llm.neighbours import sorted_neighbours


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, size=X.PASSAGE):
    first, hits = {}, []
    for d, t in sorted(docs, key=lambda r: (r[0] is not None, r[0] or 0)):
        w, hit, own = words(t), set(), set()
        for k in range(len(w) - size + 1):
            p = tuple(w[k : k + size])
            if p in own or first.setdefault(p, d) != d:
                hit |= set(range(k, k + size))
            own.add(p)
        hits.append((str(d), len(w), sorted(hit)))
    return sorted(hits)


def result(found):
    return sorted((str(r.doc_id), r.n_words, [k for s in r.spans for k in range(s.start, s.end)]) for r in found.collect())


def test_against_brute_force(documents, prose):
    shared = [prose(n, 1000 + n) for n in (49, 50, 51, 60, 90, 200)]
    docs = [(k, f"{prose(10 + 7 * k, k)} {shared[k % 6]} {prose(20, 50 + k)} {shared[(k * 5 + 1) % 6]}") for k in range(40)]
    docs += [(100, prose(300, 7)), (101, prose(300, 7).upper()), (102, prose(120, 8) + " " + prose(120, 8)), (103, "x " * 200), (104, "y x " * 100), (105, "x " * 80)]
    docs += [(200, None), (201, ""), (202, prose(49, 7)), (None, shared[5]), (203, prose(20_000, 9)), (204, prose(20_000, 9) + " end")]
    found = X.find_repeats(documents(*docs))
    assert result(found) == brute(docs)
    assert all(a.end < b.start for r in found.collect() for a, b in zip(r.spans, r.spans[1:]))


def test_rows_of_one_id_are_one_document(documents, prose):
    text = prose(80, 3)
    rows = {(r.doc_id, len(r.spans)) for r in X.find_repeats(documents((1, text), (1, text), (2, text))).collect()}
    assert rows == {(1, 0), (2, 1)}


def test_slices_find_the_same(documents, prose, monkeypatch):
    shared = prose(70, 1)
    docs = [(k, f"{prose(60, k)} {shared} {prose(60, 90 + k)}") for k in range(2, 12)]
    monkeypatch.setattr(X, "SLICE", 1)
    assert result(X.find_repeats(documents(*docs))) == brute(docs)


def test_removal(documents, prose):
    shared = prose(60, 1)
    docs = documents((1, f"one\n{shared} two"), (2, f"a  b\n{shared}\n c"), (3, shared), (4, None), (5, "clean"))
    left = X.remove_repeats(docs)
    assert left.columns == docs.columns
    texts = {r.doc_id: r.text for r in left.collect()}
    assert texts == {1: f"one\n{shared} two", 2: "a  b\nc", 3: "", 4: None, 5: "clean"}


def test_no_rows(documents):
    assert X.find_repeats(documents()).count() == 0


@pytest.mark.parametrize("width", [1, 2, 3, 7, 39])
def test_least_of(width):
    v = np.random.default_rng(width).integers(0, 9, 200)
    assert X.least_of(v, width).tolist() == [k + int(v[k : k + width].argmin()) for k in range(200 - width + 1)]


@pytest.mark.parametrize("back", [1, 3])
def test_neighbours_over_ranges(spark, back):
    values = sorted({(k * 37) % 101 for k in range(90)})
    rows = spark.createDataFrame([(v,) for v in values], "v int").repartition(5)
    for r in sorted_neighbours(rows, ["v"], back).collect():
        at = bisect_left(values, r.v)
        got = [e["v"] for e in r.earlier if e is not None]
        # a range of fewer rows than ``back`` may hide rows before it, never the nearest
        assert got == values[max(0, at - len(got)) : at][::-1] and (got or not at)
