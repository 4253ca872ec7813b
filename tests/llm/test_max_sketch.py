import math
import re
from collections import Counter

import numpy as np
import pytest

from topicloom.llm import max_sketch as R

TERM = re.compile(rb"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return [t.lower() for t in TERM.findall((text or "").encode())]


def brute(docs, items, k):
    counts = [(i, Counter(terms(t))) for i, t in docs]
    counts = [(i, c) for i, c in counts if c]
    n_docs, length = len(counts), sum(sum(c.values()) for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    out = []
    for item, text in items:
        scored = []
        for doc, c in counts:
            m = 25 + 75 * sum(c.values()) * n_docs // length
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (1000000000 * c[t] // (1000 * c[t] + 8 * m)) for t in terms(text) if t in c)
            if score > 0:
                scored.append((-score, doc is not None, doc or 0))
        out += [(item, r + 1, d if known else None, -s) for r, (s, known, d) in enumerate(sorted(scored)[:k])]
    return out


def check(found, docs, items, k=10):
    key = lambda r: tuple((v is not None, v or 0) for v in r)
    assert sorted(map(tuple, found.collect()), key=key) == sorted(brute(docs, items, k), key=key)


@pytest.fixture
def items(spark):
    def build(*rows):
        return spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "item_id bigint, text string, row int, terms string")

    return build


@pytest.mark.parametrize("width", [1, 16, 4096, 65536])
def test_like_brute_force(documents, items, prose, width):
    """Any width gives the same ranking, and batches of any size."""
    docs = [(i, prose(5 + 7 * (i % 40), seed=i % 90)) for i in range(150)]
    asked = [(i, prose(3 + i, seed=i)) for i in range(12)] + [(50, "ba ba ba be zzz"), (51, "zzz")]
    found = R.search(R.build_index(documents(*docs).repartition(5), width), items(*asked), width=width, batch_items=5)
    check(found, docs, asked)


def test_odd_rows(documents, items):
    """Null, empty and termless texts, repeated rows and ids, ties by id, capital letters, letters beyond ASCII, digits."""
    docs = [(1, None), (2, ""), (3, " .,;`{ "), (4, "Été 99 abc"), (5, "été 99 ABC"), (5, "été 99 ABC"), (6, "x"), (None, "été 99 abc"), (7, "x x x x y")]
    docs += [(100 - i, "same words here") for i in range(40)]
    asked = [(1, "ÉTÉ été 99"), (2, "same words"), (2, "same words"), (3, None), (None, "x y"), (4, ""), (5, "a_b@x[y"), (6, "nowhere")]
    check(R.search(R.build_index(documents(*docs)), items(*asked)), docs, asked)


@pytest.mark.parametrize("docs, asked", [([], [(1, "a")]), ([(1, "a")], []), ([(1, None)], [(1, "a")]), ([(1, "a")], [(1, "b")])])
def test_empty_tables(documents, items, docs, asked):
    found = R.search(R.build_index(documents(*docs)), items(*asked))
    assert found.columns == ["item_id", "rank", "doc_id", "score"] and not found.count()


def test_very_long_text_and_large_counts(documents, items, prose):
    """Counts beyond what a coordinate holds, and a text of 200,000 words beside short ones."""
    long = prose(100_000, seed=1) + " word" * 100_000
    docs = [(1, long), (2, "word " * 300), (3, "word " * 254), (4, "word " * 256), (5, prose(50, seed=2)), (6, "other")]
    asked = [(1, "word"), (2, prose(30, seed=2)), (3, "word " * 5_000 + "other")]
    check(R.search(R.build_index(documents(*docs)), items(*asked)), docs, asked)


def test_bounds_spare_most_documents(prose):
    import pyarrow as pa

    texts = [prose(60, seed=i) for i in range(2000)]
    rows = pa.RecordBatch.from_arrays([pa.array(range(2000)), pa.array(texts)], ["id", "text"])
    (index,) = R._vectors(rows.column(0), rows.column(1), 4096)
    (item,) = R._vectors(pa.array([0]), pa.array([texts[77]]), None)
    row = type("Row", (), {"row": 0, "terms": item.column(2)[0].as_py(), "counts": item.column(3)[0].as_py()})
    batch = R.Batch([row], 4096)
    df = Counter(t for v in index.column(2).to_pylist() for t in np.frombuffer(v, np.uint64).tolist())
    batch.weigh(2000, df)
    ranking = R.Ranking(batch, 2000, 2000 * 60, 10)
    for a in range(0, 2000, R.ROWS):
        part = index.slice(a, R.ROWS)
        ranking.add(part.column(0).to_pylist(), part.column(1).to_pylist(), *(part.column(c) for c in range(2, 6)))
    assert ranking.best[0][0][2] == 77 and ranking.scored < 400
    assert [(-s, i) for s, _, i in ranking.best[0]] == [(s, d) for _, _, d, s in brute(list(enumerate(texts)), [(0, texts[77])], 10)]


def test_width_is_checked(documents):
    with pytest.raises(ValueError):
        R.build_index(documents((1, "a")), 70_000)
