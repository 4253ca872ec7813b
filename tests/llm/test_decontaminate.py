import re

import pytest

from topicloom.llm import decontaminate as D

ITEM = "one two three four five six seven eight nine ten eleven twelve"


def brute(docs, items, window=10):
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    out = []
    for doc_id, text in docs:
        w, hit, names = words(text), set(), set()
        for name, item in items:
            x = words(item)
            size = min(window, len(x))
            if name is None or not x:
                continue
            grams = {tuple(x[k : k + size]) for k in range(len(x) - size + 1)}
            for k in range(len(w) - size + 1):
                if tuple(w[k : k + size]) in grams:
                    hit |= set(range(k, k + size))
                    names.add(str(name))
        out.append((doc_id, len(w), len(hit), sorted(names)))
    return out


DOCS = [
    (1, "before " + ITEM.upper().replace(" ", ", ") + " after"),
    (2, ITEM[:40]),
    (3, None),
    (4, ""),
    (5, "!!!"),
    (6, "tiny item"),
    (7, "a Tiny-ITEM, and été naïve"),
    (8, "x " * 50_000 + ITEM + " y" * 50_000),
    (9, ITEM),
    (9, ITEM),
    (None, ITEM + " " + ITEM),
    (10, "two three four five six seven eight nine ten eleven"),
    (11, "été naïve"),
]
ITEMS = [(10, ITEM), (2, "tiny item"), (3, None), (4, ""), (5, "?"), (None, "before"), (6, "ÉTÉ"), (7, "été naïve"), (7, "été naïve")]


@pytest.mark.parametrize("limit", [1000, 0])
def test_against_brute_force(spark, documents, limit):
    items = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    found = D.find_contamination(documents(*DOCS), items, broadcast_windows=limit)
    got = sorted((str(r.doc_id), r.contamination.n_words, r.contamination.n_hit, r.contamination["items"]) for r in found.collect())
    assert got == sorted((str(a), *b) for a, *b in brute(DOCS, ITEMS))
    assert found.columns == ["doc_id", "text", "lang", "source", "n_chars", "contamination"]


@pytest.mark.parametrize("limit", [1000, 0])
def test_spans_and_removal(spark, documents, limit):
    items = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    docs = documents((1, f"é {ITEM}!"), (2, "été naïve"), (3, "clean text"), (4, None))
    found = D.find_contamination(docs, items, broadcast_windows=limit)
    spans = {r.doc_id: [tuple(s) for s in r.contamination.spans] for r in found.collect()}
    assert spans == {1: [(2, 2 + len(ITEM))], 2: [(0, 9)], 3: [], 4: []}
    cut = {r.doc_id: r.text for r in D.remove(found, "spans").collect()}
    assert cut == {1: "é !", 2: "", 3: "clean text", 4: None}
    assert {r.doc_id for r in D.remove(found).collect()} == {3, 4}


@pytest.mark.parametrize("limit", [1000, 0])
def test_empty_tables(spark, documents, limit):
    none = spark.createDataFrame([], "item_id bigint, text string")
    some = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    assert [r.contamination.n_hit for r in D.find_contamination(documents((1, ITEM)), none, broadcast_windows=limit).collect()] == [0]
    assert D.find_contamination(documents(), some, broadcast_windows=limit).count() == 0
