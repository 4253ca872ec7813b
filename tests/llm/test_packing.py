import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from topicloom.llm import packing as P


@pytest.fixture(scope="module")
def encode():
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    return lambda text: [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]


def check(windows, docs, encode, tiers=P.TIERS):
    """Every id in one piece, windows full and without gaps, sizes of the tiers or powers of two."""
    rows = windows.orderBy("sequence_id").collect()
    assert [r.sequence_id for r in rows] == list(range(len(rows)))
    held = defaultdict(list)
    for r in rows:
        ids = np.frombuffer(bytes(r.ids), "<u4").tolist()
        assert len(ids) == r.size and r.size <= tiers[0] and r.size & (r.size - 1) == 0
        at = 0
        for p in r.pieces:
            assert p.offset == at and p.length > 0
            held[p.doc_id, p.doc_tokens].append((p.start, ids[at : at + p.length]))
            at += p.length
        assert at == r.size
    whole = defaultdict(list)
    for doc_id, text in docs:
        ids = encode(text)
        whole[doc_id, len(ids)].append(ids)
    assert set(held) == set(whole)
    for key, copies in whole.items():
        parts = sorted(held[key])
        assert sum(len(p) for _, p in parts) == sum(map(len, copies))
        if len(copies) == 1:
            assert [x for _, p in parts for x in p] == copies[0]
            assert [s for s, _ in parts] == np.cumsum([0] + [len(p) for _, p in parts])[:-1].tolist()
    return rows


def test_whole_documents(documents, encode, prose):
    docs = [(i, prose(1 + (37 * i) % 900, seed=i)) for i in range(120)] + [(500, prose(9000, seed=3)), (501, None), (502, ""), (503, "   "), (None, "a b")]
    rows = check(P.pack(documents(*docs).repartition(3)), docs, encode)
    assert sum(r.size == 2048 for r in rows) > 10
    whole = sum(len({(p.start, p.length) for r in rows for p in r.pieces if p.doc_id == d}) == 1 for d in range(120))
    assert whole > 60  # most short documents are not cut


def test_chunks_hand_on_what_is_left(documents, encode, prose):
    """Small chunks: an unfinished window goes on to the next documents, so little is halved."""
    docs = [(i, prose(40 + i % 60, seed=i)) for i in range(200)]
    rows = check(P.pack(documents(*docs).coalesce(1), chunk=3000), docs, encode)
    assert sum(r.size < 256 for r in rows) <= 8


def test_steps_differ_by_one_window(documents, encode, prose):
    docs = [(i, prose(10 + (53 * i) % 700, seed=i)) for i in range(200)]
    rows = check(P.pack(documents(*docs).repartition(4), step_tokens=8192), docs, encode)
    sizes = defaultdict(set)
    count = defaultdict(int)
    for r in rows:
        sizes[r.step].add(r.size)
        count[r.size, r.step] += 1
    assert all(len(s) == 1 for s in sizes.values()) and sorted(sizes) == list(range(len(sizes)))
    for size in {r.size for r in rows}:
        n = [c for (s, _), c in count.items() if s == size]
        assert max(n) - min(n) <= 1 and max(n) * size <= max(8192, size)


def test_repeated_rows_and_one_tier(documents, encode, prose):
    docs = [(1, "a b c"), (1, "a b c"), (1, "a b c"), (2, prose(50))]
    check(P.pack(documents(*docs), tiers=(16,)), docs, encode, (16,))


def test_empty_table(documents):
    windows = P.pack(documents())
    assert windows.columns == ["sequence_id", "step", "size", "ids", "pieces"] and not windows.count()
    assert not P.pieces(windows).count()


def test_very_long_text(documents, encode, prose):
    docs = [(1, prose(150_000, seed=5)), (2, "short one")]
    check(P.pack(documents(*docs)), docs, encode)


@pytest.mark.parametrize("tiers", [(100,), (256, 512), (256, 256), (0,)])
def test_tiers_are_checked(documents, tiers):
    with pytest.raises(ValueError):
        P.pack(documents((1, "a")), tiers=tiers)


def test_pieces_carry_checksums(documents, encode, prose):
    docs = [(i, prose(700, seed=i)) for i in range(6)]
    for r in P.pieces(P.pack(documents(*docs))).withColumnRenamed("length", "n").collect():
        ids = encode(docs[r.doc_id][1])
        assert r.doc_tokens == len(ids)
        assert r.ids_crc32 == zlib.crc32(np.array(ids[r.start : r.start + r.n], "<u4").tobytes())


def test_best_fit_before_cutting():
    pool = P.Pool()
    for doc, length in enumerate((1500, 400, 148, 300)):
        pool.put((doc, 0, length, 0))
    windows, rest = P.pack_pieces(pool)
    assert windows == [(2048, [(0, 0, 1500, 0), (1, 0, 400, 0), (2, 0, 148, 0)])] and rest == [(3, 0, 300, 0)]
    assert P.halve(rest) == [(256, [(3, 0, 256, 0)]), (32, [(3, 256, 32, 256)]), (8, [(3, 288, 8, 288)]), (4, [(3, 296, 4, 296)])]
