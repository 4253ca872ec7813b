import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from topicloom.llm import rans_tokens as A
from topicloom.llm import textbytes as B
from topicloom.llm.staging import folder

WHOLE = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
WHOLE.encode_special_tokens = True
OWN = A.Encoder(A.read_definition(None))


def whole(text):
    return WHOLE.encode(text or "", add_special_tokens=False).ids


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet=st.one_of(st.sampled_from(" \n'’.,!()stmd́ \x1cabAB019éİΣ日"), st.characters(exclude_categories=["Cs"])), max_size=40), min_size=1, max_size=8))
def test_parts_are_encoded_as_the_whole(texts):
    for _, data, offsets in B.blocks(pa.array(texts, pa.string())):
        ids, counts = OWN.encode_block(data, offsets)
        edges = np.concatenate([[0], np.cumsum(counts)])
        assert [ids[a:b].tolist() for a, b in zip(edges, edges[1:])] == [whole(t) for t in texts]


def test_words_of_letters_are_encoded_many_to_a_text():
    parts = ["the", "straße", "ÿö", "don't", "É", "42", "İ", "ά", "слово", "λόγος", "λογος", "ﬁ", "日本", "e\u0301a", "zzqxv" * 50, "<|endoftext|>", "..", "a"] + [f"w{chr(97 + k % 26)}{chr(97 + k // 26 % 26)}" for k in range(1300)]
    calls = []

    class Counting:
        def encode_batch_fast(self, texts, **options):
            calls.append(len(texts))
            return OWN.tokenizer.encode_batch_fast(texts, **options)

    own = A.Encoder(A.read_definition(None))
    own.tokenizer = Counting()
    for case in (parts, parts[:8], ["42", "É"], ["a"], []):
        ids, lengths = own.encode_units(case)
        edges = np.concatenate([[0], np.cumsum(lengths)])
        assert [ids[a:b].tolist() for a, b in zip(edges, edges[1:])] == [OWN.tokenizer.encode(p, add_special_tokens=False).ids for p in case]
        if case is parts:
            assert sum(calls) < 20  # not one text a word
    own.ends[:] = False  # a tokenizer that does not mark the ends of words
    ids, lengths = own.encode_units(parts)
    assert lengths.tolist() == [len(OWN.tokenizer.encode(p, add_special_tokens=False).ids) for p in parts]


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(0, 40), max_size=300), st.integers(1, 900))
def test_blocks_round_trip(ids, times):
    ids = np.array(ids * times, np.uint32)
    table = A.Table(np.bincount(ids, minlength=50))
    assert table.freq.sum() == (1 << A.SCALE if len(ids) else 0)
    block = table.encode(ids)
    assert table.decode(block).tolist() == ids.tolist()


def test_checkpoints_and_checksums():
    rng = np.random.default_rng(1)
    ids = (rng.zipf(1.3, 1_500_000) % 40_000).astype(np.uint32)
    table = A.Table(np.bincount(ids))
    block = table.encode(ids)
    assert len(block) < 2 * len(ids)
    points = A.HEAD.unpack_from(block)[3]
    assert points == 3
    for k in range(points):
        assert (table.decode(block, k) == ids[k * A.CHECK_STEPS * A.LANES :]).all()
    broken = bytearray(block)
    broken[len(block) // 2] ^= 1
    with pytest.raises(ValueError, match="damaged"):
        table.decode(bytes(broken))
    with pytest.raises(ValueError, match="frequency table"):
        A.Table(np.array([1, 0])).encode(np.array([1], np.uint32))


def test_many_rare_ids_fit_the_table():
    counts = np.concatenate([[10**12], np.ones(200_000, np.int64)])
    table = A.Table(counts)
    assert table.freq.sum() == 1 << A.SCALE and table.freq.min() == 1


def expected(rows):
    out, start = [], 0
    for d, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = np.array([*whole(t), A.END_ID], "<u4")
        out.append((d, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


@pytest.mark.parametrize("rows", [
    [],
    [(9, "later words"), (3, None), (1, ""), (4, "Don't stop 'tis (a) b,c 12ab"), (7, "z" * 3000), (None, "no id"), (5, "same"), (5, "same"), (6, "long text " * 30_000)],
])
def test_files_in_order(documents, rows, monkeypatch):
    assert sorted((tuple(r) for r in A.round_trip(documents(*rows)).collect()), key=lambda r: r[1]) == expected(rows)


def test_file_rows(spark, documents):
    path = folder(spark)
    A.write_blocks(documents(*[(k, "word " * k) for k in range(50)]), path)
    rows = sorted(spark.read.parquet(path).collect(), key=lambda r: (r.part, r.block))
    assert [d for r in rows for d in r.doc_ids] == list(range(50))


def test_added_tokens_as_the_library_does(documents):
    """The strings of added tokens in a text are these tokens, as in a tokenizer left as it was read."""
    untouched = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    texts = ["one <|endoftext|> two", "a<|endoftext|>b", "<|startoftext|><|endoftext|>", "<|ENDOFTEXT|> <|endoftext", "|>x<|endoftext|>", "é<|startoftext|>\u0301é", "<|endof text|> <<|endoftext|>>", "<|endoftext|>\n"]
    expect = [untouched.encode(t, add_special_tokens=False).ids for t in texts]
    assert expect[0] == [637, 49407, 1237]
    for _, data, offsets in B.blocks(pa.array(texts, pa.string())):
        ids, counts = OWN.encode_block(data, offsets)
        edges = np.concatenate([[0], np.cumsum(counts)])
        assert [ids[a:b].tolist() for a, b in zip(edges, edges[1:])] == expect
    rows = sorted(A.round_trip(documents(*enumerate(texts))).collect())
    assert [(r.n_tokens, r.ids_crc32) for r in rows] == [(len(e) + 1, zlib.crc32(np.array([*e, A.END_ID], "<u4").tobytes())) for e in expect]


def test_parts_met_again_are_remembered(monkeypatch):
    """A full memory forgets what was met once; words of letters go past the normalizer and the pattern."""
    monkeypatch.setattr(A, "REMEMBERED", 20)
    own = A.Encoder(A.read_definition(None))
    assert own.bare is not own.tokenizer
    asked = []
    encode = own.encode_units
    monkeypatch.setattr(own, "encode_units", lambda parts: asked.extend(parts) or encode(parts))
    for k in range(12):
        text = "the cat straße " + " ".join(f"w{chr(97 + k)}{chr(97 + j)}" for j in range(9))
        data = np.frombuffer(text.encode(), np.uint8)
        ids, counts = own.encode_block(data, np.array([0, len(data)]))
        assert ids.tolist() == whole(text) and counts.tolist() == [len(ids)]
    assert asked.count("the") == asked.count("straße") == 1
    assert len(own.places) <= 40
