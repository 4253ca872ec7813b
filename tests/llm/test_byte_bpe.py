import base64
import hashlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from topicloom.llm import byte_bpe as T

with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as file:
    LINES = file.read()
OWN = T.Ranks(LINES, public_tokenizers.PATTERN)
THEIRS = tiktoken.Encoding(
    "own",
    pat_str=public_tokenizers.PATTERN,
    mergeable_ranks={base64.b64decode(a): int(b) for a, b in map(bytes.split, LINES.splitlines())},
    special_tokens={},
)


def expected(text):
    ids = np.array(THEIRS.encode_ordinary(text or ""), "<u4")
    return {"n_tokens": len(ids), "ids_sha256": hashlib.sha256(ids.tobytes()).hexdigest(), "decoded_sha256": hashlib.sha256((text or "").encode()).hexdigest()}


ODD = [
    None, "", " ", "  a  b\n\n c \n", "don't they're 'tis I'M", "a" * 5000 + " b", "x\x1cy \x85z", "é" * 300, "日本語 テキスト", "1234 56!!??--\n  -",
    "　　a ", "a  b\n c", "<|endoftext|>", "!'s a's 1's", " \t\n", "\U0001f600" * 9, "word word", "A.B,c;d(e)f",
]


def test_odd_texts():
    assert T.digests(OWN, pa.array(ODD, pa.string())).to_pylist() == [expected(t) for t in ODD]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet=st.one_of(st.sampled_from(" \n\t'.,!s  \x1cabcABC019é日"), st.characters(exclude_categories=["Cs"])), max_size=60), max_size=8))
def test_any_text(texts):
    assert T.digests(OWN, pa.array(texts, pa.string())).to_pylist() == [expected(t) for t in texts]


@settings(max_examples=60, deadline=None)
@given(st.binary(min_size=2, max_size=90))
def test_both_kinds_of_trees_agree(piece):
    leaves = 1 << (len(piece) - 1).bit_length()
    together, count = OWN.encode_together([piece, piece[::-1]], max(2, leaves))
    assert together[: count[0]].tolist() == OWN.encode_piece(piece)
    assert together[count[0] :].tolist() == OWN.encode_piece(piece[::-1])


def test_memory_is_bounded(monkeypatch):
    monkeypatch.setattr(T, "REMEMBERED", 3)
    ranks = T.Ranks(LINES, public_tokenizers.PATTERN)
    for text in ("one two three four five", "six seven one", "one two three"):
        assert T.digests(ranks, pa.array([text])).to_pylist() == [expected(text)]
    assert len(ranks.chunks) <= 6


@pytest.mark.parametrize("rows", [[], [(1, "a b"), (1, "a b"), (None, None), (2, "x" * 100_000)]])
def test_documents(documents, rows):
    found = T.encode_documents(documents(*rows))
    assert found.columns == ["doc_id", "text", "lang", "source", "n_chars", "tokens"]
    assert [r.tokens.asDict() for r in found.collect()] == [expected(t) for _, t in rows]


def test_ids_and_decoding(spark, documents):
    tokenizer = T.Tokenizer(spark)
    rows = documents((1, "héllo wörld"), (2, None)).select("text", tokenizer.encode("text").alias("ids")).select("*", tokenizer.decode("ids").alias("back")).collect()
    assert rows[0].ids == THEIRS.encode_ordinary("héllo wörld") and bytes(rows[0].back).decode() == rows[0].text
    assert rows[1].ids == [] and bytes(rows[1].back) == b""
