import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from topicloom.llm import textbytes as B

TEXTS = st.lists(st.one_of(st.none(), st.text(alphabet="aAb é\n\t.,1日", max_size=30)), max_size=12)


@settings(max_examples=60, deadline=None)
@given(TEXTS)
def test_words_of_rows(texts):
    found = []
    for _, data, offsets in B.blocks(pa.array(texts, pa.string()), 16):
        w = B.Words(data, offsets, B.SPACED)
        for r in range(len(offsets) - 1):
            found.append([data[a:b].tobytes().decode() for a, b in zip(w.starts[w.rows[r] : w.rows[r + 1]], w.ends[w.rows[r] : w.rows[r + 1]])])
    assert found == [re.findall(r"[^\x20\x09-\x0D]+", t or "") for t in texts]


@settings(max_examples=60, deadline=None)
@given(TEXTS, st.integers(1, 4))
def test_grams_agree_with_words(texts, n):
    keys = {}
    for _, data, offsets in B.blocks(pa.array(texts, pa.string())):
        w = B.Words(data, offsets, B.SPACED)
        words = [data[a:b].tobytes() for a, b in zip(w.starts, w.ends)]
        g, ok = B.gram_hashes(w.hashes(), n), B.gram_starts(w.rows, n)
        rows = w.row_of()
        assert len(g) == len(ok)
        for k in range(len(g)):
            assert ok[k] == (rows[k] == rows[k + n - 1])
            assert keys.setdefault(tuple(words[k : k + n]), g[k]) == g[k]
    assert len(set(keys.values())) == len(keys)


def test_large_powers_grow():
    data = np.frombuffer(b"ab " * (B.BLOCK_BYTES // 2), np.uint8)
    w = B.Words(data, np.array([0, len(data)]), B.SPACED)
    assert len(np.unique(w.hashes())) == 1
