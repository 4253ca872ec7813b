"""Numpy kernels over the bytes of a batch of texts: word bounds, hashes, n-grams. They run inside Arrow functions, see
a whole text each time (a batch is cut between documents only) and hold a few times BLOCK_BYTES of memory, or of the
longest text."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

# Texts are worked on in runs of about so many bytes.
BLOCK_BYTES = 1 << 20

U64 = np.uint64
_rng = np.random.default_rng(20240607)
BYTE_CODES = _rng.integers(1, 2**63, 256, dtype=np.int64).astype(U64) * U64(2) + U64(1)
BASE = 0x9E3779B97F4A7C15  # odd, hence invertible modulo 2^64
GRAM = U64(0xD6E8FEB86659FD93)

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

# [^\x20\x09-\x0D]+
SPACED = np.ones(256, bool)
SPACED[[9, 10, 11, 12, 13, 32]] = False

# [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ after lower-casing A-Z
ALNUM = np.zeros(256, bool)
ALNUM[48:58] = ALNUM[97:123] = ALNUM[128:] = True

_powers: dict[str, np.ndarray] = {}


def _grow(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers.get("up", ())) < n:
        size = max(n, BLOCK_BYTES + 1)
        for name, base in (("up", BASE), ("down", pow(BASE, -1, 1 << 64))):
            steps = np.full(size, U64(base))
            steps[0] = 1
            _powers[name] = np.cumprod(steps)
    return _powers["up"], _powers["down"]


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (in place where possible)."""
    h = h ^ (h >> U64(30))
    h *= U64(0xBF58476D1CE4E5B9)
    h ^= h >> U64(27)
    h *= U64(0x94D049BB133111EB)
    h ^= h >> U64(31)
    return h


def blocks(column: pa.Array, block_bytes: int = BLOCK_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Cut a text column between rows: (first row, bytes, row offsets into them). A null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary()) if not pa.types.is_null(column.type) else pa.nulls(len(column), pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    n = len(column)
    if n == 0:
        return
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + n + 1]
    data = np.frombuffer(column.buffers()[2], np.uint8) if column.buffers()[2] is not None and offsets[-1] > 0 else np.zeros(0, np.uint8)
    first = 0
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + block_bytes, "right")) - 1
        last = min(n, max(last, first + 1))
        yield first, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        first = last


class Words:
    """Word bounds of a block: ``starts``, ``ends`` (bytes) and ``rows`` (first word of each row, and the end)."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, is_word: np.ndarray):
        mask = is_word[data]
        begins = np.zeros(len(data) + 1, bool)
        begins[offsets] = True
        edge = np.ones(len(data) + 1, bool)
        if len(data):
            edge[1:-1] = ~(mask[1:] & mask[:-1])
        edge |= begins
        self.data = data
        self.starts = np.flatnonzero(mask & edge[:-1])
        self.ends = np.flatnonzero(mask & edge[1:]) + 1
        self.rows = np.searchsorted(self.starts, offsets)
        self.counts = np.diff(self.rows)

    def __len__(self) -> int:
        return len(self.starts)

    def row_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.counts)), self.counts)

    def hashes(self) -> np.ndarray:
        return span_hashes(self.data, self.starts, self.ends)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each byte span, equal for equal spans wherever they stand."""
    up, down = _grow(len(data) + 1)
    sums = np.zeros(len(data) + 1, U64)
    np.cumsum(BYTE_CODES[data] * up[: len(data)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts])


def gram_hashes(h: np.ndarray, n: int) -> np.ndarray:
    """Hashes of n consecutive word hashes, at each first word; the last n - 1 have none."""
    if len(h) < n:
        return np.zeros(0, U64)
    g = h[: len(h) - n + 1].copy()
    for j in range(1, n):
        g *= GRAM
        g += h[j : len(h) - n + 1 + j]
    return mix(g)


def gram_starts(rows: np.ndarray, n: int) -> np.ndarray:
    """True at the words that start n words of one row; as long as ``gram_hashes`` gives."""
    total = int(rows[-1])
    ok = np.ones(max(0, total - n + 1), bool)
    for back in range(1, n):  # the last n - 1 words of each row start none
        at = rows[1:] - back
        at = at[(at >= rows[:-1]) & (at < len(ok))]
        ok[at] = False
    return ok


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices start..start+length-1 of each entry, one after another."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    shift = np.cumsum(lengths) - lengths
    return np.arange(total, dtype=np.int64) + np.repeat(starts - shift, lengths)


def sums_by_row(values: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Sums over the runs rows[i]..rows[i+1]."""
    total = np.concatenate([np.zeros(1, values.dtype), np.cumsum(values)])
    return total[rows[1:]] - total[rows[:-1]]


def span_strings(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The spans as an Arrow string array (spans cut no character in two)."""
    lengths = ends - starts
    offsets = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(lengths, out=offsets[1:])
    body = data[ragged(starts, lengths)] if offsets[-1] != len(data) else data
    return pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(body)))


def list_array(values: pa.Array | np.ndarray, lengths: np.ndarray) -> pa.Array:
    offsets = np.zeros(len(lengths) + 1, np.int32)
    np.cumsum(lengths, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values if isinstance(values, pa.Array) else pa.array(values))
