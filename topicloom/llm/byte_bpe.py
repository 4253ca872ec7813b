"""Byte-level BPE by given ranks: the merges of a piece are found in a segment tree over its byte positions. Each leaf
holds the rank of the pair that starts there, each node the least (rank, position) below it, so the root names the next
merge (the leftmost of the lowest rank) and a merge updates three leaves and their paths."""

from __future__ import annotations

import base64
import hashlib
import itertools
from functools import cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from topicloom.llm import textbytes as B

# Pieces up to so many bytes are merged together in arrays of trees, longer ones alone.
TOGETHER_BYTES = 128
# So many distinct chunks of text are remembered by a worker; then it starts anew.
REMEMBERED = 250_000
BLOCK = 1 << 20  # bytes of text encoded at a time: a worker keeps its memory while later stages use others
NONE = 1 << 40  # rank of a pair that is no token
RESULT = "n_tokens bigint, ids_sha256 string, decoded_sha256 string"


class Ranks:
    """The vocabulary: token bytes by id, the id of each pair of tokens whose bytes are a token, and the pieces."""

    def __init__(self, rank_lines: bytes, pattern: str):
        self.ids = {base64.b64decode(a): int(b) for a, b in (line.split() for line in rank_lines.splitlines() if line)}
        size = max(self.ids.values()) + 1
        tokens = [b""] * size
        for token, i in self.ids.items():
            tokens[i] = token
        self.lengths = np.array([len(t) for t in tokens], np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.bytes = np.frombuffer(b"".join(tokens), np.uint8)
        self.byte_ids = np.array([self.ids[bytes([b])] for b in range(256)], np.int64)
        self.pairs = {}
        for token, i in self.ids.items():
            for cut in range(1, len(token)):
                a, b = self.ids.get(token[:cut]), self.ids.get(token[cut:])
                if a is not None and b is not None:
                    self.pairs[a << 24 | b] = i
        keys = np.fromiter(self.pairs, np.int64, len(self.pairs))
        order = np.argsort(keys)
        self.keys = keys[order]
        self.values = np.fromiter(self.pairs.values(), np.int64, len(self.pairs))[order]
        self.pattern = regex.compile(pattern)
        self.forget()

    def forget(self) -> None:
        self.chunks: dict[str, int] = {}
        self.chunk_starts = self.chunk_lengths = np.zeros(0, np.int64)
        self.chunk_ids = np.zeros(0, np.uint32)

    def rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = a << 24 | b
        at = np.searchsorted(self.keys, key)
        at[at == len(self.keys)] = 0
        return np.where(self.keys[at] == key, self.values[at], NONE)

    def encode_piece(self, piece: bytes) -> list[int]:
        """One tree for one piece."""
        ids = self.byte_ids[np.frombuffer(piece, np.uint8)].tolist()
        n, pairs = len(ids), self.pairs
        leaves = 1 << max(1, (n - 1).bit_length())
        never = (NONE, 0)
        tree = [never] * (2 * leaves)
        for i in range(n - 1):
            r = pairs.get(ids[i] << 24 | ids[i + 1])
            if r is not None:
                tree[leaves + i] = (r, i)
        for k in range(leaves - 1, 0, -1):
            tree[k] = min(tree[2 * k], tree[2 * k + 1])
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))

        def put(i: int, value: tuple[int, int]) -> None:
            k = leaves + i
            tree[k] = value
            while k > 1:
                k >>= 1
                least = min(tree[2 * k], tree[2 * k + 1])
                if tree[k] == least:
                    break
                tree[k] = least

        while tree[1] is not never and tree[1][0] < NONE:
            r, i = tree[1]
            gone = after[i]
            ids[i] = r
            put(gone, never)
            after[i] = right = after[gone]
            if right < n:
                before[right] = i
                found = pairs.get(r << 24 | ids[right])
                put(i, never if found is None else (found, i))
            else:
                put(i, never)
            left = before[i]
            if left >= 0:
                found = pairs.get(ids[left] << 24 | r)
                put(left, never if found is None else (found, left))
        out, i = [], 0
        while i < n:
            out.append(ids[i])
            i = after[i]
        return out

    def encode_together(self, pieces: list[bytes], leaves: int) -> tuple[np.ndarray, np.ndarray]:
        """One tree for each of many pieces of at most ``leaves`` bytes; each round makes the next merge of all. The ids
        one after another, and the number of each piece."""
        count = len(pieces)
        sizes = np.fromiter(map(len, pieces), np.int64, count)
        ids = np.zeros((count, leaves + 1), np.int64)
        real = np.arange(leaves + 1) < sizes[:, None]
        ids[real] = self.byte_ids[np.frombuffer(b"".join(pieces), np.uint8)]
        bits = leaves.bit_length()
        never = NONE << bits
        tree = np.full((count, 2 * leaves), never, np.int64)
        ranks = np.where(real[:, 1:], self.rank(ids[:, :-1].ravel(), ids[:, 1:].ravel()).reshape(count, leaves), NONE)
        tree[:, leaves:] = np.where(ranks < NONE, ranks << bits | np.arange(leaves), never)
        level = leaves
        while level > 1:
            tree[:, level // 2 : level] = np.minimum(tree[:, level : 2 * level : 2], tree[:, level + 1 : 2 * level : 2])
            level //= 2
        after = np.tile(np.arange(1, leaves + 2), (count, 1))
        before = np.tile(np.arange(-1, leaves), (count, 1))
        live = real.copy()

        def put(rows: np.ndarray, i: np.ndarray, values: np.ndarray | int) -> None:
            k = i + leaves
            tree[rows, k] = values
            while (k := k >> 1)[0]:
                tree[rows, k] = np.minimum(tree[rows, 2 * k], tree[rows, 2 * k + 1])

        def pair(rows: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
            found = self.rank(ids[rows, i], ids[rows, j])
            return np.where(found < NONE, found << bits | i, never)

        rows = np.flatnonzero(tree[:, 1] < never)
        while len(rows):
            top = tree[rows, 1]
            i = top & ((1 << bits) - 1)
            gone = after[rows, i]
            ids[rows, i] = top >> bits
            live[rows, gone] = False
            right = after[rows, gone]
            after[rows, i] = right
            put(rows, gone, never)
            some = right < sizes[rows]
            r, ri, rr = rows[some], i[some], right[some]
            before[r, rr] = ri
            values = np.full(len(rows), never, np.int64)
            values[some] = pair(r, ri, rr)
            put(rows, i, values)
            left = before[rows, i]
            some = left >= 0
            if some.any():
                put(rows[some], left[some], pair(rows[some], left[some], i[some]))
            rows = rows[tree[rows, 1] < never]
        return ids[live], live.sum(1)

    def encode_pieces(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of distinct pieces: (first id, number of ids, all ids). A piece that is a token is that token."""
        whole = np.fromiter((self.ids.get(p, -1) for p in pieces), np.int64, len(pieces))
        sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
        starts, lengths = np.arange(len(pieces)), np.ones(len(pieces), np.int64)
        flat, held = [whole], len(pieces)

        def put(members: np.ndarray, ids: np.ndarray, counts: np.ndarray) -> None:
            nonlocal held
            starts[members] = held + np.cumsum(counts) - counts
            lengths[members] = counts
            flat.append(ids)
            held += len(ids)

        for k in np.flatnonzero((whole < 0) & (sizes > TOGETHER_BYTES)).tolist():
            ids = self.encode_piece(pieces[k])
            put(np.array([k]), np.array(ids), np.array([len(ids)]))
        leaves, least = 2, 1
        while leaves <= TOGETHER_BYTES:
            members = np.flatnonzero((whole < 0) & (sizes > least) & (sizes <= leaves))
            step = max(1, (1 << 19) // leaves)
            for part in (members[a : a + step] for a in range(0, len(members), step)):
                put(part, *self.encode_together([pieces[k] for k in part.tolist()], leaves))
            leaves, least = 2 * leaves, leaves
        return starts, lengths, np.concatenate(flat)

    def learn(self, chunks: list[str]) -> np.ndarray:
        """Places of the chunks in the memory, after adding those that are new."""
        if len(self.chunks) > REMEMBERED or len(self.chunk_ids) > 8 * REMEMBERED:
            self.forget()
        new = [c for c in chunks if c not in self.chunks]
        if new:
            split = [self.pattern.findall(c) for c in new]
            pieces = list(itertools.chain.from_iterable(split))
            distinct = dict.fromkeys(pieces)
            distinct = dict(zip(distinct, range(len(distinct))))
            starts, lengths, flat = self.encode_pieces([p.encode() for p in distinct])
            at = np.fromiter(map(distinct.__getitem__, pieces), np.int64, len(pieces))
            ids = flat[B.ragged(starts[at], lengths[at])]
            edges = np.concatenate([[0], np.cumsum(np.fromiter(map(len, split), np.int64, len(split)))])
            counts = B.sums_by_row(lengths[at], edges)
            self.chunks.update(zip(new, range(len(self.chunks), len(self.chunks) + len(new))))
            self.chunk_lengths = np.concatenate([self.chunk_lengths, counts])
            self.chunk_starts = np.concatenate([self.chunk_starts, len(self.chunk_ids) + np.cumsum(counts) - counts])
            self.chunk_ids = np.concatenate([self.chunk_ids, ids.astype(np.uint32)])
        return np.fromiter(map(self.chunks.__getitem__, chunks), np.int64, len(chunks))

    def encode_block(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts of a block, one after another, and the number of each."""
        heads = chunk_heads(data, offsets)
        for row in odd_rows(data, offsets).tolist():  # white space beyond ASCII: cut by the pattern itself
            a, b = int(offsets[row]), int(offsets[row + 1])
            heads[a:b] = False
            sizes = [len(m.encode()) for m in self.pattern.findall(data[a:b].tobytes().decode())]
            heads[a + np.cumsum([0, *sizes[:-1]])] = True
        starts = np.flatnonzero(heads)
        chunks = B.span_strings(data, starts, np.append(starts[1:], len(data))).dictionary_encode()
        place = self.learn(chunks.dictionary.to_pylist())[np.asarray(chunks.indices)]
        lengths = self.chunk_lengths[place]
        ids = self.chunk_ids[B.ragged(self.chunk_starts[place], lengths)]
        return ids, B.sums_by_row(lengths, np.searchsorted(starts, offsets))

    def decode_block(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of the ids, one after another, and the number of each."""
        lengths = self.lengths[ids]
        return self.bytes[B.ragged(self.starts[ids], lengths)], lengths


ODD_SPACES = [(0xC2, 0x85), (0xC2, 0xA0), (0xE1, 0x9A), (0xE2, 0x80), (0xE2, 0x81), (0xE3, 0x80)]


LETTER = np.zeros(256, bool)
LETTER[65:91] = LETTER[97:123] = True


def chunk_heads(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """True where a chunk of text starts: no match of the pattern reaches over such a place, if all white space is
    ASCII. A word takes the blank before it; of the white space before a word the last character stands apart."""
    n = len(data)
    begins = np.zeros(n + 1, bool)
    begins[offsets] = True
    heads = begins[:-1].copy()
    if n == 0:
        return heads
    word = B.SPACED[data]
    new_kind = np.ones(n, bool)
    new_kind[1:] = word[1:] != word[:-1]
    new_kind |= heads
    heads |= new_kind & ~word
    after = np.flatnonzero(new_kind & word & ~begins[:-1])
    heads[after - 1] = True
    heads[after] = data[after - 1] != 32
    letter = LETTER[data]
    heads[1:] |= letter[:-1] & ~letter[1:] & word[1:] & (data[1:] < 128)  # a run of letters ends there in any case
    return heads


def odd_rows(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Rows that may hold white space beyond ASCII."""
    at = np.flatnonzero(data[:-1] >= 0xC2) if len(data) else np.zeros(0, np.int64)
    at = at[np.isin(data[at].astype(np.int32) << 8 | data[at + 1], [a << 8 | b for a, b in ODD_SPACES])]
    return np.unique(np.searchsorted(offsets, at, "right") - 1)


@cache
def ranks_of(rank_lines: bytes, pattern: str) -> Ranks:
    return Ranks(rank_lines, pattern)


def digests(ranks: Ranks, column: pa.Array) -> pa.Array:
    counts, id_hashes, text_hashes = [], [], []
    for _, data, offsets in B.blocks(column, BLOCK):
        ids, sizes = ranks.encode_block(data, offsets)
        text, lengths = ranks.decode_block(ids)
        ends = np.cumsum(sizes)
        cut = np.concatenate([[0], np.cumsum(lengths)])[np.concatenate([[0], ends])].tolist()
        raw, text = memoryview(ids.astype("<u4").tobytes()), memoryview(np.ascontiguousarray(text))
        counts.append(sizes)
        edges = [0, *(4 * ends).tolist()]
        id_hashes += [hashlib.sha256(raw[a:b]).hexdigest() for a, b in zip(edges, edges[1:])]
        text_hashes += [hashlib.sha256(text[a:b]).hexdigest() for a, b in zip(cut, cut[1:])]
    return pa.StructArray.from_arrays(
        [pa.array(np.concatenate(counts) if counts else [], pa.int64()), pa.array(id_hashes, pa.string()), pa.array(text_hashes, pa.string())],
        ["n_tokens", "ids_sha256", "decoded_sha256"],
    )


class Tokenizer:
    """Columns of ids and of decoded texts by the vocabulary in ``rank_file`` (lines of base64 token and rank)."""

    def __init__(self, spark: SparkSession, rank_file: str | None = None, pattern: str | None = None):
        import public_tokenizers

        with open(rank_file or public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as file:
            lines = file.read()
        self.vocabulary = spark.sparkContext.broadcast((lines, pattern or public_tokenizers.PATTERN))  # under 1 MB

    def encode(self, text: F.Column) -> F.Column:
        """Ids as array<int>; a null or empty text has none. Lossless for every text."""
        vocabulary = self.vocabulary

        @F.arrow_udf("array<int>")
        def run(column: pa.Array) -> pa.Array:
            ranks, out = ranks_of(*vocabulary.value), []
            for _, data, offsets in B.blocks(column, BLOCK):
                ids, sizes = ranks.encode_block(data, offsets)
                out.append(B.list_array(ids.astype(np.int32), sizes))
            return pa.concat_arrays(out) if out else pa.array([], pa.list_(pa.int32()))

        return run(text)

    def decode(self, ids: F.Column) -> F.Column:
        """Bytes of the ids (binary): ids may end within a character. Null ids give no bytes."""
        vocabulary = self.vocabulary

        @F.arrow_udf("binary")
        def run(column: pa.Array) -> pa.Array:
            ranks = ranks_of(*vocabulary.value)
            return pa.array([ranks.decode_block(np.asarray(x or [], np.int64))[0].tobytes() for x in column.to_pylist()], pa.binary())

        return run(ids)

    def digests(self, text: F.Column) -> F.Column:
        """Struct of n_tokens and the SHA-256 of ids (little-endian unsigned 32-bit) and of their decoded bytes."""
        vocabulary = self.vocabulary

        @F.arrow_udf(RESULT)
        def run(column: pa.Array) -> pa.Array:
            return digests(ranks_of(*vocabulary.value), column)

        return run(text)


def encode_documents(docs: DataFrame, text_col: str = "text", into: str = "tokens", rank_file: str | None = None) -> DataFrame:
    """``docs`` with the struct column ``into`` (see ``Tokenizer.digests``). Each text is encoded and its ids decoded again
    in one narrow pass: no shuffle, and no state beyond the vocabulary and the chunks a worker remembers.

    Null and empty texts have no ids; repeated rows give equal results; a word of any length is one tree."""
    return docs.withColumn(into, Tokenizer(docs.sparkSession, rank_file).digests(F.col(text_col)))
