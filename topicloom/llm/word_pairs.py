"""Modified Kneser-Ney probabilities of the words of every text given the word before, learned from all other texts.

Words are lower-cased (A-Z); they and their pairs are told by hashes of BITS bits; an edge stands before and after a text. No count is cut and the model
never lies in one place: each chunk of texts sends its different pairs as sorted hash arrays, cut at ranges of the hashes; the
task of a range adds them up and sends each chunk the totals in the order of its own array. So do the words, with the totals,
continuation counts and numbers of successors that the chunks draw from the pairs."""

from __future__ import annotations

import ctypes
import itertools
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import RDD
from pyspark.sql import DataFrame

from topicloom.llm import textbytes as B

BITS = 52
CHUNK_BYTES = 16 << 20  # texts of a partition are worked on in runs of about so many characters
PIECE = 1 << 20  # of which so many are held as texts, the others as hashes; a piece ends with the text that reaches it
RUN = 30_000  # and scored in runs of about so many words
RANGES = 4  # ranges of hashes for each partition of the texts
EDGE = np.uint64(0xE0D0E0D0E0D0E)
REST = np.uint64(64 - BITS)
Z = pa.Codec("zstd")


def pack(values: np.ndarray) -> bytes:
    """Whole numbers from 0 on as planes of their bytes, as many as the largest needs, each compressed if that makes it smaller."""
    width = max(1, (int(values.max()).bit_length() + 7) // 8) if len(values) else 1
    out = [len(values).to_bytes(8, "little"), bytes([width])]
    for plane in np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T) if len(values) else ():
        body = Z.compress(plane, asbytes=True)
        body = body if len(body) < len(plane) else plane.tobytes()
        out += [len(body).to_bytes(4, "little"), body]
    return b"".join(out)


def unpack(data: bytes) -> np.ndarray:
    n, width, at = int.from_bytes(data[:8], "little"), data[8], 9
    out = np.zeros((n, 8), np.uint8)
    for k in range(width if n else 0):
        size = int.from_bytes(data[at : at + 4], "little")
        body = data[at + 4 : at + 4 + size]
        out[:, k] = np.frombuffer(body if size == n else Z.decompress(body, n, asbytes=True), np.uint8)
        at += 4 + size
    return out.reshape(-1).view("<u8")


def give_back() -> None:
    """Free memory goes back to the system: a worker process stays for later tasks while others run beside it."""
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of glibc
    if trim:
        trim(0)


def steps(values: np.ndarray, width: int) -> list[bytes]:
    return [pack(values[:, k]) for k in range(width)]


def numbered(values: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different ones of sorted ``values`` and, by ``place``, which of them each entry is."""
    new = np.ones(len(values), bool)
    np.not_equal(values[1:], values[:-1], out=new[1:])
    at = np.empty(len(values), np.int32)
    at[place] = np.cumsum(new, dtype=np.int32) - np.int32(1)
    return values[new], at


def distinct(values: np.ndarray, bound: int) -> tuple[np.ndarray, np.ndarray]:
    """The different values in ascending order and the place of each entry among them; ``values`` are whole numbers below
    ``bound``. They are sorted with their places in the same 64 bits, where both fit. ``values`` may be used up."""
    n = len(values)
    low = n.bit_length()
    if bound.bit_length() + low > 64:
        kinds, at = np.unique(values, return_inverse=True)
        return kinds.astype(np.int64), at.astype(np.int32)
    packed = values.view(np.uint64)
    packed <<= np.uint64(low)
    packed |= np.arange(n, dtype=np.uint64)
    packed.sort()
    place = (packed & np.uint64((1 << low) - 1)).astype(np.int32)
    packed >>= np.uint64(low)
    return numbered(packed.view(np.int64), place)


def ascending(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place, hash) of hashes in ascending order: sorted by as many of their first bits as fit beside the places."""
    low = np.uint64(len(keys).bit_length())
    packed = keys << REST
    packed >>= low
    packed <<= low
    packed |= np.arange(len(keys), dtype=np.uint64)
    packed.sort()
    packed &= (np.uint64(1) << low) - np.uint64(1)
    place = packed.astype(np.int32)
    del packed
    found = keys[place]
    if (found[1:] < found[:-1]).any():
        place = np.argsort(keys, kind="stable").astype(np.int32)
        found = keys[place]
    return place, found


def hashed(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of the words of the texts, an edge after each text, and the number of both of each."""
    hashes, sizes = [], []
    for _, data, offsets in B.blocks(pa.array(texts, pa.large_string())):
        data = B.LOWER[data]
        w = B.Words(data, offsets, B.SPACED)
        h = np.full(len(w) + len(w.counts), EDGE, np.uint64)
        h[np.arange(len(w)) + w.row_of()] = w.hashes() >> REST
        hashes.append(h)
        sizes.append(w.counts + 1)
    return np.concatenate(hashes), np.concatenate(sizes)


class Chunk:
    """The word pairs of a run of texts: ``words`` are sorted hashes, ``first`` and ``second`` the places in ``words`` of each pair,
    in ascending order, ``n`` its count or, if ``in_order``, ``pair`` the pairs of the texts one after another, ``sizes`` of them
    each. ``keys`` are the sorted hashes of the pairs, ``order`` the pair of each."""

    def __init__(self, hashes: list[np.ndarray], sizes: list[np.ndarray], in_order: bool):
        seen, self.sizes = np.concatenate(hashes), np.concatenate(sizes)
        hashes.clear()
        place, found = ascending(seen)
        del seen
        self.words, at = numbered(found, place)
        del place, found
        many = len(self.words)
        code = np.empty(len(at), np.int64)
        code[1:] = at[:-1]
        code[0] = at[-1]  # the edge after a text is the one before the next; before the first stands that after the last
        code *= many
        code += at
        del at
        if in_order:
            codes, self.pair = distinct(code, many * many)
        else:
            codes, self.n = np.unique(code, return_counts=True)
        del code
        first = codes // many
        codes -= first * many
        self.first, self.second = first.astype(np.int32), codes.astype(np.int32)
        del first, codes
        keys = B.mix(self.words)[self.first]
        keys *= B.GRAM
        keys += self.words[self.second]
        keys = B.mix(keys)
        keys >>= REST
        self.order, self.keys = ascending(keys)

    def by_pair(self, answer: np.ndarray) -> np.ndarray:
        """What was answered to ``keys``, one for each pair."""
        out = np.empty_like(answer)
        out[self.order] = answer
        return out

    def runs(self) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
        """Texts a..b-1 of about RUN words, as (a, b, row, pair, own): their different pairs and how often they stand there."""
        ends = np.cumsum(self.sizes)
        a = 0
        while a < len(ends):
            start = int(ends[a] - self.sizes[a])
            b = max(a + 1, int(np.searchsorted(ends, start + RUN, "right")))
            place = np.repeat(np.arange(b - a), self.sizes[a:b]) * len(self.keys) + self.pair[start : ends[b - 1]]
            place, own = np.unique(place, return_counts=True)
            yield a, b, place // len(self.keys), place % len(self.keys), own
            a = b


def sent(keys: np.ndarray, values: np.ndarray, chunk: tuple[int, int, int], ranges: int) -> Iterator[tuple]:
    """A row for each range of hashes that the sorted ``keys`` reach; ``chunk``: its partition, number there and number of texts."""
    bounds = [(r << BITS) // ranges for r in range(1, ranges)]
    cuts = [0, *np.searchsorted(keys, np.array(bounds, np.uint64)).tolist(), len(keys)]
    for r, (a, b) in enumerate(zip(cuts, cuts[1:])):
        if b > a:
            yield r, (chunk, int(keys[a]), pack(np.diff(keys[a:b])), steps(values[a:b], values.shape[1]))


class Range:
    """What all chunks sent of one range: the different keys and the sums of their values."""

    def __init__(self, rows: list[tuple]):
        self.rows = sorted((row for _, row in rows), key=lambda row: row[0])  # the same whatever order they came in
        parts = []
        for _, least, gaps, _ in self.rows:
            gaps = unpack(gaps)
            parts.append(np.uint64(least) + np.concatenate([np.zeros(1, np.uint64), np.cumsum(gaps, dtype=np.uint64)]))
        self.edges = np.cumsum([0, *map(len, parts)])
        self.keys, self.first, self.at = np.unique(np.concatenate(parts), return_index=True, return_inverse=True)
        values = [np.concatenate([unpack(row[3][k]) for row in self.rows]) for k in range(len(self.rows[0][3]))]
        self.sums = np.stack([np.bincount(self.at, v.astype(np.float64), len(self.keys)) for v in values], 1).astype(np.int64)

    def answers(self, owners: bool) -> Iterator[tuple]:
        """The sums in the order of each chunk's own keys; with ``owners`` twice as much, and 1 more for the one chunk that counts a key."""
        owner = np.zeros(len(self.at), np.int64)
        owner[self.first] = 1
        for (chunk, *_), a, b in zip(self.rows, self.edges, self.edges[1:]):
            values = self.sums[self.at[a:b]]
            if owners:
                values = 2 * values + owner[a:b, None]
            yield chunk[0], (chunk[1:], int(self.keys[self.at[a]]), steps(values, values.shape[1]))


def answers(asked: RDD, parts: int, name: str) -> RDD:
    """The sums, in rows of the partition of the texts that asked."""

    def add(rows: Iterator[tuple]) -> Iterator[tuple]:
        rows = list(rows)
        if rows:
            for part, row in Range(rows).answers(name == "pairs"):
                yield part, (name, *row)
        del rows
        give_back()

    return asked.mapPartitions(add).partitionBy(parts)


def gathered(answers: RDD, *names: str) -> RDD:
    """An entry for each text of a partition: at the first of a chunk what was answered to it, packed, else None."""

    def gather(rows: Iterator[tuple]) -> Iterator[list | None]:
        found: dict[tuple, list] = {}
        for _, (name, chunk, least, values) in rows:
            found.setdefault((chunk, name), []).append((least, values))
        for chunk in sorted({chunk for chunk, _ in found}):
            yield [[v for _, v in sorted(found.pop((chunk, name)), key=lambda x: x[0])] for name in names]
            yield from (None for _ in range(chunk[1] - 1))

    return answers.mapPartitions(gather)


def begun(rows: Iterator, column: int) -> Iterator[tuple]:
    """Each row with the number of its chunk, of about CHUNK_BYTES of text, where one begins, else None."""
    number, size = -1, CHUNK_BYTES
    for row in rows:
        new = size >= CHUNK_BYTES
        if new:
            number, size = number + 1, 0
        yield row, number if new else None
        size += len(row[column] or "")


def taken(rows: Iterator[tuple], column: int, keep: Callable[[list], list] | None = None) -> Iterator[tuple]:
    """(what stands at its first row, Chunk, what ``keep`` makes of its rows, a list for each piece of them) of every chunk, from
    rows beside None but where a chunk begins. Without ``keep`` the order of the pairs is not kept either."""
    mark, held, size, hashes, sizes, kept = None, [], 0, [], [], []

    def take() -> None:
        if held:
            for whole, part in zip((hashes, sizes), hashed([row[column] for row in held])):
                whole.append(part)
            if keep:
                kept.append(keep(held))
            held.clear()

    for row, new in rows:
        if new is not None:
            take()
            if sizes:
                yield mark, Chunk(hashes, sizes, keep is not None), kept
            mark, size, hashes, sizes, kept = new, 0, [], [], []
        held.append(tuple(row))
        size += len(row[column] or "")
        if size >= PIECE:
            take()
            size = 0
    take()
    if sizes:
        yield mark, Chunk(hashes, sizes, keep is not None), kept


def whole(answer: list[tuple], width: int) -> np.ndarray:
    """The packed answers to the ranges of a chunk as rows of ``width`` numbers."""
    return np.concatenate([np.column_stack([unpack(v).view(np.int64) for v in values]) for values in answer]) if answer else np.zeros((0, width), np.int64)


def beside(left: RDD, right: RDD) -> RDD:
    """Zip; the side of fewer partitions gets empty ones."""
    sides = [left, right]
    most = max(r.getNumPartitions() for r in sides)
    sides = [r if r.getNumPartitions() == most else r.context.union([r, r.context.parallelize([], most - r.getNumPartitions())]) for r in sides]
    return sides[0].zip(sides[1])


def kind(n: np.ndarray) -> np.ndarray:
    return np.minimum(n, 3)


OFTEN = np.array([1, 2, 3, 1, 0])  # how often a word stands before another, from what ``successors`` counts


def by_kind(at: np.ndarray, n: np.ndarray, many: int) -> np.ndarray:
    """For each of ``many``: how many of its numbers are 0, 1, 2 and more."""
    return np.bincount(at * np.int64(4) + kind(n), minlength=4 * many).reshape(-1, 4)


def successors(c: Chunk, answer: np.ndarray) -> np.ndarray:
    """For each word of the chunk: its different successors found once, twice and more often, what these last are found more than
    three times, and the different words before it. ``answer``, of each pair: twice its total, and 1 more in the chunk that owns
    it, in which alone the pair counts."""
    owner = answer & 1 == 1
    many = len(c.words)
    first, total = c.first[owner], answer[owner] >> 1
    out = np.zeros((many, 5), np.int64)
    out[:, :3] = by_kind(first, total, many)[:, 1:]
    out[:, 3] = np.bincount(first, np.maximum(total - 3, 0), many)
    out[:, 4] = np.bincount(c.second[owner], minlength=many)
    return out


def counted(n: np.ndarray) -> np.ndarray:
    """How many are 1, 2, 3, 4; how many 3 or more; how many from 1 on; their sum."""
    return np.array([*((n == k).sum() for k in (1, 2, 3, 4)), (n > 2).sum(), (n > 0).sum(), n.sum()], np.int64)


def discounts(of: np.ndarray) -> np.ndarray:
    """What is taken from counts of 0, 1, 2 and more."""
    y = of[0] / (of[0] + 2 * of[1]) if of[0] + of[1] else 0.0
    return np.array([0.0, *(min(max(i - (i + 1) * y * of[i] / of[i - 1], 0.0), float(i)) if of[i - 1] else 0.5 * i for i in (1, 2, 3))])


def log_losses(c: Chunk, total: np.ndarray, words: np.ndarray, pairs: np.ndarray, single: np.ndarray) -> np.ndarray:
    """Mean negative log probability of the words and the end of each text. ``total``: of each pair; ``words``: what ``successors``
    counts, of each word over all texts; ``pairs``, ``single``: ``counted`` of the totals and of the continuation counts.
    A text's own occurrences are taken out of every count; the discounts are those of all texts."""
    many = len(c.words)
    take, take_single = discounts(pairs), discounts(single)
    lone = 1.0 / (single[5] + 1)  # one word more than there are
    out = np.empty(len(c.sizes))
    for a, b, row, pair, own in c.runs():
        rows = b - a
        v, w = c.first[pair], c.second[pair]
        all_, left = total[pair], total[pair] - own
        at_row, at = distinct(row * many + w, rows * many)  # words of a text
        before = words[at_row % many, 4]
        after = before - np.bincount(at, left == 0, len(at_row)).astype(np.int64)
        of_row = at_row // many
        sums = single[6] - np.bincount(row, left == 0, rows)  # different pairs without the text's own
        free = np.zeros(rows)
        gone, come = by_kind(of_row, before, rows), by_kind(of_row, after, rows)
        for k, n in ((1, single[0]), (2, single[1]), (3, single[4])):
            free += take_single[k] * (n - gone[:, k] + come[:, k])
        some = np.maximum(sums, 1)
        low = np.where(sums[of_row] > 0, (after - take_single[kind(after)] + np.maximum(free, 1e-12)[of_row] * lone) / some[of_row], lone)[at]
        context = row * many + v  # contexts of a text, in ascending order as the pairs are
        new = np.ones(len(context), bool)
        np.not_equal(context[1:], context[:-1], out=new[1:])
        at = np.cumsum(new) - 1
        known = words[v[new]]
        sums = known @ OFTEN - np.bincount(at, own, len(known))
        free = np.zeros(len(known))
        gone, come = by_kind(at, all_, len(known)), by_kind(at, left, len(known))
        for k in (1, 2, 3):
            free += take[k] * (known[:, k - 1] - gone[:, k] + come[:, k])
        some = np.maximum(sums, 1)
        p = np.where(sums[at] > 0, (left - take[kind(left)] + np.maximum(free, 1e-12)[at] * low) / some[at], low)
        out[a:b] = -np.bincount(row, own * np.log(p), rows) / c.sizes[a:b]
    return out


def with_losses(docs: DataFrame, text_col: str = "text", keep: Callable[[list], list] = list) -> RDD:
    """(what ``keep`` makes of its rows, a list, log loss of each) for every chunk of ``docs``; ``keep`` gets a piece of them at a
    time. The partitions of ``docs`` must hold the same rows in the same order whenever they are read, as those of files do; a chunk
    whose pairs do not fit its answer is an error."""
    texts = docs.rdd
    column = docs.columns.index(text_col)
    parts = max(1, texts.getNumPartitions())
    ranges = RANGES * parts

    def ask_pairs(part: int, held: Iterator) -> Iterator[tuple]:
        for j, c, _ in taken(begun(held, column), column):
            yield from sent(c.keys, c.n[c.order, None], (part, j, len(c.sizes)), ranges)
            del c  # before the next chunk is read
            give_back()

    def ask_words(part: int, held: Iterator[tuple]) -> Iterator[tuple]:
        for j, ((answer,), c, _) in enumerate(taken(held, column)):
            answer = whole(answer, 1)[:, 0]
            if len(answer) != len(c.keys):
                raise ValueError("the texts of a partition have changed while they were read")
            answer = c.by_pair(answer)
            values = successors(c, answer)
            yield from sent(c.words, values, (part, j, len(c.sizes)), ranges)
            yield 0, (counted(answer[answer & 1 == 1] >> 1),)
            del c, answer, values
            give_back()

    def count(rows: Iterator[tuple]) -> Iterator[tuple]:
        rows = list(rows)
        pairs = sum((r[1][0] for r in rows if len(r[1]) == 1), np.zeros(7, np.int64))
        rows = [r for r in rows if len(r[1]) > 1]
        yield pairs, (counted(Range(rows).sums[:, 4]) if rows else np.zeros(7, np.int64))

    pairs_of = answers(texts.mapPartitionsWithIndex(ask_pairs).partitionBy(ranges), parts, "pairs")
    words_asked = beside(texts, gathered(pairs_of, "pairs")).mapPartitionsWithIndex(ask_words).partitionBy(ranges)
    pairs, single = words_asked.mapPartitions(count).treeReduce(lambda a, b: (a[0] + b[0], a[1] + b[1]))
    words_of = answers(words_asked.filter(lambda r: len(r[1]) > 1), parts, "words")
    both = gathered(pairs_of.union(words_of), "pairs", "words")  # dealt alike, so nothing moves again

    def losses(held: Iterator[tuple]) -> Iterator[tuple]:
        for (total, words), c, kept in taken(held, column, keep):
            total, words = whole(total, 1)[:, 0] >> 1, whole(words, 5)
            if len(total) != len(c.keys) or len(words) != len(c.words):
                raise ValueError("the texts of a partition have changed while they were read")
            found = log_losses(c, c.by_pair(total), words, pairs, single)
            del c, total, words
            yield list(itertools.chain.from_iterable(kept)), found
            del kept
            give_back()

    return beside(texts, both).mapPartitions(losses)
