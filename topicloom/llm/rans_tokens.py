"""Token ids as binary blocks of a static range asymmetric numeral system.

One frequency table, from the counts of all texts, serves all blocks. A block holds whole documents in ascending order; its
ids go round LANES coder states, so that one numpy step codes an id of each. Blocks are independent, carry checkpoints
(all states and the place in the words) from which decoding can start, and checksums."""

from __future__ import annotations

import itertools
import json
import re
import struct
import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from topicloom.llm import textbytes as B
from topicloom.llm.staging import folder, stage

SCALE = 18  # frequencies add up to 2^SCALE
LANES = 4096
BLOCK_IDS = 1 << 20  # a block ends with the document that reaches so many ids
CHECK_STEPS = 128  # a checkpoint every so many steps
LOW = np.uint64(1 << 31)  # least coder state
MAGIC = b"TRNS"
HEAD = struct.Struct("<4sIIIIII")  # magic, ids, lanes, checkpoints, words, checksum of the ids, checksum of what follows
REMEMBERED = 600_000
TEXT_BYTES = 2 << 20  # texts are encoded in runs of about so many bytes; each looks its different parts up once
END_ID = 2


class Table:
    """Quantised frequencies of the ids that occur: at least 1 each, in sum 2^SCALE."""

    def __init__(self, counts: np.ndarray, scale: int = SCALE):
        total, kinds = int(counts.sum()), int((counts > 0).sum())
        if kinds > 1 << scale:
            raise ValueError(f"{kinds} different ids need a larger scale than {scale}")
        self.scale = scale
        room = 1 << scale
        freq = np.zeros(len(counts), np.int64)
        used = np.flatnonzero(counts)
        if total:
            freq[used] = np.maximum(1, (counts[used].astype(np.float64) / total * room).astype(np.int64))
            excess = int(freq.sum()) - room
            if excess < 0:
                freq[used[np.argmax(counts[used])]] -= excess
            elif excess > 0:  # take from all in proportion to what they hold above 1, the rest from the largest
                freq -= (freq - 1) * (freq > 0) * excess // int((freq[used] - 1).sum())
                rest = int(freq.sum()) - room
                freq[np.argsort(-freq, kind="stable")[:rest]] -= 1
        self.freq = freq.astype(np.uint64)
        self.below = (np.cumsum(freq) - freq).astype(np.uint64)
        self.id_of = np.repeat(np.arange(len(freq), dtype=np.uint32), freq)

    def encode(self, ids: np.ndarray) -> bytes:
        n = len(ids)
        lanes = max(1, min(LANES, n // 64))
        steps = -(-n // lanes)
        freq, below = self.freq[ids], self.below[ids]
        if n and not freq.all():
            raise ValueError("an id is not in the frequency table")
        bits, mask = np.uint64(self.scale), np.uint64(0xFFFFFFFF)
        most = (LOW >> bits) << np.uint64(32)
        state = np.full(lanes, LOW)
        words: list[np.ndarray] = []
        points: list[tuple[np.ndarray, int]] = []
        written = 0
        for t in range(steps - 1, -1, -1):
            a, b = t * lanes, min(n, (t + 1) * lanes)
            f, x = freq[a:b], state[: b - a]
            over = x >= most * f
            if over.any():
                words.append((x[over] & mask).astype(np.uint32))
                written += len(words[-1])
                x = np.where(over, x >> np.uint64(32), x)
            q, r = np.divmod(x, f)
            state[: b - a] = (q << bits) + r + below[a:b]
            if t % CHECK_STEPS == 0:
                points.append((state.copy(), written))
        body = np.concatenate(words[::-1]) if words else np.zeros(0, np.uint32)
        points = [(s, written - w) for s, w in points[::-1]]
        tail = b"".join(struct.pack("<I", w) + s.astype("<u8").tobytes() for s, w in points) + body.astype("<u4").tobytes()
        head = HEAD.pack(MAGIC, n, lanes, len(points), len(body), zlib.crc32(ids.astype("<u4").tobytes()), zlib.crc32(tail))
        return head + tail

    def decode(self, block: bytes, start: int = 0) -> np.ndarray:
        """The ids from checkpoint ``start`` on. Raises ValueError if a checksum does not agree."""
        magic, n, lanes, count, size, ids_sum, tail_sum = HEAD.unpack_from(block)
        if magic != MAGIC or zlib.crc32(memoryview(block)[HEAD.size :]) != tail_sum:
            raise ValueError("damaged block")
        if not n:
            return np.zeros(0, np.uint32)
        each = 4 + 8 * lanes
        at = HEAD.size + start * each
        (place,) = struct.unpack_from("<I", block, at)
        state = np.frombuffer(block, "<u8", lanes, at + 4).astype(np.uint64)
        words = np.frombuffer(block, "<u4", size, HEAD.size + count * each).astype(np.uint64)
        first = start * CHECK_STEPS * lanes
        out = np.empty(n - first, np.uint32)
        bits, mask = np.uint64(self.scale), np.uint64((1 << self.scale) - 1)
        for a in range(first, n, lanes):
            b = min(n, a + lanes)
            x = state[: b - a]
            slot = x & mask
            ids = self.id_of[slot]
            out[a - first : b - first] = ids
            x = self.freq[ids] * (x >> bits) + slot - self.below[ids]
            under = np.flatnonzero(x < LOW)
            x[under] = x[under] << np.uint64(32) | words[place : place + len(under)]
            place += len(under)
            state[: b - a] = x
        if not start and zlib.crc32(out.astype("<u4").tobytes()) != ids_sum:
            raise ValueError("ids do not agree with their checksum")
        return out


# ASCII letters, digits and punctuation; 0 for what may join its neighbours: control characters, the apostrophe, beyond ASCII
KIND = np.zeros(256, np.uint8)
KIND[33:127] = 3
KIND[48:58] = 2
KIND[65:91] = KIND[97:123] = 1
KIND[39] = 0


# Lower-case letters that normalisation leaves as they are: a part of such letters alone is one word to the tokenizer.
LETTERS = r"\A[a-zß-öø-ÿα-ωа-я]+\z"
JOINED = 500  # so many words are encoded as one text
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"  # of the definition; a run of letters is one word


@cache
def added_tokens(definition: str) -> tuple[bytes, ...]:
    """The strings that the tokenizer cuts out of the raw text before anything else, longest first."""
    return tuple(sorted((t["content"].encode() for t in json.loads(definition)["added_tokens"]), key=len, reverse=True))


@cache
def any_of(strings: tuple[bytes, ...]) -> re.Pattern[bytes]:
    return re.compile(b"|".join(map(re.escape, strings)))


def bare(definition: str, tokenizer):
    """A tokenizer of the same model for words of LETTERS alone between spaces, which the normalizer leaves as they are and the pattern
    keeps whole: without both. Where the definition has other steps than these, the tokenizer itself."""
    from tokenizers import Tokenizer, pre_tokenizers

    steps = json.loads(definition)
    before, split = ((steps[k] or {}) for k in ("normalizer", "pre_tokenizer"))
    before = [before] if before.get("type") != "Sequence" else before["normalizers"]
    split = [split] if split.get("type") != "Sequence" else split["pretokenizers"]
    plain = all(k.get("type") in (None, "NFC", "Lowercase") or k.get("type") == "Replace" and k["pattern"] == {"Regex": "\\s+"} and k["content"] == " " for k in before)
    if not plain or len(split) != 2 or split[0].get("pattern") != {"Regex": WORDS} or not split[0]["invert"] or split[0]["behavior"] != "Removed":
        return tokenizer
    if split[1]["type"] != "ByteLevel" or split[1]["add_prefix_space"] or split[1]["use_regex"]:
        return tokenizer
    out = Tokenizer(tokenizer.model)
    out.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
    return out


def units(data: np.ndarray, offsets: np.ndarray, added: tuple[bytes, ...] = ()) -> tuple[pa.Array, np.ndarray]:
    """The texts in parts that the tokenizer never joins (it drops white space and parts letters, digits and other
    characters), and the first part of each row. A match of one of ``added`` is a part of its own."""
    raw = data.tobytes()
    found = np.array([m.span() for m in any_of(added).finditer(raw)] if any(t in raw for t in added) else [], np.int64).reshape(-1, 2)
    found = found[np.searchsorted(offsets, found[:, 0], "right") == np.searchsorted(offsets, found[:, 1] - 1, "right")]
    data = B.LOWER[data]
    w = B.Words(data, offsets, B.SPACED)
    heads = np.zeros(len(data), bool)
    heads[w.starts] = True
    kind = KIND[data]
    heads[1:] |= (kind[1:] != kind[:-1]) & (kind[1:] > 0) & (kind[:-1] > 0)
    heads[B.ragged(found[:, 0], found[:, 1] - found[:, 0])] = False
    heads[found[:, 0]] = True
    heads[found[found[:, 1] < len(data), 1]] = True
    starts = np.flatnonzero(heads & B.SPACED[data])
    ends = np.append(starts[1:], len(data))
    if len(w):
        ends = np.minimum(ends, w.ends[np.searchsorted(w.starts, starts, "right") - 1])
    places = np.concatenate([[0], np.cumsum(ends - starts)])
    body = data[B.SPACED[data]]  # the parts are all that is no white space
    return pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(places), pa.py_buffer(body)), np.searchsorted(starts, offsets)


class Encoder:
    def __init__(self, definition: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark gives a task one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(definition)
        self.bare = bare(definition, self.tokenizer)
        self.added = added_tokens(definition)
        self.size = self.tokenizer.get_vocab_size()
        suffix = json.loads(definition)["model"].get("end_of_word_suffix")
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values(), default=0) + 1, bool)  # ids that end a word
        self.ends[[i for token, i in vocabulary.items() if suffix and token.endswith(suffix)]] = True
        self.forget()

    def forget(self) -> None:
        self.places: dict[str, int] = {}
        self.starts = self.lengths = self.met = np.zeros(0, np.int32)
        self.ids = np.zeros(0, np.uint32)

    def thin(self) -> None:
        """Forget the parts that were met once; all, if the others are many too."""
        kept = np.flatnonzero(self.met > 1)
        lengths = self.lengths[kept].astype(np.int64)
        if len(kept) > REMEMBERED // 2 or lengths.sum() > 4 * REMEMBERED:
            return self.forget()
        parts = list(self.places)  # in the order of their places
        self.places = {parts[k]: place for place, k in enumerate(kept.tolist())}
        self.ids = self.ids[B.ragged(self.starts[kept], lengths)]
        self.starts, self.lengths = (np.cumsum(lengths) - lengths).astype(np.int32), self.lengths[kept]
        self.met = np.ones(len(kept), np.int32)

    def encode_each(self, texts: list[str], tokenizer=None) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the texts, one after another, and the number of each."""
        tokenizer = tokenizer or self.tokenizer
        found = [e.ids for a in range(0, len(texts), 8_000) for e in tokenizer.encode_batch_fast(texts[a : a + 8_000], add_special_tokens=False)]
        lengths = np.fromiter(map(len, found), np.int64, len(found))
        return np.fromiter(itertools.chain.from_iterable(found), np.uint32, int(lengths.sum())), lengths

    def encode_units(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """As encode_each; words of letters alone go many to a text, in which the last id of each word tells where it ends."""
        plain = pc.match_substring_regex(pa.array(parts, pa.large_string()), LETTERS).to_numpy(zero_copy_only=False).astype(bool)
        words, others = [p for p, k in zip(parts, plain) if k], [p for p, k in zip(parts, plain) if not k]
        ids, _ = self.encode_each([" ".join(words[a : a + JOINED]) for a in range(0, len(words), JOINED)], self.bare)
        last = np.flatnonzero(self.ends[ids])
        if len(last) != len(words) or len(ids) != (last[-1] + 1 if len(last) else 0):  # a tokenizer without ends of words
            return self.encode_each(parts)
        other_ids, other_lengths = self.encode_each(others)
        lengths, starts = np.empty(len(parts), np.int64), np.empty(len(parts), np.int64)
        lengths[plain], lengths[~plain] = np.diff(last, prepend=-1), other_lengths
        starts[plain] = last + 1 - lengths[plain]
        starts[~plain] = len(ids) + np.cumsum(other_lengths) - other_lengths
        return np.concatenate([ids, other_ids])[B.ragged(starts, lengths)], lengths

    def learn(self, parts: np.ndarray) -> np.ndarray:
        if len(self.places) > REMEMBERED or len(self.ids) > 8 * REMEMBERED:
            self.thin()
        place = np.fromiter(map(self.places.get, parts, itertools.repeat(-1)), np.int32, len(parts))
        at = np.flatnonzero(place < 0)
        if len(at):
            new = parts[at].tolist()
            ids, lengths = self.encode_units(new)
            place[at] = np.arange(len(self.places), len(self.places) + len(new))
            self.places.update(zip(new, place[at].tolist()))
            self.lengths = np.concatenate([self.lengths, lengths.astype(np.int32)])
            self.starts = np.concatenate([self.starts, (len(self.ids) + np.cumsum(lengths) - lengths).astype(np.int32)])
            self.ids = np.concatenate([self.ids, ids])
            self.met = np.concatenate([self.met, np.zeros(len(new), np.int32)])
        self.met[place] += 1
        return place

    def encode_block(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the texts, one after another, and the number of each."""
        parts, rows = units(data, offsets, self.added)
        parts = parts.dictionary_encode()
        kinds = self.learn(parts.dictionary.to_numpy(zero_copy_only=False))
        lengths = self.lengths[kinds].astype(np.int64)
        ids = self.ids[B.ragged(self.starts[kinds], lengths)]  # of the different parts
        place = np.asarray(parts.indices)
        counts = lengths[place]
        return ids[B.ragged((np.cumsum(lengths) - lengths)[place], counts)], B.sums_by_row(counts, rows)


@cache
def encoder(definition: str) -> Encoder:
    return Encoder(definition)


def read_definition(path: str | None) -> str:
    import public_tokenizers

    with open(path or public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as file:
        return file.read()


def encode_texts(docs: DataFrame, definition, end_id: int) -> DataFrame:
    """(doc_id, th, ids) of every row, staged: the ids of its text, the end included, as little-endian integers of 2 bytes, or of 4 where the
    vocabulary needs them; th is the hash of the text. Texts are tokenized here and nowhere else."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(definition.value)
        kind = id_type(own.size, end_id)
        for batch in batches:
            for first, data, offsets in B.blocks(batch.column(2), TEXT_BYTES):
                ids, counts = own.encode_block(data, offsets)
                n = len(counts)
                ids = np.insert(ids, np.cumsum(counts), end_id).astype(kind)
                edges = (np.concatenate([[0], np.cumsum(counts + 1)]) * kind.itemsize).astype(np.int32)
                column = pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(edges), pa.py_buffer(ids)])
                yield pa.record_batch([batch.column(0).slice(first, n), batch.column(1).slice(first, n), column], ["doc_id", "th", "ids"])

    keyed = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64("text").alias("th"), "text")
    return stage(keyed.mapInArrow(run, "doc_id bigint, th bigint, ids binary"))


def id_type(size: int, end_id: int) -> np.dtype:
    return np.dtype("<u2" if max(size, end_id + 1) <= 1 << 16 else "<u4")


def _ids(column: pa.Array, kind: np.dtype) -> tuple[np.ndarray, np.ndarray]:
    """All ids of a binary column, and the number of each row."""
    edges = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
    body = np.frombuffer(column.buffers()[2], np.uint8)[edges[0] : edges[-1]] if len(column) else np.zeros(0, np.uint8)
    return body.view(kind), np.diff(edges) // kind.itemsize


def count_ids(encoded: DataFrame, size: int, kind: np.dtype) -> np.ndarray:
    """How often each of the ids below ``size`` stands in the encoded texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for batch in batches:
            total += np.bincount(_ids(batch.column(0), kind)[0], minlength=size)
        used = np.flatnonzero(total)
        yield pa.record_batch([pa.array(used), pa.array(total[used])], ["id", "n"])

    counted = encoded.select("ids").mapInArrow(run, "id bigint, n bigint").groupBy("id").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(size, np.int64)
    out[counted["id"].to_numpy()] = counted["n"].to_numpy()
    return out


def write_blocks(docs: DataFrame, path: str, tokenizer_file: str | None = None, end_id: int = END_ID) -> Table:
    """Encode every text of ``docs`` (doc_id, text, ...) and write the blocks below ``path`` in ascending (doc_id, text hash)
    order, null ids first: rows (part, block, doc_ids, counts, payload), a part for each range of ids.

    A null or empty text is its end alone. Rows that repeat stay, one after another. Returns the frequency table, which a
    reader needs."""
    spark = docs.sparkSession
    definition = spark.sparkContext.broadcast(read_definition(tokenizer_file))
    size = max(encoder(definition.value).size, end_id + 1)
    kind = id_type(size, end_id)
    encoded = encode_texts(docs, definition, end_id)
    table = Table(count_ids(encoded, size, kind))
    known = spark.sparkContext.broadcast(table)

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, number = TaskContext.get().partitionId(), 0
        docs_held, counts_held, ids_held, held = [], [], [], 0

        def out() -> pa.RecordBatch:
            payload = known.value.encode(np.concatenate(ids_held).astype(np.uint32))
            return pa.record_batch([pa.array([part], pa.int32()), pa.array([number], pa.int32()), pa.array([docs_held], pa.list_(pa.int64())), pa.array([counts_held], pa.list_(pa.int64())), pa.array([payload], pa.binary())], ["part", "block", "doc_ids", "counts", "payload"])

        for batch in batches:
            names = batch.column(0).to_pylist()
            ids, counts = _ids(batch.column(1), kind)
            ends = np.cumsum(counts)
            first = 0
            while first < len(names):  # whole documents until the block is full
                before = int(ends[first - 1]) if first else 0
                last = min(len(names), int(np.searchsorted(ends, before + BLOCK_IDS - held)) + 1)
                docs_held += names[first:last]
                counts_held += counts[first:last].tolist()
                ids_held.append(ids[before : ends[last - 1]].copy())
                held += len(ids_held[-1])
                if held >= BLOCK_IDS:
                    yield out()
                    docs_held, counts_held, ids_held, held, number = [], [], [], 0, number + 1
                first = last
        if docs_held:
            yield out()

    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    ordered = encoded.repartitionByRange(parts, "doc_id", "th").sortWithinPartitions("doc_id", "th").select("doc_id", "ids")
    schema = "part int, block int, doc_ids array<bigint>, counts array<bigint>, payload binary"
    ordered.mapInArrow(blocks, schema).write.parquet(path)
    return table


def read_blocks(spark: SparkSession, path: str, table: Table) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document in the files of ``write_blocks``, from its decoded ids."""
    known = spark.sparkContext.broadcast(table)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                part, block, docs, counts, payload = (batch.column(k)[row].as_py() for k in range(5))
                raw = memoryview(known.value.decode(payload).astype("<u4").tobytes())
                edges = np.concatenate([[0], np.cumsum(counts)]).tolist()
                if len(raw) != 4 * edges[-1]:
                    raise ValueError("a block does not hold the ids of its documents")
                sums = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(edges, edges[1:])]
                n = len(docs)
                yield pa.record_batch(
                    [pa.array([part] * n, pa.int32()), pa.array([block] * n, pa.int32()), pa.array(range(n), pa.int32()), pa.array(docs, pa.int64()), pa.array(counts, pa.int64()), pa.array(sums, pa.int64())],
                    ["part", "block", "k", "doc_id", "n_tokens", "ids_crc32"],
                )

    schema = "part int, block int, k int, doc_id bigint, n_tokens bigint, ids_crc32 bigint"
    files = spark.read.parquet(path)
    docs = files.mapInArrow(run, schema)
    sizes = files.select("part", F.explode("counts").alias("n")).groupBy("part").agg(F.sum("n").alias("n"))
    before = sizes.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))  # a row for each part
    run_up = Window.partitionBy("part").orderBy("block", "k")
    placed = docs.withColumn("inside", F.sum("n_tokens").over(run_up) - F.col("n_tokens"))
    return placed.join(F.broadcast(before), "part").select("doc_id", (F.col("before") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32")


def round_trip(docs: DataFrame, tokenizer_file: str | None = None) -> DataFrame:
    """Write ``docs`` as blocks in the shared checkpoint folder and read them back."""
    path = folder(docs.sparkSession)
    table = write_blocks(docs, path, tokenizer_file)
    return read_blocks(docs.sparkSession, path, table)
