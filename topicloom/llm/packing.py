"""Hierarchical packing of token ids into windows of several sizes.

Full windows of the largest size are cut from long documents; what is left of each document is routed to the smallest tier that
holds it. Tiers are packed from the longest: a window takes one piece of its tier, its gap the longest pieces of shorter tiers that
fit, and what then remains of the gap a cut from the shortest piece that is longer. So windows are full. The last window of a task,
which nothing can fill, is halved into sizes that its ids do fill.

A task packs the documents it reads, some of them at a time, and hands the pieces of an unfinished window on to the next ones: no
id is shuffled, and a task holds CHUNK ids or one document. Windows of a size are then dealt round the steps of training, the costly
ones apart, so that steps differ by one window at most."""

from __future__ import annotations

import bisect
from collections import defaultdict
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from topicloom.llm import textbytes as B
from topicloom.llm.rans_tokens import encoder, read_definition
from topicloom.llm.staging import stage
from topicloom.runtime import BROADCAST_ROW_LIMIT

TIERS = (2048, 1024, 512, 256)
END_ID = 1
CHUNK = 2_000_000  # ids packed at a time
STEP_TOKENS = 1 << 18  # ids in the windows of a training step

# A piece: number of its document, ids of the document before it, length, place of its ids.
Piece = tuple[int, int, int, int]


class Pool:
    """Pieces by length."""

    def __init__(self) -> None:
        self.lengths: list[int] = []  # in use, ascending
        self.pieces: dict[int, list[Piece]] = defaultdict(list)

    def __len__(self) -> int:
        return len(self.lengths)

    def put(self, piece: Piece) -> None:
        held = self.pieces[piece[2]]
        if not held:
            bisect.insort(self.lengths, piece[2])
        held.append(piece)

    def take(self, length: int) -> Piece:
        held = self.pieces[length]
        piece = held.pop()
        if not held:
            del self.lengths[bisect.bisect_left(self.lengths, length)]
        return piece

    def longest(self, most: int) -> Piece | None:
        """The longest piece of at most ``most`` ids."""
        at = bisect.bisect_right(self.lengths, most)
        return self.take(self.lengths[at - 1]) if at else None

    def cut(self, length: int) -> Piece | None:
        """The first ``length`` ids of the shortest longer piece; its rest stays."""
        at = bisect.bisect_right(self.lengths, length)
        if at == len(self.lengths):
            return None
        doc, start, whole, place = self.take(self.lengths[at])
        self.put((doc, start + length, whole - length, place + length))
        return doc, start, length, place


def pack_pieces(pool: Pool, tiers: Sequence[int] = TIERS) -> tuple[list[tuple[int, list[Piece]]], list[Piece]]:
    """Full windows (size, pieces), and the pieces of the one window that was left unfinished."""
    windows: list[tuple[int, list[Piece]]] = []
    for size, shorter in zip(tiers, [*tiers[1:], 0]):
        while pool and pool.lengths[-1] > shorter:
            window = [pool.take(pool.lengths[-1])]
            gap = size - window[0][2]
            while gap:
                piece = pool.longest(gap) or pool.cut(gap)
                if piece is None:
                    return windows, window
                window.append(piece)
                gap -= piece[2]
            windows.append((size, window))
    return windows, []


def halve(pieces: list[Piece]) -> list[tuple[int, list[Piece]]]:
    """Windows of powers of two, largest first, that the pieces fill one after another."""
    left = sum(p[2] for p in pieces)
    waiting = pieces[::-1]
    windows = []
    while left:
        size = gap = 1 << left.bit_length() - 1
        window = []
        while gap:
            doc, start, length, place = waiting.pop()
            if length > gap:
                waiting.append((doc, start + gap, length - gap, place + gap))
                length = gap
            window.append((doc, start, length, place))
            gap -= length
        windows.append((size, window))
        left -= size
    return windows


class Packer:
    """Takes documents one after another and gives record batches of windows."""

    def __init__(self, tiers: Sequence[int]):
        self.tiers = tiers
        self.counts: dict[int, int] = defaultdict(int)
        self.clear()

    def clear(self) -> None:
        self.names: list[int | None] = []
        self.sizes: list[int] = []
        self.ids: list[np.ndarray] = []
        self.held = 0
        self.pool = Pool()
        self.full: list[tuple[int, list[Piece]]] = []

    def add(self, name: int | None, ids: np.ndarray) -> None:
        doc, place, top = len(self.names), self.held, self.tiers[0]
        self.names.append(name)
        self.sizes.append(len(ids))
        self.ids.append(ids)
        self.held += len(ids)
        whole = len(ids) // top * top
        self.full += [(top, [(doc, a, top, place + a)]) for a in range(0, whole, top)]
        if whole < len(ids):
            self.pool.put((doc, whole, len(ids) - whole, place + whole))

    def flush(self, last: bool) -> Iterator[pa.RecordBatch]:
        windows, rest = pack_pieces(self.pool, self.tiers)
        windows += self.full
        if last:
            windows += halve(rest)
        body = np.concatenate(self.ids) if self.ids else np.zeros(0, np.uint32)
        names, sizes = self.names, self.sizes
        if windows:
            # of each size, the windows of much attention first: dealing them round evens it out
            windows.sort(key=lambda w: (-w[0], -sum(p[2] ** 2 for p in w[1])))
            for a in range(0, len(windows), 1000):
                yield self._rows(windows[a : a + 1000], body, names, sizes)
        self.clear()
        if not last:
            for doc, start, length, place in rest:
                self.pool.put((len(self.names), start, length, self.held))
                self.names.append(names[doc])
                self.sizes.append(sizes[doc])
                self.ids.append(body[place : place + length])
                self.held += length

    def _rows(self, windows: list[tuple[int, list[Piece]]], body: np.ndarray, names: list, sizes: list[int]) -> pa.RecordBatch:
        flat = np.array([p for _, pieces in windows for p in pieces], np.int64)
        doc, start, length, place = flat.T
        per = np.array([len(pieces) for _, pieces in windows])
        total = np.array([size for size, _ in windows], np.int64)
        before = np.cumsum(length) - length
        offset = before - np.repeat(np.cumsum(total) - total, per)
        ids = body[B.ragged(place, length)].astype("<u4")
        edges = np.append(0, np.cumsum(4 * total)).astype(np.int32)
        pieces = pa.StructArray.from_arrays(
            [pa.array([names[d] for d in doc.tolist()], pa.int64()), pa.array(start), pa.array(length), pa.array(offset), pa.array(np.array(sizes, np.int64)[doc])],
            ["doc_id", "start", "length", "offset", "doc_tokens"],
        )
        numbers = []
        for size, _ in windows:
            numbers.append(self.counts[size])
            self.counts[size] += 1
        return pa.record_batch(
            [
                pa.array(total, pa.int32()),
                pa.array(numbers, pa.int64()),
                pa.Array.from_buffers(pa.binary(), len(total), [None, pa.py_buffer(edges), pa.py_buffer(ids)]),
                B.list_array(pieces, per),
            ],
            ["size", "number", "ids", "pieces"],
        )


PIECES = "array<struct<doc_id:bigint,start:bigint,length:bigint,offset:bigint,doc_tokens:bigint>>"


def pack(
    docs: DataFrame,
    tiers: Sequence[int] = TIERS,
    end_id: int = END_ID,
    tokenizer_file: str | None = None,
    chunk: int = CHUNK,
    step_tokens: int = STEP_TOKENS,
) -> DataFrame:
    """Windows (sequence_id, step, size, ids, pieces) of all texts of ``docs`` (doc_id, text, ...): ``ids`` as little-endian 32-bit integers, ``pieces`` in
    their order with the document's id, the ids of the document before the piece, its length, its offset in the window and
    the length of its document, end included.

    ``tiers`` are powers of two in descending order; a window has one of these sizes, or is one of the smaller powers that close a
    task. A null or empty text is its end alone. Rows that repeat a doc_id are packed as documents of their own. ``step`` numbers the
    steps, each of windows of one size: as many as the ids of the size need at ``step_tokens`` a step."""
    if list(tiers) != sorted(set(tiers), reverse=True) or any(t < 1 or t & (t - 1) for t in tiers):
        raise ValueError("tiers are different powers of two, the largest first")
    spark = docs.sparkSession
    definition = spark.sparkContext.broadcast(read_definition(tokenizer_file))
    tiers = tuple(tiers)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, packer = encoder(definition.value), Packer(tiers)
        for batch in batches:
            names = batch.column(0).to_pylist()
            for first, data, offsets in B.blocks(batch.column(1)):
                ids, counts = own.encode_block(data, offsets)
                edges = np.concatenate([[0], np.cumsum(counts)])
                for k in range(len(counts)):
                    packer.add(names[first + k], np.append(ids[edges[k] : edges[k + 1]], np.uint32(end_id)))
                    if packer.held >= chunk:
                        yield from packer.flush(last=False)
        yield from packer.flush(last=True)

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    windows = stage(rows.mapInArrow(run, f"size int, number bigint, ids binary, pieces {PIECES}").withColumn("task", F.spark_partition_id()))
    # one row for each task and size
    made = windows.groupBy("size", "task").agg(F.count(F.lit(1)).alias("n"))
    run_up = Window.partitionBy("size").orderBy("task")
    placed = made.select("size", "task", (F.sum("n").over(run_up) - F.col("n")).alias("before"), F.sum("n").over(Window.partitionBy("size")).alias("total"))
    steps = F.ceil(F.col("total") * F.col("size") / F.lit(step_tokens))
    placed = stage(placed.withColumn("steps", steps.cast("bigint")))
    shift = {r["size"]: r for r in placed.select("size", "total", "steps").distinct().collect()}  # a row for each size
    base, seen = [], (0, 0)
    for size in sorted(shift, reverse=True):
        base.append((size, *seen))
        seen = seen[0] + shift[size]["total"], seen[1] + shift[size]["steps"]
    bases = spark.createDataFrame(base, "size int, first_window bigint, first_step bigint")
    placed = placed.join(F.broadcast(bases), "size")
    if placed.count() <= BROADCAST_ROW_LIMIT:
        placed = F.broadcast(placed)
    number = F.col("before") + F.col("number")
    return windows.join(placed, ["size", "task"]).select(
        (F.col("first_window") + number).alias("sequence_id"),
        (F.col("first_step") + number % F.col("steps")).alias("step"),
        "size",
        "ids",
        "pieces",
    )


def pieces(windows: DataFrame) -> DataFrame:
    """One row for each piece of the windows of ``pack``, with the checksum of its ids."""
    p = F.col("p")
    ids = F.substring(F.col("ids"), (4 * p["offset"] + 1).cast("int"), (4 * p["length"]).cast("int"))
    return windows.select("sequence_id", "step", "size", "ids", F.explode("pieces").alias("p")).select(
        p["doc_id"].alias("doc_id"),
        p["start"].alias("start"),
        p["length"].alias("length"),
        F.crc32(ids).alias("ids_crc32"),
        p["doc_tokens"].alias("doc_tokens"),
        "sequence_id",
        p["offset"].alias("offset"),
        F.col("size").alias("window"),
        "step",
    )
