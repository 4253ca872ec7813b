"""Ranked lexical search over hashed max-sketches.

The index holds a sketch of each document: every term is hashed to one of WIDTH coordinates, and a coordinate keeps the largest
term frequency that fell on it. Impacts grow with the frequency, so the impact of a coordinate's maximum is the maximum of
its impacts, whatever the corpus statistics turn out to be. For a batch of items one matrix product looks all coordinates up
and gives an upper bound of every score. Documents are then scored exactly in descending order of their bounds until no
bound reaches the k-th best score of the item.

Each task keeps its own k best of every item and sends no more than these; the last ranking is over them. Items go in batches
of bounded size, each read against the whole index."""

from __future__ import annotations

import bisect
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from topicloom.llm import textbytes as B
from topicloom.llm.staging import folder, stage

WIDTH = 4096
K = 10
BATCH_ITEMS = 500
BATCH_TERMS = 200_000
ROWS = 256  # documents whose bounds are computed at a time
UNIT = 1_000_000_000
MOST = 1_000_000  # no impact is larger

VECTOR = "n bigint, terms binary, counts binary"


def term_vectors(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """For runs of rows: (first row, row of each term, hash of each different term of a row in order, its count)."""
    for first, data, offsets in B.blocks(column):
        w = B.Words(B.LOWER[data], offsets, B.ALNUM)
        row, h = w.row_of(), w.hashes()
        order = np.lexsort((h, row))
        row, h = row[order], h[order]
        new = np.ones(len(h), bool)
        new[1:] = (row[1:] != row[:-1]) | (h[1:] != h[:-1])
        at = np.flatnonzero(new)
        yield first, row[at], h[at], np.diff(np.append(at, len(h)))


def _binary(values: np.ndarray, edges: np.ndarray) -> pa.Array:
    """One binary value for the run of each row."""
    offsets = (edges * values.itemsize).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(edges) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(values))])


def _vectors(names: pa.Array, texts: pa.Array, width: int | None) -> Iterator[pa.RecordBatch]:
    for first, row, h, count in term_vectors(texts):
        last = first + (int(row[-1]) + 1 if len(row) else 0)
        edges = np.searchsorted(row, np.arange(last - first + 1))
        sums = B.sums_by_row(count, edges)
        some = np.flatnonzero(sums)
        if not len(some):
            continue
        edges = np.append(edges[some], len(row))
        columns = [names.slice(first).take(pa.array(some)), pa.array(sums[some], pa.int64()), _binary(h, edges), _binary(count.astype("<u4"), edges)]
        if width:
            spot = (h % np.uint64(width)).astype(np.int64)
            cell = row * width + spot
            order = np.argsort(cell, kind="stable")
            cell, peak = cell[order], count[order]
            at = np.flatnonzero(np.append(True, cell[1:] != cell[:-1]))
            peak = np.minimum(np.maximum.reduceat(peak, at), 255).astype(np.uint8)
            rows = np.searchsorted(cell[at] // width, some)
            edges = np.append(rows, len(at))
            columns += [_binary((cell[at] % width).astype("<u2"), edges), _binary(peak, edges)]
        yield pa.record_batch(columns, ["id", "n", "terms", "counts", "spots", "peaks"][: len(columns)])


def build_index(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """(id, n, terms, counts, spots, peaks) of each row of ``docs`` (doc_id, text, ...) that holds a term, staged: sorted 64-bit
    term hashes with their counts, and the sketch: the coordinates in use and their largest counts, 255 standing for any
    larger one. A null or empty text has no term. Rows that repeat a doc_id are documents of their own."""
    if not 0 < width <= 1 << 16:
        raise ValueError("width is from 1 to 65536")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from _vectors(batch.column(0), batch.column(1), width)

    rows = docs.select(F.col("doc_id").cast("bigint").alias("id"), "text")
    return stage(rows.mapInArrow(run, f"id bigint, {VECTOR}, spots binary, peaks binary"))


def impact(count, m):
    return UNIT * count // (1000 * count + 8 * m)


class Batch:
    """Some items, their terms and weights."""

    def __init__(self, rows: list, width: int):
        self.rows = [r.row for r in rows]
        self.terms = [np.frombuffer(r.terms, np.uint64) for r in rows]
        self.repeats = [np.frombuffer(r.counts, "<u4").astype(np.int64) for r in rows]
        self.width = width
        self.known = np.unique(np.concatenate(self.terms))

    def weigh(self, documents: int, found: dict[int, int]) -> None:
        weights = np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * found.get(int(t), 0) + 1))) for t in self.known], np.int64)
        self.weights = [weights[np.searchsorted(self.known, t)] * q for t, q in zip(self.terms, self.repeats)]

    def table(self) -> np.ndarray:
        """Summed weights by coordinate and item."""
        out = np.zeros((self.width, len(self.rows)))
        for j, (t, w) in enumerate(zip(self.terms, self.weights)):
            np.add.at(out[:, j], (t % np.uint64(self.width)).astype(np.int64), w)
        return out


def document_frequencies(index: DataFrame, known: np.ndarray) -> dict[int, int]:
    """How many documents hold each of the sorted term hashes ``known``. Tasks send one row for each term they met."""
    wanted = index.sparkSession.sparkContext.broadcast(known)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = wanted.value
        total = np.zeros(len(known) + 1, np.int64)
        for batch in batches:
            for column in _pieces(batch.column(0)):
                at = np.searchsorted(known, column)
                at[known[np.minimum(at, len(known) - 1)] != column] = len(known)
                total += np.bincount(at, minlength=len(total))
        used = np.flatnonzero(total[:-1])
        yield pa.record_batch([pa.array(known[used].astype(np.int64)), pa.array(total[used])], ["term", "n"])

    counted = index.select("terms").mapInArrow(run, "term bigint, n bigint").groupBy("term").agg(F.sum("n").alias("n")).collect()
    wanted.unpersist()
    return {r.term & (1 << 64) - 1: r.n for r in counted}


def _values(column: pa.Array, kind) -> tuple[np.ndarray, np.ndarray]:
    """All values of a binary column, and the first value of each row."""
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    size = np.dtype(kind).itemsize
    body = column.buffers()[2]
    values = np.frombuffer(body, np.uint8)[offsets[0] : offsets[-1]].view(kind) if body is not None else np.zeros(0, kind)
    return values, (offsets - offsets[0]) // size


def _pieces(column: pa.Array, rows: int = ROWS) -> Iterator[np.ndarray]:
    for first in range(0, len(column), rows):
        yield _values(column.slice(first, rows), np.uint64)[0]


class Ranking:
    """The k best documents of each item so far, as sorted (-score, has an id, id)."""

    def __init__(self, batch: Batch, documents: int, length: int, k: int):
        self.batch, self.documents, self.length, self.k = batch, documents, length, k
        self.table = batch.table()
        self.best: list[list[tuple[int, bool, int]]] = [[] for _ in batch.rows]
        self.floor = np.ones(len(batch.rows))  # a score has to reach this
        self.scored = 0

    def add(self, ids: list, n: list[int], terms: pa.Array, counts: pa.Array, spots: pa.Array, peaks: pa.Array) -> None:
        m = np.array([25 + 75 * int(v) * self.documents // self.length for v in n], np.int64)
        place, edges = _values(spots, "<u2")
        peak = _values(peaks, np.uint8)[0].astype(np.int64)
        row = np.repeat(np.arange(len(m)), np.diff(edges))
        dense = np.zeros((len(m), self.batch.width))
        dense[row, place] = np.where(peak == 255, MOST, impact(peak, m[row]))
        bounds = dense @ self.table
        bounds *= 1 + 1e-9  # rounding never lowers a bound below its score
        hash_of, edges = _values(terms, np.uint64)
        count_of = _values(counts, "<u4")[0]
        for j in np.flatnonzero((bounds >= self.floor).any(axis=0)):
            best, column = self.best[j], bounds[:, j]
            own, weights = self.batch.terms[j], self.batch.weights[j]
            rows = np.flatnonzero(column >= self.floor[j])
            for r in rows[np.argsort(-column[rows], kind="stable")]:
                if len(best) == self.k and column[r] < -best[-1][0]:
                    break
                held = hash_of[edges[r] : edges[r + 1]]
                at = np.minimum(np.searchsorted(held, own), len(held) - 1)
                common = np.flatnonzero(held[at] == own)
                tf = count_of[edges[r] + at[common]].astype(np.int64)
                score = int((weights[common] * impact(tf, m[r])).sum())
                self.scored += 1
                key = (-score, ids[r] is not None, ids[r] or 0)
                if score > 0 and (len(best) < self.k or key < best[-1]):
                    bisect.insort(best, key)
                    del best[self.k :]
            if len(best) == self.k:
                self.floor[j] = -best[-1][0]

    def rows(self) -> pa.RecordBatch:
        flat = [(self.batch.rows[j], i if known else None, -s) for j, best in enumerate(self.best) for s, known, i in best]
        columns = list(zip(*flat)) or [[], [], []]
        return pa.record_batch([pa.array(c, pa.int64()) for c in columns], ["row", "doc_id", "score"])


def search(index: DataFrame, items: DataFrame, k: int = K, width: int = WIDTH, batch_items: int = BATCH_ITEMS, batch_terms: int = BATCH_TERMS) -> DataFrame:
    """(item_id, rank, doc_id, score): the k documents of highest score above 0 for each row of ``items`` (item_id, text, ...);
    equal scores by ascending doc_id, a missing one first. ``index`` is from ``build_index`` with the same width.

    An item without a term has no row; rows that repeat an item each have their ranking. A batch holds about ``batch_items`` items
    or ``batch_terms`` terms, whichever is less, and one item at least."""
    spark = index.sparkSession

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from _vectors(batch.column(0), batch.column(1), None)

    numbered = items.select(F.monotonically_increasing_id().alias("row"), "item_id", "text")
    own = stage(numbered)
    vectors = stage(own.select(F.col("row").alias("id"), "text").mapInArrow(run, f"id bigint, {VECTOR}").withColumnRenamed("id", "row"))
    size = vectors.agg(F.count(F.lit(1)).alias("items"), F.coalesce(F.sum(F.octet_length("terms")), F.lit(0)).alias("bytes")).first()
    whole = index.agg(F.count(F.lit(1)).alias("documents"), F.coalesce(F.sum("n"), F.lit(0)).alias("length")).first()
    empty = spark.createDataFrame([], "row bigint, doc_id bigint, score bigint")
    path = folder(spark)
    empty.write.parquet(path)
    parts = max(-(-size["items"] // batch_items), -(-size["bytes"] // (8 * batch_terms)))
    # the ids number the rows of each task: dealt round, so that batches are even
    turn = F.pmod(F.col("row").bitwiseAND((1 << 33) - 1) + F.shiftright("row", 33), F.lit(max(parts, 1)))
    for part in range(parts if whole["documents"] else 0):
        rows = vectors.filter(turn == part).select("row", "terms", "counts").collect()
        if not rows:
            continue
        batch = Batch(rows, width)
        batch.weigh(whole["documents"], document_frequencies(index, batch.known))
        _rank(index, batch, whole["documents"], whole["length"], k).write.mode("append").parquet(path)
    best = spark.read.schema(empty.schema).parquet(path)
    rank = F.row_number().over(Window.partitionBy("row").orderBy(F.desc("score"), F.asc_nulls_first("doc_id")))
    ranked = best.withColumn("rank", rank).filter(F.col("rank") <= k)
    return ranked.join(own.select("row", "item_id"), "row").select("item_id", "rank", "doc_id", "score")


def _rank(index: DataFrame, batch: Batch, documents: int, length: int, k: int) -> DataFrame:
    shared = index.sparkSession.sparkContext.broadcast(batch)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranking = Ranking(shared.value, documents, length, k)
        for held in batches:
            for first in range(0, held.num_rows, ROWS):
                part = held.slice(first, ROWS)
                ranking.add(part.column(0).to_pylist(), part.column(1).to_pylist(), *(part.column(c) for c in range(2, 6)))
        yield ranking.rows()

    return index.select("id", "n", "terms", "counts", "spots", "peaks").mapInArrow(run, "row bigint, doc_id bigint, score bigint")
