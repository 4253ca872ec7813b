"""Repeated passages by a sparse suffix array. Of every PASSAGE consecutive words the suffix at the least K-gram is retained,
so equal passages retain the same suffix whatever stands around them. Passages that retain the same place are a run; equal
runs are folded, the others sorted by (K-gram, run), and neighbours there that share the K-gram are extended to the left
and right: all their passages are compared. Later copies of a passage are removed."""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from topicloom.llm import textbytes as B
from topicloom.llm.neighbours import sorted_neighbours
from topicloom.llm.staging import stage

PASSAGE = 50
K = 12
# K-grams whose runs are to be extended are sent to the tasks in slices of so many (8 bytes each).
SLICE = 4_000_000
SPAN = "array<struct<start:int,end:int>>"
RESULT = f"n_words bigint, own {SPAN}, runs array<struct<gram:bigint,run:bigint,start:int,passages:int>>"
NO_ID = -(1 << 63)


def run_hashes(h: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of runs of words, equal for equal runs of any length."""
    up, down = B._grow(len(h) + 1)
    sums = np.zeros(len(h) + 1, np.uint64)
    np.cumsum(h * up[: len(h)], out=sums[1:])
    return B.mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def least_of(values: np.ndarray, width: int) -> np.ndarray:
    """Place of the least of ``width`` consecutive values (the first of equal ones), for each first place."""
    at = np.arange(len(values))
    span = 1
    while span < width:
        step = min(span, width - span)
        a, b = at[: len(at) - step], at[step:]
        at = np.where(values[b] < values[a], b, a)
        span += step
    return at


class Block:
    """Passages of a block of texts: ``at`` (first word), ``keep`` (first word of the retained suffix)."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, passage: int = PASSAGE, k: int = K):
        data = B.LOWER[data]
        self.words = B.Words(data, offsets, B.SPACED)
        self.h = self.words.hashes()
        self.passage = passage
        grams = B.gram_hashes(self.h, k)
        self.grams = grams
        self.at = np.flatnonzero(B.gram_starts(self.words.rows, passage))
        self.keep = least_of(grams, passage - k + 1)[self.at] if len(self.at) else self.at
        self.row = np.searchsorted(self.words.rows, self.at, "right") - 1
        first = np.ones(len(self.at), bool)
        first[1:] = (self.keep[1:] != self.keep[:-1]) | (self.row[1:] != self.row[:-1])
        self.run_first = np.flatnonzero(first)
        self.run_size = np.diff(np.append(self.run_first, len(self.at)))

    def hashes(self, which: np.ndarray) -> np.ndarray:
        return run_hashes(self.h, self.at[which], self.at[which] + self.passage)

    def inside(self, which: np.ndarray) -> np.ndarray:
        """Word number of passages within their texts."""
        return (self.at[which] - self.words.rows[self.row[which]]).astype(np.int32)


def spans_of(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Merge the spans of one text that overlap or touch; starts ascending."""
    if not len(starts):
        return starts, ends
    reach = np.maximum.accumulate(ends)
    first = np.append(True, starts[1:] > reach[:-1])
    last = np.append(np.flatnonzero(first)[1:] - 1, len(starts) - 1)
    return starts[first], reach[last]


def _lists(starts: list[np.ndarray], ends: list[np.ndarray]) -> pa.Array:
    flat = [pa.array(np.concatenate(x).astype(np.int32) if x else np.zeros(0, np.int32)) for x in (starts, ends)]
    return B.list_array(pa.StructArray.from_arrays(flat, ["start", "end"]), np.array([len(x) for x in starts]))


def describe(column: pa.Array) -> pa.Array:
    counts, own, runs = [], [], []
    for _, data, offsets in B.blocks(column):
        b = Block(data, offsets)
        every = np.arange(len(b.at))
        named = b.hashes(every) ^ B.mix(b.row.astype(np.uint64))
        ordered = np.sort(named)
        twice = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
        again = every[np.isin(named, twice)] if len(twice) else every[:0]
        _, first = np.unique(named[again], return_index=True)
        later = np.delete(again, first)
        place, edges = b.inside(later), np.searchsorted(b.row[later], np.arange(len(offsets)))
        merged = [spans_of(place[x:y], place[x:y] + PASSAGE) for x, y in zip(edges[:-1], edges[1:])]
        own.append(_lists([m[0] for m in merged], [m[1] for m in merged]))
        counts.append(b.words.counts)
        f = b.run_first
        whole = run_hashes(b.h, b.at[f], b.at[f] + b.run_size + PASSAGE - 1)
        flat = pa.StructArray.from_arrays(
            [pa.array(b.grams[b.keep[f]].view(np.int64)), pa.array(whole.view(np.int64)), pa.array(b.inside(f)), pa.array(b.run_size.astype(np.int32))],
            ["gram", "run", "start", "passages"],
        )
        runs.append(B.list_array(flat, np.bincount(b.row[f], minlength=len(offsets) - 1)))
    if not counts:
        span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
        run = pa.list_(pa.struct([("gram", pa.int64()), ("run", pa.int64()), ("start", pa.int32()), ("passages", pa.int32())]))
        return pa.array([], pa.struct([("n_words", pa.int64()), ("own", span), ("runs", run)]))
    return pa.StructArray.from_arrays([pa.array(np.concatenate(counts), pa.int64()), pa.concat_arrays(own), pa.concat_arrays(runs)], ["n_words", "own", "runs"])


def passages(docs: DataFrame, grams: np.ndarray) -> DataFrame:
    """(doc_id, th, hash, start): the passages, each once in a text, that retain one of the sorted ``grams``."""
    wanted = docs.sparkSession.sparkContext.broadcast(grams)

    @F.arrow_udf("array<struct<hash:bigint,start:int>>")
    def run(column: pa.Array) -> pa.Array:
        out, known = [], wanted.value
        for _, data, offsets in B.blocks(column):
            b = Block(data, offsets)
            g = b.grams[b.keep[b.run_first]]
            if not len(known):  # a slice without grams
                g = g[:0]
            at = np.searchsorted(known, g)
            at[at == len(known)] = 0
            hit = np.flatnonzero(np.repeat(known[at] == g, b.run_size if len(known) else b.run_size[:0]))
            h = b.hashes(hit)
            _, once = np.unique(h ^ B.mix(b.row[hit].astype(np.uint64)), return_index=True)
            once.sort()
            hit, h = hit[once], h[once]
            flat = pa.StructArray.from_arrays([pa.array(h.view(np.int64)), pa.array(b.inside(hit))], ["hash", "start"])
            out.append(B.list_array(flat, np.bincount(b.row[hit], minlength=len(offsets) - 1)))
        kind = pa.list_(pa.struct([("hash", pa.int64()), ("start", pa.int32())]))
        return pa.concat_arrays(out) if out else pa.array([], kind)

    return docs.select("doc_id", "th", F.explode(run(F.col("text"))).alias("p")).select("doc_id", "th", "p.*")


def later(rows: DataFrame, key: list[str]) -> DataFrame:
    """The rows whose key stands in a document of lesser id as well. Keys are counted first; the counts are staged, so that
    adaptive execution can split the rows of a common key in the join."""
    first = rows.groupBy(*key).agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("n"))
    return rows.join(stage(first.filter("n > 1").drop("n")), key).filter("doc_id != first")


def find_repeats(docs: DataFrame) -> DataFrame:
    """(doc_id, th, n_words, spans) for every row of ``docs`` (doc_id, text, ...): spans (first word, word after the last) of
    the words that lie in a passage of PASSAGE words that stands earlier in the same text or in a document of lesser id.

    Words are [^\\x20\\x09-\\x0D]+, A-Z lower-cased; passages are told by 64-bit hashes of all their words. th is the hash of
    the text. A null or empty text, and any of fewer than PASSAGE words, has no span. A row without doc_id comes before all
    others. Rows that repeat a doc_id are one document: they are not held against each other."""
    keyed = docs.select(F.coalesce(F.col("doc_id").cast("bigint"), F.lit(NO_ID)).alias("doc_id"), F.xxhash64("text").alias("th"), "text")
    run = F.arrow_udf(describe, RESULT)
    texts = stage(keyed.select("doc_id", "th", run(F.col("text")).alias("d")).select("doc_id", "th", "d.*"))
    runs = texts.select("doc_id", "th", F.explode("runs").alias("r")).select("doc_id", "th", "r.*")
    kinds = runs.groupBy("gram", "run").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("n"))
    kinds = stage(kinds)
    copies = runs.join(kinds.filter("n > 1").select("gram", "run", "first"), ["gram", "run"]).filter("doc_id != first")
    found = [copies.select("doc_id", "th", "start", (F.col("start") + F.col("passages") + PASSAGE - 1).alias("end"))]
    beside = sorted_neighbours(kinds.select("gram", "run"), ["gram", "run"])
    shared = stage(beside.filter(F.col("earlier")[0]["gram"] == F.col("gram")).select("gram").distinct())
    slices = -(-shared.count() // SLICE)
    for s in range(slices):
        part = shared.filter(F.pmod(F.xxhash64("gram"), F.lit(slices)) == s).toArrow()["gram"].to_numpy()
        each = passages(keyed, np.sort(part.view(np.uint64)))
        found.append(later(each, ["hash"]).select("doc_id", "th", "start", (F.col("start") + PASSAGE).alias("end")))
    found.append(texts.select("doc_id", "th", F.explode("own").alias("o")).select("doc_id", "th", "o.*"))
    spans = reduce(DataFrame.unionByName, found).groupBy("doc_id", "th").agg(F.sort_array(F.collect_set(F.struct("start", "end"))).alias("all"))

    @F.arrow_udf(SPAN)
    def merged(column: pa.Array) -> pa.Array:
        flat, edges = column.flatten(), np.cumsum([0, *(len(x) if x.is_valid else 0 for x in column)])
        starts, ends = flat.field("start").to_numpy(), flat.field("end").to_numpy()
        parts = [spans_of(starts[a:b], ends[a:b]) for a, b in zip(edges[:-1], edges[1:])]
        return _lists([p[0] for p in parts], [p[1] for p in parts])

    both = texts.select("doc_id", "th", "n_words").join(spans, ["doc_id", "th"], "left")
    none = F.array().cast(SPAN)
    return both.select(F.nullif("doc_id", F.lit(NO_ID)).alias("doc_id"), "th", "n_words", merged(F.coalesce("all", none)).alias("spans"))


def remove_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` with the words of ``find_repeats`` cut out of ``text``, up to the next word that stays; all rows and columns
    remain. Rows that repeat id and text are cut alike."""
    found = find_repeats(docs).dropDuplicates(["doc_id", "th"]).filter(F.size("spans") > 0)
    found = found.select(F.col("doc_id").alias("__d"), F.col("th").alias("__t"), F.col("spans").alias("__s"))

    @F.arrow_udf("string")
    def cut(column: pa.Array, spans: pa.Array) -> pa.Array:
        out, row, every = [], 0, spans.to_pylist()
        for _, data, offsets in B.blocks(column):
            w = B.Words(data, offsets, B.SPACED)
            for k in range(len(offsets) - 1):
                stop = int(offsets[k + 1])
                a, parts = int(offsets[k]), []
                for s in every[row + k] or []:
                    start, end = int(w.rows[k]) + s["start"], int(w.rows[k]) + s["end"]
                    parts.append(data[a : w.starts[start]].tobytes())
                    a = int(w.starts[end]) if end < w.rows[k + 1] else stop
                out.append(b"".join([*parts, data[a:stop].tobytes()]).decode())
            row += len(offsets) - 1
        return pa.array(out, pa.string())

    keyed = docs.withColumn("__h", F.xxhash64("text"))
    both = keyed.join(found, keyed["doc_id"].eqNullSafe(found["__d"]) & (keyed["__h"] == found["__t"]), "left")
    text = F.when(F.col("__s").isNull(), F.col("text")).otherwise(cut(F.col("text"), F.col("__s")))
    return both.withColumn("text", text).select(docs.columns)
