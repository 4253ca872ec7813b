"""Benchmark decontamination: normalised word windows of the test items are matched against all windows of the texts."""

from __future__ import annotations

import hashlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from topicloom.llm import textbytes as B

# Up to so many item windows are sent to all tasks (a window has WINDOW words and is kept as text, about 100 bytes).
BROADCAST_WINDOWS = 500_000
WINDOW = 10
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
RESULT = "n_words bigint, n_hit bigint, items array<string>, spans array<struct<start:int,end:int>>"
ASCII_UPPER, ASCII_LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words(text: Column) -> Column:
    """Lower-cased (A-Z) words as an array; null has none."""
    found = F.regexp_extract_all(F.translate(text, ASCII_UPPER, ASCII_LOWER), F.lit(WORD), F.lit(0))
    return F.coalesce(found, F.array().cast("array<string>"))


def item_windows(items: DataFrame, window: int = WINDOW, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """Distinct windows (size, window, item): ``window`` consecutive words, or all words of a shorter item. Items
    without words or id have none."""
    listed = items.select(F.col(id_col).cast("string").alias("item"), words(F.col(text_col)).alias("w"))
    listed = listed.filter("item IS NOT NULL AND size(w) > 0").withColumn("size", F.least(F.size("w"), F.lit(window)))
    at = F.explode(F.sequence(F.lit(1), F.size("w") - F.col("size") + 1)).alias("at")
    each = listed.select("item", "size", "w", at)
    return each.select("size", F.array_join(F.slice("w", F.col("at"), F.col("size")), " ").alias("window"), "item").distinct()


class HashSet:
    """Item windows by size: sorted 64-bit hashes, a bit table before them, and the windows as text to verify hits."""

    def __init__(self, rows: list[tuple[int, str, str]]):
        self.sizes: dict[int, tuple] = {}
        by_size: dict[int, dict[bytes, list[str]]] = defaultdict(lambda: defaultdict(list))
        for size, window, item in rows:
            by_size[size][window.encode()].append(item)
        for size, found in by_size.items():
            texts = sorted(found)
            body = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
            ends = np.flatnonzero(body == 10)
            offsets = np.concatenate([[0], ends + 1])
            w = B.Words(body, offsets, B.ALNUM)
            g = B.gram_hashes(w.hashes(), size)[w.rows[:-1]]
            order = np.argsort(g, kind="stable")
            bits = np.zeros(1 << 20, bool)
            bits[(g >> B.U64(44)).astype(np.int64)] = True
            self.sizes[size] = (g[order], bits, [texts[k] for k in order], [sorted(found[texts[k]]) for k in order])

    def scan(self, column: pa.Array) -> pa.Array:
        counts, hits, items, spans = [], [], [], []
        for _, data, offsets in B.blocks(column):
            data = B.LOWER[data]
            w = B.Words(data, offsets, B.ALNUM)
            h = w.hashes()
            hit = np.zeros(len(w) + 1, np.int32)
            names: dict[int, set[str]] = defaultdict(set)
            for size, (keys, bits, texts, owners) in self.sizes.items():
                g = B.gram_hashes(h, size)
                at = np.flatnonzero(bits[(g >> B.U64(44)).astype(np.int64)] & B.gram_starts(w.rows, size))
                found = np.searchsorted(keys, g[at])
                found[found == len(keys)] = 0
                same = keys[found] == g[at]
                at, found = at[same], found[same]
                rows = np.searchsorted(w.rows, at, "right") - 1
                for p, k, row in zip(at.tolist(), found.tolist(), rows.tolist()):
                    text = b" ".join(data[w.starts[i] : w.ends[i]].tobytes() for i in range(p, p + size))
                    while k < len(keys) and keys[k] == g[p]:  # equal hashes stand together
                        if texts[k] == text:
                            hit[p] += 1
                            hit[p + size] -= 1
                            names[row].update(owners[k])
                        k += 1
            covered = np.cumsum(hit[:-1]) > 0
            counts.append(w.counts)
            hits.append(B.sums_by_row(covered.astype(np.int64), w.rows))
            items += [sorted(names[r]) if r in names else [] for r in range(len(offsets) - 1)]
            spans.append(_spans(covered, w, data, offsets))
        if not counts:
            return pa.array([], _arrow_type())
        return pa.StructArray.from_arrays(
            [pa.array(np.concatenate(counts)), pa.array(np.concatenate(hits)), pa.array(items, pa.list_(pa.string())), pa.concat_arrays(spans)],
            ["n_words", "n_hit", "items", "spans"],
        )


def _spans(covered: np.ndarray, w: B.Words, data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """Runs of covered words as character ranges of each row."""
    opens = covered & ~np.concatenate([[False], covered[:-1]])
    shuts = covered & ~np.concatenate([covered[1:], [False]])
    inner = w.rows[1:-1]  # a run ends with its row
    inner = inner[(inner > 0) & (inner < len(covered))]
    opens[inner] |= covered[inner]
    shuts[inner - 1] |= covered[inner - 1]
    first, last = np.flatnonzero(opens), np.flatnonzero(shuts)
    row = np.searchsorted(w.rows, first, "right") - 1
    chars = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])  # bytes that continue a character do not count
    ends = [pa.array((chars[x] - chars[offsets[row]]).astype(np.int32)) for x in (w.starts[first], w.ends[last])]
    return B.list_array(pa.StructArray.from_arrays(ends, ["start", "end"]), np.bincount(row, minlength=len(offsets) - 1))


def _arrow_type() -> pa.DataType:
    pair = pa.struct([("start", pa.int32()), ("end", pa.int32())])
    return pa.struct([("n_words", pa.int64()), ("n_hit", pa.int64()), ("items", pa.list_(pa.string())), ("spans", pa.list_(pair))])


def find_contamination(docs: DataFrame, items: DataFrame, window: int = WINDOW, text_col: str = "text", id_col: str = "item_id", broadcast_windows: int = BROADCAST_WINDOWS, into: str = "contamination") -> DataFrame:
    """``docs`` with a struct column ``into``: n_words, n_hit (words inside any occurrence of an item window), items
    (sorted ids, as text, of items with an occurring window) and spans (character ranges of hit words).

    Null and empty texts have no words and no hit; items without words match nothing; repeated rows and repeated
    items are found alike. The item windows are counted first: up to ``broadcast_windows`` they go to every task as a
    hash set and the texts are scanned once without a shuffle; beyond it windows of the texts are joined to them by
    value, with the same result."""
    windows = item_windows(items, window, id_col, text_col).persist()
    if windows.count() > broadcast_windows:
        return _joined(docs, windows, text_col, into)
    known = docs.sparkSession.sparkContext.broadcast(HashSet([tuple(r) for r in windows.collect()]))
    windows.unpersist()

    @F.arrow_udf(RESULT)
    def scan(column: pa.Array) -> pa.Array:
        return known.value.scan(column)

    return docs.withColumn(into, scan(F.col(text_col)))


def _joined(docs: DataFrame, windows: DataFrame, text_col: str, into: str) -> DataFrame:
    """The same by a join of windows, for item sets too large to be sent to every task. Texts are told by their hash,
    so that repeated rows are worked on once."""
    sizes = [r[0] for r in windows.select("size").distinct().collect()]  # WINDOW values at most
    key = F.md5(F.coalesce(F.col(text_col), F.lit("")))
    texts = docs.select(key.alias("key"), F.col(text_col).alias("text")).dropDuplicates(["key"])
    each = texts.select("key", words(F.col("text")).alias("w"), F.explode(F.array(*map(F.lit, sizes))).alias("size"))
    each = each.filter("size(w) >= size")
    runs = F.transform(F.sequence(F.lit(1), F.size("w") - F.col("size") + 1), lambda p: F.array_join(F.slice("w", p, F.col("size")), " "))
    found = each.select("key", "size", F.posexplode(runs).alias("at", "window")).join(windows, ["size", "window"])
    marks = F.flatten(F.collect_set(F.sequence(F.col("at"), F.col("at") + F.col("size") - 1)))
    hits = found.groupBy("key").agg(F.sort_array(F.collect_set("item")).alias("items"), F.array_distinct(marks).alias("at"))

    @F.arrow_udf("array<struct<start:int,end:int>>")
    def spans(column: pa.Array, at: pa.Array) -> pa.Array:
        out, row = [], 0
        at = at.to_pylist()
        for _, data, offsets in B.blocks(column):
            w = B.Words(B.LOWER[data], offsets, B.ALNUM)
            covered = np.zeros(len(w), bool)
            for k in range(len(offsets) - 1):
                covered[w.rows[k] + np.array(at[row + k] or [], np.int64)] = True
            out.append(_spans(covered, w, data, offsets))
            row += len(offsets) - 1
        return pa.concat_arrays(out) if out else pa.array([], _arrow_type().field("spans").type)

    known = texts.join(hits, "key", "left").select(
        "key",
        F.struct(
            F.size(words(F.col("text"))).cast("bigint").alias("n_words"),
            F.coalesce(F.size("at"), F.lit(0)).cast("bigint").alias("n_hit"),
            F.coalesce("items", F.array().cast("array<string>")).alias("items"),
            spans("text", "at").alias("spans"),
        ).alias(into),
    )
    return docs.withColumn("__key", key).join(known.withColumnRenamed("key", "__key"), "__key").drop("__key")


def remove(found: DataFrame, how: str = "documents", text_col: str = "text", contamination: str = "contamination") -> DataFrame:
    """Apply the decisions of ``find_contamination`` and drop its column: ``documents`` leaves every document with a hit
    out, ``spans`` cuts the hit character ranges out of the texts and keeps all rows."""
    if how == "documents":
        return found.filter(F.col(f"{contamination}.n_hit") == 0).drop(contamination)
    spans = F.col(f"{contamination}.spans")
    starts = F.concat(F.array(F.lit(0)), spans["end"])
    stops = F.concat(spans["start"], F.array(F.length(text_col)))
    parts = F.zip_with(starts, stops, lambda a, b: F.substring(F.col(text_col), a + 1, b - a))
    return found.withColumn(text_col, F.when(F.size(spans) > 0, F.array_join(parts, "")).otherwise(F.col(text_col))).drop(contamination)
