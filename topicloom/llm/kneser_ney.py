"""Quality rules: word and line counts with fixed limits, then the perplexities of two modified Kneser-Ney n-gram models within
bands of the language: of words (``word_pairs``) and of characters, for what is no text at all.

Grams of characters are over ALPHABET symbols: letters, digits, white space, punctuation classes and classes of the other bytes. There
can be no more than ALPHABET^ORDER = 2^24 of them, which bounds the model at any corpus size, so that no count is cut.
Spark counts them over all texts; the model is sorted arrays of gram codes with their probabilities, one for each order."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from topicloom.llm import textbytes as B
from topicloom.llm.staging import stage
from topicloom.llm.word_pairs import give_back, with_losses

BITS, ORDER = 6, 4
ALPHABET = 1 << BITS
EDGE = 0  # before and after a text

SYMBOL = np.zeros(256, np.uint32)
SYMBOL[:128] = 28 + np.arange(128) % 4  # control characters and rare punctuation
SYMBOL[97:123] = SYMBOL[65:91] = np.arange(1, 27)
SYMBOL[48:58] = 27
SYMBOL[[9, 10, 11, 12, 13, 32]] = 32
for _k, _c in enumerate(b".,;:!?'\"-()"):
    SYMBOL[_c] = 33 + _k
SYMBOL[128:] = 44 + np.arange(128) % 20

SYMBOLS_SET = np.zeros(256, bool)
SYMBOLS_SET[list(b"#*$%&|<>")] = True

BATCH_ROWS = 500  # texts that come to a task of the counts at once
MIN_WORDS = 50
FENCE = 3.0  # a band reaches so many interquartile ranges beyond the quartiles of a language
LEAST_RANGE = 0.02  # of log perplexity, where nearly all texts of a language agree
BIN = 0.001  # quartiles are taken from counts of log perplexities rounded so far
RESULT = "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, log_perplexity double"


def grams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Codes of the ORDER-grams that end at each symbol and at the end of each text: (codes, first of each row)."""
    rows = len(offsets) - 1
    pad = ORDER - 1
    at = offsets + (pad + 1) * np.arange(rows + 1)  # each text gets pad edges before it and one after
    inside = np.ones(int(at[-1]), bool)
    for o in range(pad):
        inside[at[:-1] + o] = False
    ends = inside[pad:].copy()  # of the grams, at the symbols and the end of each text
    inside[at[1:] - 1] = False
    symbols = np.full(len(inside), EDGE, np.uint32)
    symbols[inside] = SYMBOL[data]
    codes = symbols[pad:].copy()
    for o in range(pad):
        codes |= symbols[o : len(symbols) - pad + o] << np.uint32(BITS * (pad - o))
    return codes[ends], np.concatenate([[0], np.cumsum(np.diff(offsets) + 1)])


def count_grams(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """(gram, n) over all texts; each task sends a gram once."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        for batch in batches:
            for _, data, offsets in B.blocks(batch.column(0)):
                held.append(np.unique(grams(data, offsets)[0], return_counts=True))
            held = [_merged(held)]
        if held:
            keys, n = held[0]
            for a in range(0, len(keys), 100_000):
                yield pa.record_batch([pa.array(keys[a : a + 100_000].astype(np.int32)), pa.array(n[a : a + 100_000].astype(np.int64))], ["gram", "n"])
        give_back()

    return docs.select(text_col).mapInArrow(count, "gram int, n bigint").groupBy("gram").agg(F.sum("n").alias("n"))


def _merged(held: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    keys, back = np.unique(np.concatenate([k for k, _ in held]), return_inverse=True)
    return keys, np.bincount(back, np.concatenate([n for _, n in held]), len(keys)).astype(np.int64)


class Model:
    """For each order: sorted codes, log probabilities of the grams and log weights of their last-symbol-less contexts."""

    def __init__(self, keys: np.ndarray, n: np.ndarray):
        order = np.argsort(keys)
        keys, n = keys[order].astype(np.uint32), n[order].astype(np.float64)
        counts = {ORDER: (keys, n)}
        for m in range(ORDER - 1, 0, -1):  # continuation counts: distinct symbols before a gram
            longer, _ = counts[m + 1]
            k, c = np.unique(longer & np.uint32((1 << BITS * m) - 1), return_counts=True)
            counts[m] = (k, c.astype(np.float64))
        self.keys, self.logs, self.contexts, self.weights = {}, {}, {}, {}
        below = None
        for m in range(1, ORDER + 1):
            k, c = counts[m]
            of = [float((c == i).sum()) for i in (1, 2, 3, 4)]
            y = of[0] / (of[0] + 2 * of[1]) if of[0] + of[1] else 0.0
            cut = np.array([0.0, *[min(max(i - (i + 1) * y * of[i] / of[i - 1], 0.0), float(i)) if of[i - 1] else 0.5 * i for i in (1, 2, 3)]])
            take = cut[np.minimum(c, 3).astype(int)]
            context, at = np.unique(k >> np.uint32(BITS), return_inverse=True)
            total = np.bincount(at, c)
            weight = np.maximum(np.bincount(at, take) / total, 1e-12)
            lower = np.full(len(k), 1.0 / ALPHABET) if below is None else self._p(m - 1, k & np.uint32((1 << BITS * (m - 1)) - 1))
            p = (c - take) / total[at] + weight[at] * lower
            self.keys[m], self.logs[m] = k, np.log(p)
            self.contexts[m], self.weights[m] = context, np.log(weight)
            below = p
        # the grams of the highest order also by their contexts: a row for each, the last for contexts never counted
        self.row = np.full(1 << BITS * (ORDER - 1), len(context), np.int32)
        self.row[context] = np.arange(len(context), dtype=np.int32)
        self.by_context = np.full((len(context) + 1) << BITS, np.nan)
        self.by_context[(at << BITS) + (k & np.uint32(ALPHABET - 1))] = self.logs[ORDER]

    def _p(self, m: int, codes: np.ndarray) -> np.ndarray:
        return np.exp(self.log_p(codes, m))

    def log_p(self, codes: np.ndarray, m: int = ORDER) -> np.ndarray:
        """Log probability of the last symbol of each gram of m symbols; a gram never counted takes the weight of its
        context times the probability one order below."""
        if m == 0:
            return np.full(len(codes), -np.log(ALPHABET))
        keys = self.keys[m]
        if not len(keys):
            return self.log_p(np.zeros(len(codes), np.uint32), 0)
        if m == ORDER:
            at = self.row[codes >> np.uint32(BITS)] << np.int32(BITS)
            at |= (codes & np.uint32(ALPHABET - 1)).view(np.int32)
            out = self.by_context[at]
            miss = np.flatnonzero(np.isnan(out))
        else:
            at = np.searchsorted(keys, codes)
            at[at == len(keys)] = 0
            out = self.logs[m][at]
            miss = np.flatnonzero(keys[at] != codes)
        if len(miss):
            c = codes[miss]
            known = np.searchsorted(self.contexts[m], c >> np.uint32(BITS))
            known[known == len(self.contexts[m])] = 0
            weight = np.where(self.contexts[m][known] == c >> np.uint32(BITS), self.weights[m][known], 0.0)
            out[miss] = weight + self.log_p(c & np.uint32((1 << BITS * (m - 1)) - 1), m - 1)
        return out


def repeated(keys: np.ndarray) -> np.ndarray:
    """True where a key stands more than once."""
    ordered = np.sort(keys)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(twice):
        return np.zeros(len(keys), bool)
    twice = twice[np.concatenate([[True], twice[1:] != twice[:-1]])]
    at = np.searchsorted(twice, keys)
    at[at == len(twice)] = 0
    return twice[at] == keys


def measure(model: Model, column: pa.Array) -> pa.Array:
    out: list[list[np.ndarray]] = [[] for _ in range(6)]
    for _, data, offsets in B.blocks(column):
        w = B.Words(data, offsets, B.SPACED)
        rows = w.row_of()
        later = np.flatnonzero((data & 0xC0) == 0x80)  # bytes of a character after its first; all are in words
        breaks = np.flatnonzero(data == 10)
        starts = np.unique(np.concatenate([offsets[:-1], breaks + 1]))
        starts = starts[starts < len(data)]
        ends = np.append(starts[1:], len(data))
        ends = ends - (data[ends - 1] == 10) if len(ends) else ends
        worded = np.searchsorted(w.starts, ends) > np.searchsorted(w.starts, starts)
        starts, ends = starts[worded], ends[worded]
        hashes = B.span_hashes(data, np.concatenate([w.starts, starts]), np.concatenate([w.ends, ends]))  # of words and lines
        triples = B.gram_hashes(hashes[: len(w)], 3)
        ok = np.flatnonzero(B.gram_starts(w.rows, 3))
        again = ok[repeated(triples[ok] ^ B.mix(rows[ok].astype(np.uint64)))]
        hit = np.zeros(len(w), bool)
        for o in range(3):
            hit[again + o] = True
        line_rows = np.searchsorted(offsets, starts, "right") - 1
        named = hashes[len(w) :] ^ B.mix(line_rows.astype(np.uint64))
        _, first = np.unique(named, return_index=True)
        n_rows = len(offsets) - 1
        codes, edges = grams(data, offsets)
        logs = B.sums_by_row(model.log_p(codes), edges)
        for k, values in enumerate((
            w.counts,
            B.sums_by_row(w.ends - w.starts, w.rows) - np.diff(np.searchsorted(later, offsets)),
            np.diff(np.searchsorted(np.flatnonzero(SYMBOLS_SET[data]), offsets)),
            np.bincount(line_rows, minlength=n_rows) - np.bincount(line_rows[first], minlength=n_rows),
            B.sums_by_row(hit.astype(np.int64), w.rows),
            -logs / np.diff(edges),
        )):
            out[k].append(values)
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "log_perplexity"]
    kinds = [pa.int64()] * 5 + [pa.float64()]
    return pa.StructArray.from_arrays([pa.array(np.concatenate(v) if v else [], kind) for v, kind in zip(out, kinds)], names)


def fit(docs: DataFrame, text_col: str = "text") -> Model:
    """The model of all texts of ``docs``. At most 2^24 counts come to the driver."""
    conf, name = docs.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    rows = conf.get(name)
    conf.set(name, str(BATCH_ROWS))
    try:
        counts = count_grams(docs, text_col).toArrow()
    finally:
        conf.set(name, rows)
    return Model(counts["gram"].to_numpy().astype(np.uint32), counts["n"].to_numpy())


def quartiles(values: DataFrame, key: str, value: str) -> DataFrame:
    """(key, q1, q3) of the rounded values: exact from their counts, whatever the partitions."""
    bins = values.groupBy(key, F.round(F.col(value) / BIN).cast("bigint").alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    run = Window.partitionBy(key).orderBy("bin")  # a key has as many bins as different rounded values
    ranked = bins.withColumn("upto", F.sum("n").over(run)).withColumn("all", F.sum("n").over(Window.partitionBy(key)))
    pick = [F.min(F.when(F.col("upto") >= q * F.col("all"), F.col("bin"))) * BIN for q in (0.25, 0.75)]
    return ranked.groupBy(key).agg(pick[0].alias("q1"), pick[1].alias("q3"))


def judge(docs: DataFrame, fence: float = FENCE) -> DataFrame:
    """(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, log_perplexity, word_log_perplexity, low, high,
    word_high, base_failed, kept) for every row of ``docs`` (doc_id, text, lang, ...).

    base_failed: fewer than 50 words, or over half of them in three-word windows found twice. The bands are those of
    ``lang`` over all texts that did not fail, one band for the null language; a text is kept if its characters
    (log_perplexity) lie from low to high and its words, as all other texts tell them, at most at word_high, inclusive: a
    text of which there are copies is no worse for that. A null or empty text has no words, one symbol (its end) and
    fails. Rows that repeat are judged alike."""
    docs = docs.select("doc_id", F.coalesce("lang", F.lit("und")).alias("lang"), "text")
    known = docs.sparkSession.sparkContext.broadcast(fit(docs))

    def measured_rows(rows: list[tuple]) -> list[tuple]:
        found = measure(known.value, pa.array([r[2] for r in rows], pa.large_string()))
        return [(doc_id, lang, *values) for (doc_id, lang, _), *values in zip(rows, *(v.to_pylist() for v in found.flatten()))]

    def run(chunks: Iterator[tuple]) -> Iterator[tuple]:
        for rows, losses in chunks:
            for row, loss in zip(rows, losses.tolist()):
                yield *row, loss

    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, lang string, {RESULT}, word_log_perplexity double"
    measured = docs.sparkSession.createDataFrame(with_losses(docs, keep=measured_rows).mapPartitions(run), schema, verifySchema=False)
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    measured = stage(measured.withColumn("base_failed", failed))
    sound = measured.filter(~F.col("base_failed"))
    reach = fence * F.greatest(F.col("q3") - F.col("q1"), F.lit(LEAST_RANGE))
    chars = quartiles(sound, "lang", "log_perplexity").select("lang", (F.col("q1") - reach).alias("low"), (F.col("q3") + reach).alias("high"))
    words = quartiles(sound, "lang", "word_log_perplexity").select("lang", (F.col("q3") + reach).alias("word_high"))
    bands = stage(chars.join(words, "lang"))
    if bands.count() <= 10_000:
        bands = F.broadcast(bands)
    inside = F.col("log_perplexity").between(F.col("low"), F.col("high")) & (F.col("word_log_perplexity") <= F.col("word_high"))
    return measured.join(bands, "lang", "left").withColumn("kept", F.coalesce(~F.col("base_failed") & inside, F.lit(False))).drop("lang")
