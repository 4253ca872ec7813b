"""Scoring by a hidden Markov language model. Baum-Welch counts of all training texts, summed over the partitions, train the
states; the scaled forward recursion gives the exact likelihood of a text.

States emit symbols: each frequent word, the end of a text, and one symbol for all other words, within which a word has
its smoothed share of their counts, whatever the state. The number of frequent words is bounded (SYMBOLS), every other
word still counts by its own corpus count."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from topicloom.llm import textbytes as B
from topicloom.llm.language_cnn import held_out
from topicloom.llm.staging import stage

STATES, SYMBOLS, ROUNDS = 8, 16_000, 3
# Counts of the most frequent words, up to so many, are sent to the tasks (16 bytes each); the others are joined by shuffle.
HEAD_WORDS = 1_000_000
END = np.uint64(0xE0D0E0D0E0D0E0D1)
PRIOR = 10.0  # weight of the corpus frequencies in the emissions of a state
BLOCK = 3 << 20  # the tokens of a block take STATES * 8 bytes each in a few arrays
RESULT = "n_tokens bigint, head_known bigint, head_log double, n_rare bigint, rare_log double, states_log double, tail array<bigint>"


def tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of each text and its end: (hashes, first of each row and the end)."""
    data = B.LOWER[data]
    w = B.Words(data, offsets, B.SPACED)
    edges = w.rows + np.arange(len(w.rows))
    out = np.full(int(edges[-1]), END, np.uint64)
    out[np.arange(len(w)) + w.row_of()] = w.hashes()
    return out, edges


def count_words(texts: DataFrame) -> DataFrame:
    """(word, c): the count of each word hash over all texts; a task sends a word once for each million different ones."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, n = np.zeros(0, np.uint64), np.zeros(0, np.int64)

        def out() -> Iterator[pa.RecordBatch]:
            for a in range(0, len(keys), 100_000):
                yield pa.record_batch([pa.array(keys[a : a + 100_000].view(np.int64)), pa.array(n[a : a + 100_000])], ["word", "n"])

        for batch in batches:
            for _, data, offsets in B.blocks(batch.column(0)):
                more, m = np.unique(tokens(data, offsets)[0], return_counts=True)
                at = np.searchsorted(keys, more)
                known = (at < len(keys)) & (keys[np.minimum(at, len(keys) - 1)] == more) if len(keys) else np.zeros(len(more), bool)
                n[at[known]] += m[known]
                new = ~known
                keys = np.insert(keys, at[new], more[new])
                n = np.insert(n, at[new], m[new])
                if len(keys) > 1_000_000:
                    yield from out()
                    keys, n = keys[:0], n[:0]
        yield from out()

    return texts.mapInArrow(count, "word bigint, n bigint").groupBy("word").agg(F.sum("n").alias("c"))


def least_count(counts: DataFrame, most: int) -> int:
    """A count that at most ``most`` words reach, from the numbers of words in count ranges (a few hundred rows)."""
    ranges = counts.groupBy(F.floor(4 * F.log2("c")).alias("range")).agg(F.min("c").alias("c"), F.count(F.lit(1)).alias("n")).collect()
    least, words = None, 0
    for r in sorted(ranges, key=lambda r: -r["range"]):
        words += r.n
        if words > most:
            break
        least = r.c
    return least if least is not None else 1 << 62


@dataclass
class Model:
    start: np.ndarray
    step: np.ndarray
    emit: np.ndarray  # symbols x states; the last symbol stands for all words that are not frequent
    frequent: np.ndarray  # sorted hashes of the words that are symbols

    def symbols(self, words: np.ndarray) -> np.ndarray:
        at = np.searchsorted(self.frequent, words)
        at[at == len(self.frequent)] = 0
        return np.where(self.frequent[at] == words, at, len(self.frequent)) if len(self.frequent) else np.zeros(len(words), np.int64)


class Packed:
    """Texts in step with each other, longest first: the tokens of step t are those from at[t] on."""

    def __init__(self, edges: np.ndarray):
        lengths = np.diff(edges)
        self.order = np.argsort(-lengths, kind="stable")
        lengths = lengths[self.order]
        self.steps = int(lengths[0]) if len(lengths) else 0
        self.active = np.searchsorted(-lengths, -np.arange(self.steps), "left")  # texts longer than t
        self.at = np.concatenate([[0], np.cumsum(self.active)])
        rank = B.ragged(np.zeros(self.steps, np.int64), self.active)
        time = np.repeat(np.arange(self.steps), self.active)
        self.source = edges[self.order][rank] + time  # place of each packed token in the texts
        self.before = np.where(time > 0, self.at[np.maximum(time - 1, 0)] + rank, -1)
        self.text = self.order[rank]


def forward(model: Model, seen: np.ndarray, p: Packed) -> tuple[np.ndarray, np.ndarray]:
    """Scaled forward values and the scale of each packed token; ``seen``: emission of each token in each state."""
    alpha, scale = np.empty_like(seen), np.empty(len(seen))
    for t in range(p.steps):
        a, b = p.at[t], p.at[t + 1]
        now = alpha[a:b]
        if t == 0:
            np.multiply(seen[a:b], model.start, out=now)
        else:
            np.matmul(alpha[p.at[t - 1] : p.at[t - 1] + b - a], model.step, out=now)
            now *= seen[a:b]
        total = now.sum(1)
        scale[a:b] = total
        now /= total[:, None]
    return alpha, scale


def expected(model: Model, words: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """Expected starts, transitions and emissions of the texts, and their log likelihood."""
    p = Packed(edges)
    symbols = model.symbols(words[p.source])
    seen = model.emit[symbols]
    alpha, scale = forward(model, seen, p)
    seen /= scale[:, None]
    beta = np.ones_like(seen)
    back = model.step.T.copy()
    for t in range(p.steps - 2, -1, -1):
        a, n = p.at[t + 1], p.active[t + 1]
        np.matmul(seen[a : a + n] * beta[a : a + n], back, out=beta[p.at[t] : p.at[t] + n])
    seen *= beta
    moves = np.zeros_like(model.step)
    for a in range(0, len(seen), 1 << 16):
        before = p.before[a : a + (1 << 16)]
        later = np.flatnonzero(before >= 0)
        moves += alpha[before[later]].T @ seen[a + later]
    moves *= model.step
    alpha *= beta
    emitted = np.stack([np.bincount(symbols, alpha[:, k], len(model.emit)) for k in range(len(model.start))], 1)
    return alpha[: p.active[0]].sum(0), moves, emitted, float(np.log(scale).sum())


def initial(frequent: np.ndarray, share: np.ndarray, states: int, seed: int = 11) -> Model:
    rng = np.random.default_rng(seed)
    emit = share[:, None] * np.exp(0.5 * rng.normal(size=(len(share), states)))
    step = np.full((states, states), 0.5 / states) + 0.5 * np.eye(states)
    return Model(np.full(states, 1 / states), step, emit / emit.sum(0), frequent)


def baum_welch(texts: DataFrame, model: Model, share: np.ndarray) -> Model:
    """One round over all ``texts``. A task sends its sums once: a row for each symbol, state and the starts."""
    states, size = len(model.start), len(share)
    known = texts.sparkSession.sparkContext.broadcast(model)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size + states + 1, states))
        for batch in batches:
            for _, data, offsets in B.blocks(batch.column(0), BLOCK):
                start, moves, emitted, _ = expected(known.value, *tokens(data, offsets))
                total[:size] += emitted
                total[size:-1] += moves
                total[-1] += start
        used = np.flatnonzero(total.any(1))
        yield pa.record_batch([pa.array(used), *(pa.array(total[used, k]) for k in range(states))], ["row", *(f"s{k}" for k in range(states))])

    schema = "row bigint, " + ", ".join(f"s{k} double" for k in range(states))
    added = texts.mapInArrow(sums, schema).groupBy("row").agg(*(F.sum(f"s{k}").alias(f"s{k}") for k in range(states))).toArrow()
    known.unpersist()
    total = np.zeros((size + states + 1, states))
    total[added["row"].to_numpy()] = np.stack([added[f"s{k}"].to_numpy() for k in range(states)], 1)
    emit = total[:size] + PRIOR * share[:, None]
    step, start = total[size:-1] + 0.1, total[-1] + 0.1
    return Model(start / start.sum(), step / step.sum(1, keepdims=True), emit / emit.sum(0), model.frequent)


@dataclass
class Trained:
    model: Model
    head: np.ndarray  # sorted hashes of the words whose counts every task knows
    head_counts: np.ndarray
    counts: DataFrame
    n: int
    v: int
    rare_mass: float


def train(texts: DataFrame, states: int = STATES, symbols: int = SYMBOLS, rounds: int = ROUNDS, head_words: int = HEAD_WORDS) -> Trained:
    """Count all words of ``texts`` (one text column), then run ``rounds`` of Baum-Welch over all of them."""
    counts = stage(count_words(texts))
    n, v = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1))).first()
    head = counts.filter(F.col("c") >= least_count(counts, head_words)).toArrow()
    keys, c = head["word"].to_numpy().view(np.uint64), head["c"].to_numpy().astype(np.int64)
    order = np.argsort(keys)
    keys, c = keys[order], c[order]
    chosen = c >= least_count(counts, symbols)
    frequent, own = keys[chosen], c[chosen]
    rare_mass = n - int(own.sum()) + 0.5 * (v - len(frequent) + 1)
    share = np.append(own + 0.5, rare_mass) / (n + 0.5 * (v + 1))
    model = initial(frequent, share, states)
    for _ in range(rounds if n else 0):
        model = baum_welch(texts, model, share)
    return Trained(model, keys, c, counts, int(n), int(v), rare_mass)


def measure(model: Model, head: np.ndarray, head_counts: np.ndarray, column: pa.Array) -> pa.Array:
    out: list[list] = [[] for _ in range(7)]
    for _, data, offsets in B.blocks(column, BLOCK):
        words, edges = tokens(data, offsets)
        p = Packed(edges)
        _, scale = forward(model, model.emit[model.symbols(words[p.source])], p)
        states_log = np.bincount(p.text, np.log10(scale), len(offsets) - 1)
        at = np.searchsorted(head, words)
        at[at == len(head)] = 0
        known = head[at] == words if len(head) else np.zeros(len(words), bool)
        log = np.where(known, np.log10((head_counts[at] if len(head) else np.zeros(len(words))) + 0.5), 0.0)
        rare = model.symbols(words) == len(model.frequent)
        tail = ~known
        values = (np.diff(edges), B.sums_by_row(known.astype(np.int64), edges), B.sums_by_row(log, edges), B.sums_by_row(rare.astype(np.int64), edges), B.sums_by_row(np.where(rare, log, 0.0), edges), states_log)
        for k, x in enumerate(values):
            out[k].append(x)
        out[6].append(B.list_array(words[tail].view(np.int64), B.sums_by_row(tail.astype(np.int64), edges)))
    kinds = [pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.float64(), pa.float64()]
    arrays = [pa.array(np.concatenate(v) if v else [], kind) for v, kind in zip(out, kinds)]
    arrays.append(pa.concat_arrays(out[6]) if out[6] else pa.array([], pa.list_(pa.int64())))
    return pa.StructArray.from_arrays(arrays, ["n_tokens", "head_known", "head_log", "n_rare", "rare_log", "states_log", "tail"])


def score(docs: DataFrame, **options: int) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) for every row of ``docs`` (doc_id, text, ...).

    Trained on the rows whose crc32(doc_id as text) mod 5 is not 1; a row without doc_id trains. Tokens are the words
    ([^\\x20\\x09-\\x0D]+, A-Z lower-cased) and one end; a null or empty text is its end alone. Words are told by 64-bit
    hashes. base_score is the smoothed unigram log10 probability, score that of the hidden Markov model. Repeated rows
    score alike; without training rows every token is unknown and base_score is its share of one unseen word."""
    apart = held_out(F.col("doc_id"), 5, 1)
    t = train(docs.filter(~apart).select("text"), **options)
    known = docs.sparkSession.sparkContext.broadcast((t.model, t.head, t.head_counts))

    @F.arrow_udf(RESULT)
    def run(column: pa.Array) -> pa.Array:
        return measure(*known.value, column)

    rows = docs.select("doc_id", apart.alias("held_out"), run(F.col("text")).alias("m"))
    rows = stage(rows.select("doc_id", "held_out", "m.*").withColumn("row", F.monotonically_increasing_id()))
    tail = rows.select("row", F.explode("tail").alias("word")).join(t.counts, "word", "left")
    seen = tail.groupBy("row").agg(F.sum(F.log10(F.coalesce("c", F.lit(0)) + 0.5)).alias("tail_log"), F.count("c").alias("tail_known"))
    both = rows.join(seen, "row", "left")
    added = F.coalesce("tail_log", F.lit(0.0))
    base = F.col("head_log") + added - F.col("n_tokens") * math.log10(t.n + 0.5 * (t.v + 1))
    whole = F.col("states_log") + F.col("rare_log") + added - F.col("n_rare") * math.log10(t.rare_mass)
    return both.select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("head_known") + F.coalesce("tail_known", F.lit(0))).alias("n_known"),
        F.lit(t.n).cast("bigint").alias("train_tokens"),
        base.alias("base_score"),
        whole.alias("score"),
    )
