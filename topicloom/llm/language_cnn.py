"""Language identification by a byte convolutional network: filters of several widths over the bytes of fixed-length
windows, max pooling, softmax. Trained in numpy on a bounded labelled sample; applied to every window of every text."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from topicloom.llm import textbytes as B

# The documented bound of the training sample: so many documents of each language, so many windows of each.
DOCS_PER_LANG = 400
WINDOWS_PER_DOC = 6
LENGTH = 256  # bytes of a window
WIDTHS = (2, 3, 4)
FILTERS = 16  # of each width
UNKNOWN = "und"
RESULT = "lang_pred string, score double"
# Windows are pushed through the network in runs of so many.
RUN = 256


@dataclass
class Network:
    """``tables[k][o]`` (256 x FILTERS): what a byte at offset o adds to the filters of width WIDTHS[k]."""

    langs: list[str]
    tables: list[np.ndarray]
    bias: np.ndarray
    weights: np.ndarray
    offset: np.ndarray

    def pooled(self, windows: np.ndarray, where: bool = False):
        values, places = [], []
        for table in self.tables:
            width = len(table)
            steps = windows.shape[1] - width + 1
            total = table[0][windows[:, :steps]]
            for o in range(1, width):
                total += table[o][windows[:, o : o + steps]]
            if where:
                at = total.argmax(1)
                places.append(at)
                values.append(np.take_along_axis(total, at[:, None], 1)[:, 0])
            else:
                values.append(total.max(1))
        raw = np.concatenate(values, 1) + self.bias
        return (raw, places) if where else raw

    def probabilities(self, windows: np.ndarray) -> np.ndarray:
        out = np.empty((len(windows), len(self.langs)), np.float32)
        for a in range(0, len(windows), RUN):
            out[a : a + RUN] = softmax(np.maximum(self.pooled(windows[a : a + RUN]), 0) @ self.weights + self.offset)
        return out


def softmax(z: np.ndarray) -> np.ndarray:
    z = np.exp(z - z.max(1, keepdims=True))
    return z / z.sum(1, keepdims=True)


def windows_of(data: np.ndarray, offsets: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All windows of the texts of a block, lower-cased and padded with zero bytes: (windows, windows of each row,
    bytes of each window)."""
    sizes = np.diff(offsets)
    counts = -(-sizes // length)
    starts = np.repeat(offsets[:-1], counts) + length * B.ragged(np.zeros(len(counts), np.int64), counts)
    stops = np.repeat(offsets[1:], counts)
    filled = np.minimum(stops - starts, length)
    padded = np.concatenate([B.LOWER[data], np.zeros(length, np.uint8)])
    windows = np.lib.stride_tricks.sliding_window_view(padded, length)[starts]
    short = np.flatnonzero(filled < length)
    windows[short] *= np.arange(length) < filled[short, None]
    return windows, counts, filled


def train(windows: np.ndarray, labels: np.ndarray, langs: list[str], epochs: int = 12, batch: int = 64, rate: float = 0.01, seed: int = 7) -> Network:
    """Adam on the cross entropy. Each language weighs the same, however many windows it has."""
    rng = np.random.default_rng(seed)
    kinds = len(langs)
    tables = [rng.normal(0, 0.1, (w, 256, FILTERS)).astype(np.float32) for w in WIDTHS]
    net = Network(langs, tables, np.zeros(len(WIDTHS) * FILTERS, np.float32), rng.normal(0, 0.1, (len(WIDTHS) * FILTERS, kinds)).astype(np.float32), np.zeros(kinds, np.float32))
    balance = len(labels) / (kinds * np.maximum(np.bincount(labels, minlength=kinds), 1))
    state = [(np.zeros_like(p), np.zeros_like(p)) for p in (*net.tables, net.bias, net.weights, net.offset)]
    step = 0
    for _ in range(epochs):
        order = rng.permutation(len(labels))
        for a in range(0, len(order), batch):
            part = order[a : a + batch]
            x, y = windows[part], labels[part]
            raw, places = net.pooled(x, where=True)
            hidden = np.maximum(raw, 0)
            d = softmax(hidden @ net.weights + net.offset)
            d[np.arange(len(y)), y] -= 1
            d *= (balance[y] / len(y))[:, None].astype(np.float32)
            back = (d @ net.weights.T) * (raw > 0)
            grads = []
            for k, table in enumerate(net.tables):
                g = np.zeros_like(table)
                own = back[:, k * FILTERS : (k + 1) * FILTERS]
                for o in range(len(table)):
                    hit = np.take_along_axis(x, places[k] + o, 1)
                    np.add.at(g[o], (hit, np.arange(FILTERS)[None]), own)
                grads.append(g)
            grads += [back.sum(0), hidden.T @ d, d.sum(0)]
            step += 1
            for p, g, (m, v) in zip((*net.tables, net.bias, net.weights, net.offset), grads, state):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                p -= (rate / (1 - 0.9**step)) * m / (np.sqrt(v / (1 - 0.999**step)) + 1e-7)
    for table in net.tables:  # a zero byte is padding
        table[:, 0] = np.minimum(table[:, 0], 0)
    return net


def has_letter(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    low = B.LOWER[data]
    ascii_letter = (low >= 97) & (low <= 122)
    found = B.sums_by_row(ascii_letter.astype(np.int64), offsets) > 0
    beyond = B.sums_by_row((data >= 128).astype(np.int64), offsets) > 0
    for row in np.flatnonzero(~found & beyond).tolist():
        found[row] = any(c.isalpha() for c in data[offsets[row] : offsets[row + 1]].tobytes().decode(errors="ignore"))
    return found


def classify(net: Network | None, column: pa.Array) -> pa.Array:
    """The mean probability over all windows of a text, each weighing its bytes; the highest names the language."""
    names, scores = [], []
    for _, data, offsets in B.blocks(column, 1 << 20):
        rows = len(offsets) - 1
        if net is None:
            names += [UNKNOWN] * rows
            scores += [0.0] * rows
            continue
        windows, counts, filled = windows_of(data, offsets)
        weighed = net.probabilities(windows) * filled[:, None].astype(np.float64)
        edges = np.concatenate([[0], np.cumsum(counts)])
        total = np.concatenate([np.zeros((1, weighed.shape[1])), np.cumsum(weighed, 0)])
        mean = (total[edges[1:]] - total[edges[:-1]]) / np.maximum(np.diff(offsets), 1)[:, None]
        best = mean.argmax(1)
        known = has_letter(data, offsets)
        names += [net.langs[b] if k else UNKNOWN for b, k in zip(best.tolist(), known.tolist())]
        scores += np.where(known, np.clip(mean[np.arange(rows), best], 0, 1), 0.0).tolist()
    return pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(scores, pa.float64())], ["lang_pred", "score"])


def sample(docs: DataFrame, docs_per_lang: int = DOCS_PER_LANG) -> DataFrame:
    """(doc_id, lang, text) of up to ``docs_per_lang`` labelled documents of each language, by their hashed id. Languages are
    counted first, so that only ids below a share of the hash range, about twice as many as wanted, are ranked. The ranking
    reads ids and labels only; texts are fetched for the chosen ids, whose number is bounded by the languages."""
    hashed = F.xxhash64(F.col("doc_id").cast("string"))
    labelled = docs.filter("lang IS NOT NULL AND doc_id IS NOT NULL").select("doc_id", "lang", hashed.alias("h"))
    counts = labelled.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    place = (F.col("h").cast("double") + 2.0**63) / 2.0**64
    near = labelled.join(F.broadcast(counts), "lang").filter(place * F.col("n") <= 2 * docs_per_lang + 50)
    order = Window.partitionBy("lang").orderBy("h", "doc_id")
    chosen = near.withColumn("r", F.row_number().over(order)).filter(F.col("r") <= docs_per_lang).select("doc_id", "lang").distinct()
    return docs.select("doc_id", "lang", "text").join(F.broadcast(chosen), ["doc_id", "lang"]).filter("text IS NOT NULL")


def fit(docs: DataFrame, docs_per_lang: int = DOCS_PER_LANG, windows_per_doc: int = WINDOWS_PER_DOC) -> Network | None:
    """Train on at most ``docs_per_lang`` documents of each language and ``windows_per_doc`` windows of each, evenly
    spread over it. None without labelled text."""

    @F.arrow_udf("array<binary>")
    def spread(column: pa.Array) -> pa.Array:
        out = []
        for _, data, offsets in B.blocks(column):
            windows, counts, _ = windows_of(data, offsets)
            edges = np.cumsum(counts) - counts
            for first, n in zip(edges.tolist(), counts.tolist()):
                at = np.unique(np.linspace(0, n - 1, min(n, windows_per_doc)).astype(int)) if n else []
                out.append([windows[first + k].tobytes() for k in at])
        return pa.array(out, pa.list_(pa.binary()))

    cut = sample(docs, docs_per_lang).select("lang", "doc_id", spread(F.col("text")).alias("w"))
    once = cut.groupBy("lang", "doc_id").agg(F.min("w").alias("w"))  # however often the rows repeat
    rows = once.select("lang", "doc_id", F.explode("w").alias("w")).collect()
    rows = sorted((r.lang, r.doc_id, bytes(r.w)) for r in rows)
    if not rows:
        return None
    langs = sorted({r[0] for r in rows})
    windows = np.frombuffer(b"".join(r[2] for r in rows), np.uint8).reshape(-1, LENGTH)
    return train(windows, np.array([langs.index(r[0]) for r in rows]), langs)


def predict(docs: DataFrame, net: Network | None, text_col: str = "text", into: str = "language") -> DataFrame:
    """``docs`` with a struct column ``into``: lang_pred and score. One narrow pass over whole texts."""
    known = docs.sparkSession.sparkContext.broadcast(net)  # 48 filters and the languages: some 200 kB

    @F.arrow_udf(RESULT)
    def run(column: pa.Array) -> pa.Array:
        return classify(known.value, column)

    return docs.withColumn(into, run(F.col(text_col)))


def held_out(doc_id: Column, parts: int, part: int) -> Column:
    """Whether a document is kept from training; one without id is not."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % parts == part, F.lit(False))


def identify(docs: DataFrame, into: str = "language") -> DataFrame:
    """``docs`` (doc_id, text, lang, ...) with the struct column ``into``: lang_pred and score, learned from the documents
    that are not held out.

    A text that is null or has no letter is ``und`` with score 0, and so is every text if no label is known. Labels are
    any strings; ties go to the first in order. Repeated rows are told alike; the other columns stay as they are."""
    return predict(docs, fit(docs.filter(~held_out(F.col("doc_id"), 4, 2))), into=into)
