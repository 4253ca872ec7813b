"""Non-negative matrix factorisation X ~ W H of a corpus by multiplicative updates.

X is (doc_id, idx, val), one sparse row per document. Every pass solves the rows of W for the current H inside
the tasks, starting from the data alone, and sums W'X and W'W; only these sums, k x V and k x k numbers, are
shuffled. W is therefore never stored between passes: a lost executor costs the rerun of its tasks and no
lineage builds up. The same row solver scores unseen documents.

Several models of one matrix share their passes: each reads X once for all of them. Factors beyond FACTOR_CELL_LIMIT
cells stay a table of term ranges: rows meet H range by range, W'X stays in its ranges, and only W'W and HH' reach the driver."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from topicloom.models.ranges import MATRIX, RangedRows, added, entries_of, flat, lists, summed, table_of, width_of
from topicloom.operators.metrics import argmax
from topicloom.runtime import FACTOR_CELL_LIMIT, DataValidationError, cut_lineage, merge_partitions, spread_partitions

EPSILON = 1e-10
CHUNK = 2048  # term columns per row of partial sums
PIECE = 10_000_000  # matrix entries times topics a task works on at a time, which bounds its memory
BLOCK = 100_000  # cells of H gathered for rows of like length, so that all inner steps on them stay in a core's cache
CORE_WORK = 1_000_000  # entries times topics times inner steps that are worth a core


@dataclass(frozen=True)
class NmfParams:
    k: int = 10
    max_iter: int = 1000
    tol: float = 1e-4
    beta_loss: str = "frobenius"
    alpha_w: float = 0.0
    alpha_h: float = 0.0
    l1_ratio: float = 0.0
    inner_iter: int = 40
    seed: int = 42


@dataclass
class NmfModel:
    """Fitted factors over ``vocab`` (term_id, term): ``h`` is k x V within ``FACTOR_CELL_LIMIT`` cells; beyond it H is ``table``, rows (part, m)
    of term ranges, and ``h`` is None."""

    params: NmfParams
    h: np.ndarray | None
    vocab: DataFrame
    losses: list[float] = field(default_factory=list)
    reconstruction_error: float = float("nan")
    table: DataFrame | None = None

    def ranges(self) -> DataFrame:
        """H as rows (part, m) of term ranges."""
        if self.table is not None:
            return self.table
        h, size = self.h, width_of(self.params.k)
        k, width = h.shape
        rows = [(p, np.pad(h[:, p * size : (p + 1) * size], ((0, 0), (0, max(0, (p + 1) * size - width)))).ravel().tolist()) for p in range(-(-width // size))]
        return self.vocab.sparkSession.createDataFrame(rows, MATRIX)

    def topic_terms(self) -> DataFrame:
        """All weights (topic_id, term_id, term, weight)."""
        named = entries_of(self.ranges(), self.params.k)
        return named.join(self.vocab.select("term_id", "term"), "term_id").select("topic_id", "term_id", "term", "weight")

    def topics(self, n: int = 10) -> DataFrame:
        return top_terms_per_topic(self.topic_terms(), n)

    def transform(self, rows: DataFrame) -> DataFrame:
        """Topic weights of (doc_id, idx, val): (doc_id, w)."""
        if self.table is None:
            return solve_rows(rows, self.h, self.params)
        return solve_rows_by_ranges(rows, self.table, self.params)

    def document_topics(self, rows: DataFrame) -> DataFrame:
        return document_topics(self.transform(rows))


def top_terms_per_topic(topic_terms: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` heaviest terms per topic, weights rounded to 4 digits; a topic of zeros lists the first terms."""
    from topicloom.operators.relational import top_per_group

    ranked = top_per_group(topic_terms, ["topic_id"], n, F.col("weight").desc(), F.col("term"))
    return ranked.select("topic_id", "rank", "term", F.round("weight", 4).alias("weight"))


def topics_of(models: Sequence[NmfModel], n: int = 10) -> DataFrame:
    """The top terms of several models of one vocabulary, as by ``topics``: (run_id, topic_id, rank, term, weight), run_id being the
    place in ``models``. Of factors on the driver only the candidates for a place become rows."""
    from topicloom.operators.relational import top_per_group

    spark, vocab = models[0].vocab.sparkSession, models[0].vocab
    schema = "run_id int, topic_id int, term_id bigint, weight double"
    rows = []
    for run, model in enumerate(models):
        for topic, weights in enumerate(model.h if model.h is not None else ()):
            least = np.partition(weights, -n)[-n] if len(weights) > n else weights.min()
            rows += [(run, topic, int(i), float(weights[i])) for i in np.flatnonzero(weights >= least)]
    found = spark.createDataFrame(rows, schema)
    for run, model in enumerate(models):
        if model.h is None:
            found = found.unionByName(entries_of(model.table, model.params.k).withColumn("run_id", F.lit(run)).select(found.columns))
    named = found.join(vocab.select("term_id", "term"), "term_id")
    ranked = top_per_group(named, ["run_id", "topic_id"], n, F.col("weight").desc(), F.col("term"))
    return ranked.select("run_id", "topic_id", "rank", "term", F.round("weight", 4).alias("weight"))


def document_topics(weights: DataFrame, w: str = "w") -> DataFrame:
    """Normalised weights: (doc_id, dominant_topic, dominant_probability, topic_distribution). A row of zeros
    has topic 0 and probability 0."""
    total = F.aggregate(F.col(w), F.lit(0.0), lambda acc, x: acc + x) + EPSILON
    shares = weights.select("doc_id", F.transform(w, lambda x: x / total).alias("p"))
    return shares.select(
        "doc_id",
        argmax(F.col("p")).alias("dominant_topic"),
        F.round(F.array_max("p"), 4).alias("dominant_probability"),
        F.transform("p", lambda x: F.round(x, 4)).alias("topic_distribution"),
    )


def dominant_topic(weights: DataFrame, w: str = "w") -> DataFrame:
    return weights.select("doc_id", argmax(F.col(w)).alias("dominant_topic"))


def reconstruction_error(entries: DataFrame, doc_weights: DataFrame, topic_terms: DataFrame) -> DataFrame:
    """Frobenius norm of X - W H from long tables (doc_id, term, w), (doc_id, topic_id, weight) and
    (topic_id, term, weight), without forming W H: sum x^2 - 2 sum x (WH) + trace(W'W HH').
    W and H are read twice and kept until the result, which is cached, is known."""
    from topicloom.runtime import bounded

    docs = doc_weights.select("doc_id", "topic_id", F.col("weight").alias("dw")).persist()
    terms = topic_terms.select("topic_id", "term", F.col("weight").alias("tw")).persist()

    # An entry meets the topics of its term only. Its products are added up for each document and topic before they meet the
    # document's weights, so the join by document is of k + 1 rows a document; the row without a topic is of the other terms.
    per_doc = docs.groupBy("doc_id").agg(F.map_from_entries(F.collect_list(F.struct("topic_id", "dw"))).alias("dm"))
    per_term = terms.groupBy("term").agg(F.collect_list(F.struct("topic_id", "tw")).alias("ts"))
    met = entries.join(bounded(per_term), "term", "left").select("doc_id", "w", F.posexplode_outer("ts").alias("i", "t"))
    square = F.when(F.coalesce("i", F.lit(0)) == 0, F.col("w") * F.col("w"))
    products = met.groupBy("doc_id", F.col("t.topic_id").alias("topic_id")).agg(
        F.sum(F.col("w") * F.col("t.tw")).alias("p"), F.coalesce(F.sum(square), F.lit(0.0)).alias("s")
    )
    weight = F.coalesce(F.try_element_at("dm", F.col("topic_id")), F.lit(0.0))
    part = F.col("s") - 2 * F.coalesce("p", F.lit(0.0)) * weight
    sums = products.join(per_doc, "doc_id", "left").agg(F.coalesce(F.sum(part), F.lit(0.0))).scalar()
    gram_w, gram_h = _gram(docs, "doc_id", "dw"), _gram(terms, "term", "tw")
    gram = gram_w.join(gram_h.withColumnRenamed("g", "gh"), ["t1", "t2"])
    trace = F.coalesce(F.sum(F.col("g") * F.col("gh")), F.lit(0.0))
    error = F.sqrt(F.greatest(sums + F.col("trace"), F.lit(0.0))).alias("reconstruction_error")
    found = gram.agg(trace.alias("trace")).select(error).persist()
    found.count()
    docs.unpersist()
    terms.unpersist()
    return found


def _gram(rows: DataFrame, key: str, value: str) -> DataFrame:
    """Sums over ``key`` of products of topic weights: (t1, t2, g); k x k per key, k being small."""
    packed = rows.groupBy(key).agg(F.collect_list(F.struct("topic_id", value)).alias("e"))
    first = packed.select("e", F.explode("e").alias("x")).select("x", F.explode("e").alias("y"))
    return first.groupBy(F.col("x.topic_id").alias("t1"), F.col("y.topic_id").alias("t2")).agg(
        F.sum(F.col(f"x.{value}") * F.col(f"y.{value}")).alias("g")
    )


def _from_products(target: np.ndarray, gram: np.ndarray, params: NmfParams) -> np.ndarray:
    """The rows of W from their products with H."""
    l1, l2 = params.alpha_w * params.l1_ratio, params.alpha_w * (1 - params.l1_ratio)
    w = target / (gram.sum(axis=1) + EPSILON)
    for _ in range(params.inner_iter):
        w *= np.maximum(target - l1, 0) / (w @ gram + l2 * w + EPSILON)
    return w


def _from_entries(values: np.ndarray, hs: np.ndarray, mass: np.ndarray, params: NmfParams) -> tuple[np.ndarray, np.ndarray]:
    """The rows of W, and W H at their entries, from entries (rows x entries) and their columns of H (rows x k x entries)."""
    l1, l2 = params.alpha_w * params.l1_ratio, params.alpha_w * (1 - params.l1_ratio)
    w = np.matmul(hs, values[:, :, None])[:, :, 0] / (mass * mass.mean() + EPSILON)
    for _ in range(params.inner_iter):
        ratio = values / (np.matmul(w[:, None, :], hs)[:, 0] + EPSILON)
        w *= np.matmul(hs, ratio[:, :, None])[:, :, 0] / (mass + l1 + l2 * w + EPSILON)
    return w, np.matmul(w[:, None, :], hs)[:, 0]


def _like_rows(lengths: np.ndarray, k: int, cells: int | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, places): rows of like length together with the places of their entries (rows x most entries). A row that is shorter
    is filled up with the place behind the last entry, at most a quarter and a few of its length. Together they
    have ``cells`` topic weights (BLOCK unless given)."""
    order, total = np.argsort(lengths, kind="stable"), int(lengths.sum())
    sizes, starts, a = lengths[order], (np.cumsum(lengths) - lengths)[order], int(np.searchsorted(lengths[order], 1))
    while a < len(order):
        like = int(np.searchsorted(sizes, sizes[a] + sizes[a] // 4 + 4, "right"))
        b = min(like, a + max(1, (cells or BLOCK) // (k * int(sizes[like - 1]))))
        steps = np.arange(sizes[b - 1])
        yield order[a:b], np.where(steps < sizes[a:b, None], starts[a:b, None] + steps, total)
        a = b


def _solve(columns: np.ndarray, values: np.ndarray, lengths: np.ndarray, h: np.ndarray, ht: np.ndarray, params: NmfParams) -> tuple[np.ndarray, np.ndarray]:
    """The rows of W, and with them the products X H' (Frobenius) or W H at the entries (Kullback-Leibler). ``ht`` is H', row by row."""
    columns, values = np.append(columns, 0), np.append(values, 0.0)
    w = np.zeros((len(lengths), len(h)))
    if params.beta_loss == "frobenius":
        for rows, places in _like_rows(lengths, len(h)):
            w[rows] = np.matmul(values[places][:, None, :], ht[columns[places]])[:, 0]
        return _from_products(w, h @ ht, params), w
    fitted, mass = np.empty(len(values)), h.sum(axis=1)
    for rows, places in _like_rows(lengths, len(h)):
        hs = np.ascontiguousarray(ht[columns[places]].transpose(0, 2, 1))
        w[rows], fitted[places] = _from_entries(values[places], hs, mass, params)
    return w, fitted[:-1]


def _pieces(batch: pa.RecordBatch, entries: int) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows of about so many entries, which bounds the memory of a task."""
    offsets, start = batch.column("idx").offsets.to_numpy(), 0
    while start < batch.num_rows:
        stop = max(int(np.searchsorted(offsets, offsets[start] + entries, side="right")) - 1, start + 1)
        yield batch.slice(start, stop - start)
        start = stop


def _entries(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Columns and values of the entries, and the number of each row's."""
    columns, lengths = flat(batch.column("idx"))
    return columns, flat(batch.column("val"))[0], lengths


def solve_rows(rows: DataFrame, h: np.ndarray, params: NmfParams) -> DataFrame:
    """Topic weights (doc_id, w) of sparse documents for a fixed H; documents are independent."""
    shared = rows.sparkSession.sparkContext.broadcast(h)
    entries = max(1, PIECE // params.k)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        h, ht = shared.value, np.ascontiguousarray(shared.value.T)
        for part in (p for batch in batches for p in _pieces(batch, entries)):
            w, _ = _solve(*_entries(part), h, ht, params)
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), lists(w.ravel(), np.full(len(w), w.shape[1]))], names=["doc_id", "w"])

    id_type = dict(rows.dtypes)["doc_id"]
    return rows.select("doc_id", "idx", "val").mapInArrow(score, f"doc_id {id_type}, w array<double>")


def _passes(rows: DataFrame, factors: Sequence[np.ndarray], settings: Sequence[NmfParams]) -> list[tuple[np.ndarray, np.ndarray, float]]:
    """One read of the rows for several models: solve W for each H and return the sums for its update and the loss at (W, H).
    A task sends only slices of sums that its terms touch."""
    shared = rows.sparkSession.sparkContext.broadcast(list(factors))
    chunk, eps = CHUNK, EPSILON
    entries = max(1, PIECE // max(p.k for p in settings))

    def partial_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for part in (p for batch in batches for p in _pieces(batch, entries)):
            held = held or [(h, np.ascontiguousarray(h.T), np.zeros(h.shape), np.zeros((len(h), len(h))), np.zeros(1)) for h in shared.value]
            c, v, lengths = _entries(part)
            for p, (h, ht, upper, lower, loss) in zip(settings, held):
                w, found = _solve(c, v, lengths, h, ht, p)
                if p.beta_loss == "frobenius":
                    gram = w.T @ w
                    loss += (v * v).sum() / 2 - (w * found).sum() + (gram * (h @ ht)).sum() / 2
                    lower += gram
                    scale = v
                else:
                    scale = v / (found + eps)
                    loss += (v * np.log(scale) - v).sum() + (w @ h.sum(axis=1)).sum()
                    lower[:, 0] += w.sum(axis=0)
                loss += p.alpha_w * (p.l1_ratio * w.sum() + (1 - p.l1_ratio) * (w * w).sum() / 2)
                for t in range(len(h)):
                    upper[t] += np.bincount(c, scale * np.repeat(w[:, t], lengths), h.shape[1])
        # Topics 0..k-1 hold slices of the upper sums, topic k the lower sums and the loss.
        for m, (_, _, upper, lower, loss) in enumerate(held or []):
            k, width = upper.shape
            sums = [(t, i, upper[t, i * chunk : (i + 1) * chunk]) for t in range(k) for i in range(-(-width // chunk))]
            sums = [s for s in sums if s[2].any()] + [(k, 0, np.append(lower.ravel(), loss))]
            topic, part, values = zip(*sums)
            yield pa.RecordBatch.from_arrays(
                [pa.array([m] * len(sums), pa.int32()), pa.array(topic, pa.int32()), pa.array(part, pa.int32()), pa.array(values, pa.list_(pa.float64()))],
                names=["model", "topic", "part", "sums"],
            )

    partial = rows.select("idx", "val").mapInArrow(partial_sums, "model int, topic int, part int, sums array<double>")
    out = [[np.zeros(h.shape), np.zeros((len(h), len(h))), 0.0] for h in factors]
    sums = added(partial, "sums", "model", "topic", "part").toArrow()  # k x V numbers of each, within FACTOR_CELL_LIMIT
    values, lengths = flat(sums["sums"])
    ends = np.cumsum(lengths)
    for model, topic, part, a, b in zip(*(sums[c].to_pylist() for c in ("model", "topic", "part")), (ends - lengths).tolist(), ends.tolist()):
        own, k = out[model], len(factors[model])
        if topic == k:
            own[1], own[2] = values[a : b - 1].reshape(k, k), float(values[b - 1])
        else:
            own[0][topic, part * CHUNK : part * CHUNK + b - a] = values[a:b]
    shared.unpersist()
    return [tuple(o) for o in out]


def _pass(rows: DataFrame, h: np.ndarray, params: NmfParams) -> tuple[np.ndarray, np.ndarray, float]:
    return _passes(rows, [h], [params])[0]


def check_matrix(rows: DataFrame, width: int) -> tuple[int, int, float]:
    """Reject an empty or all-zero matrix; returns documents, entries and sum."""
    total = F.coalesce(F.sum(F.aggregate("val", F.lit(0.0), lambda acc, x: acc + x)), F.lit(0.0))
    entries = F.coalesce(F.sum(F.size("idx")), F.lit(0))
    found = rows.agg(F.count(F.lit(1)).alias("n"), entries.alias("entries"), total.alias("total")).first()
    if found.n == 0 or width == 0:
        raise DataValidationError("the matrix is empty")
    if found.total == 0:
        raise DataValidationError("the matrix holds only zeros")
    return found.n, found.entries, found.total


def _start(params: NmfParams, scale: float, part: int, columns: int) -> np.ndarray:
    """Seeded random weights of a term range."""
    return scale * np.abs(np.random.default_rng([params.seed, part]).standard_normal((params.k, columns)))


def fit_nmf(rows: DataFrame, vocab: DataFrame, params: NmfParams | None = None, **options: Any) -> NmfModel:
    """Factor (doc_id, idx, val) over ``vocab`` (term_id, term). Stops when the loss falls by less than ``tol`` of
    its first value between passes. Rows are cached for the passes unless they are already."""
    return fit_models(rows, vocab, [params or NmfParams(**options)])[0]


def fit_models(rows: DataFrame, vocab: DataFrame, settings: Sequence[NmfParams]) -> list[NmfModel]:
    """The models of several settings, from shared passes: as many together as FACTOR_CELL_LIMIT cells hold. A model that is done
    drops out of the later passes. One beyond the limit is factored by term ranges, on its own."""
    width = vocab.count()
    cached = rows.storageLevel.useMemory or rows.storageLevel.useDisk
    if not cached:
        rows = rows.persist()
    try:
        n, entries, total = check_matrix(rows, width)
        groups: list[list[int]] = [[]]
        room = FACTOR_CELL_LIMIT
        for i, p in enumerate(settings):
            if p.k * width > FACTOR_CELL_LIMIT:
                continue
            if p.k * width > room:
                groups.append([])
                room = FACTOR_CELL_LIMIT
            groups[-1].append(i)
            room -= p.k * width
        models: dict[int, NmfModel] = {}
        for group in filter(None, groups):
            chosen = [settings[i] for i in group]
            work = entries * sum(p.k * p.inner_iter for p in chosen)
            cores = rows.sparkSession.sparkContext.defaultParallelism
            passes = merge_partitions(rows, work // PIECE)
            placed = spread_partitions(passes, min(cores, work // CORE_WORK))
            if placed is not passes:
                placed = placed.persist()
            models.update(zip(group, _fit_together(placed, vocab, chosen, width, n, total)))
            if placed is not passes:
                placed.unpersist()
        for i, p in enumerate(settings):
            if i not in models:
                models[i] = _fit_by_ranges(rows, vocab, p, width, n, total)
    finally:
        if not cached:
            rows.unpersist()
    return [models[i] for i in range(len(settings))]


def _penalties(params: NmfParams) -> tuple[float, float]:
    return params.alpha_h * params.l1_ratio, params.alpha_h * (1 - params.l1_ratio)


def _ends(losses: list[float], params: NmfParams) -> bool:
    return len(losses) > 1 and (losses[-2] - losses[-1]) < params.tol * losses[0]


def _model(params: NmfParams, vocab: DataFrame, losses: list[float], final: float, h: np.ndarray | None, table: DataFrame | None = None) -> NmfModel:
    return NmfModel(params, h, vocab.select("term_id", "term"), losses, float(np.sqrt(max(2 * final, 0.0))), table)


def _fit_together(rows: DataFrame, vocab: DataFrame, settings: Sequence[NmfParams], width: int, n: int, total: float) -> list[NmfModel]:
    factors = []
    for p in settings:
        scale, size = np.sqrt(total / (n * width) / p.k), width_of(p.k)
        factors.append(np.hstack([_start(p, scale, part, min(size, width - part * size)) for part in range(-(-width // size))]))
    losses: list[list[float]] = [[] for _ in settings]
    final: dict[int, float] = {}
    live = list(range(len(settings)))
    while live:
        found = _passes(rows, [factors[i] for i in live], [settings[i] for i in live])
        for i, (upper, lower, loss) in zip(list(live), found):
            p, h = settings[i], factors[i]
            l1, l2 = _penalties(p)
            if len(losses[i]) < p.max_iter:
                losses[i].append(float(loss + l1 * h.sum() + l2 * (h * h).sum() / 2))
                if not _ends(losses[i], p):
                    factors[i] = _update_h(h, upper, lower, p, l1, l2)
                    continue
            final[i] = loss
            live.remove(i)
    if not all(h.any() for h in factors):
        raise DataValidationError("all topic weights are zero")
    return [_model(p, vocab, losses[i], final[i], factors[i]) for i, p in enumerate(settings)]


def _update_h(h, upper, lower, params: NmfParams, l1: float, l2: float) -> np.ndarray:
    """Multiplicative steps on H for fixed W; with W'W at hand further steps cost no pass over the data. Terms are independent."""
    if params.beta_loss != "frobenius":
        return h * upper / (lower[:, :1] + l1 + l2 * h + EPSILON)
    for _ in range(params.inner_iter):
        h = h * np.maximum(upper - l1, 0) / (lower @ h + l2 * h + EPSILON)
    return h


# --- factors as term ranges


def _about(table: DataFrame, k: int) -> tuple[np.ndarray, np.ndarray]:
    """HH' and the sums of the rows of H."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.column(0):
                m = np.asarray(row.values).reshape(k, -1)
                both = np.append((m @ m.T).ravel(), m.sum(axis=1))
                yield pa.record_batch([lists(both, np.array([len(both)]))], ["s"])

    sums = np.array(summed(table.select("m").mapInArrow(run, "s array<double>"), "s").first().s)
    return sums[: k * k].reshape(k, k), sums[k * k :]


def _solved_products(products: DataFrame, params: NmfParams, gram: np.ndarray) -> DataFrame:
    """(doc_id, w, dot): the rows of W from (doc_id, t), and the products of w and t."""
    k = params.k

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            t = flat(batch.column("t"))[0].reshape(-1, k)
            w = _from_products(t, gram, params)
            yield pa.record_batch([batch.column("doc_id"), lists(w.ravel(), np.full(len(w), k)), pa.array((w * t).sum(axis=1))], ["doc_id", "w", "dot"])

    return products.mapInArrow(run, f"doc_id {dict(products.dtypes)['doc_id']}, w array<double>, dot double")


def _solved_pieces(gathered: DataFrame, params: NmfParams, mass: np.ndarray) -> DataFrame:
    """(doc_id, part, cut, idx, scale, w, loss): the rows of W from the pieces of each document, its loss with the first."""
    k, eps = params.k, EPSILON
    fields = ["doc_id", "part", "cut", "idx", "scale", "w", "loss"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row, batch in ((r, b) for b in batches for r in range(b.num_rows)):
            pieces = batch.column("pieces")[row].values
            values, lengths = flat(pieces.field("val"))
            hs = np.ascontiguousarray(flat(pieces.field("m"))[0].reshape(-1, k).T)
            w, (fitted,) = _from_entries(values[None], hs[None], mass, params)
            loss = (values * np.log(values / (fitted + eps)) - values).sum() + w[0] @ mass
            loss += params.alpha_w * (params.l1_ratio * w.sum() + (1 - params.l1_ratio) * (w * w).sum() / 2)
            n = len(pieces)
            yield pa.record_batch(
                [
                    pa.array([batch.column("doc_id")[row].as_py()] * n, batch.column("doc_id").type), pieces.field("part"), pieces.field("cut"),
                    pieces.field("idx"), lists(values / (fitted + eps), lengths), lists(np.tile(w[0], n), np.full(n, k)),
                    pa.array([loss, *[None] * (n - 1)], pa.float64()),
                ],
                fields,
            )

    schema = f"doc_id {dict(gathered.dtypes)['doc_id']}, part int, cut int, idx array<int>, scale array<double>, w array<double>, loss double"
    return gathered.mapInArrow(run, schema)


def _pass_by_ranges(ranged: RangedRows, table: DataFrame, params: NmfParams, squares: float) -> tuple[DataFrame, np.ndarray, float]:
    """As ``_pass``, with H and the sums for its update as tables (part, m). ``squares`` is the sum of the squared entries."""
    k = params.k
    gram, mass = _about(table, k)
    if params.beta_loss == "frobenius":
        solved = _solved_products(ranged.project(table), params, gram).persist()

        def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros(k * k + 1)
            for batch in batches:
                w = flat(batch.column("w"))[0].reshape(-1, k)
                penalty = params.alpha_w * (params.l1_ratio * w.sum() + (1 - params.l1_ratio) * (w * w).sum() / 2)
                total += np.append((w.T @ w).ravel(), penalty - batch.column("dot").to_numpy().sum())
            yield pa.record_batch([lists(total, np.array([len(total)]))], ["s"])

        found = np.array(summed(solved.select("w", "dot").mapInArrow(sums, "s array<double>"), "s").first().s)
        lower = found[:-1].reshape(k, k)
        loss = squares / 2 + found[-1] + (lower * gram).sum() / 2
        upper = cut_lineage(ranged.scatter(solved.select("doc_id", "w")))
    else:
        solved = _solved_pieces(ranged.gather(table), params, mass).persist()
        weights = [F.sum(F.when(F.col("loss").isNotNull(), F.col("w")[t])).alias(f"w{t}") for t in range(k)]
        found = solved.agg(F.sum("loss").alias("loss"), *weights).first()
        lower = np.zeros((k, k))
        lower[:, 0] = [found[f"w{t}"] for t in range(k)]
        loss = found["loss"]
        upper = cut_lineage(ranged.scatter_pieces(solved))
    solved.unpersist()
    return upper, lower, loss


def _update_by_ranges(table: DataFrame, upper: DataFrame, lower: np.ndarray, params: NmfParams) -> DataFrame:
    """The next H, range by range."""
    (l1, l2), k = _penalties(params), params.k

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, h, u in zip(*batch.columns):
                h = np.asarray(h.values).reshape(k, -1)
                u = np.asarray(u.values).reshape(k, -1) if u.is_valid else np.zeros(h.shape)
                h = _update_h(h, u, lower, params, l1, l2)
                yield pa.record_batch([pa.array([part.as_py()], pa.int32()), lists(h.ravel(), np.array([h.size]))], ["part", "m"])

    both = table.join(upper.withColumnRenamed("m", "u"), "part", "left").select("part", "m", "u")
    return cut_lineage(both.mapInArrow(run, MATRIX))


def _fit_by_ranges(rows: DataFrame, vocab: DataFrame, params: NmfParams, width: int, n: int, total: float) -> NmfModel:
    l1, l2 = _penalties(params)
    scale = np.sqrt(total / (n * width) / params.k)
    table = cut_lineage(table_of(rows.sparkSession, params.k, width, lambda part, columns: _start(params, scale, part, columns)))
    squares = rows.agg(F.sum(F.aggregate("val", F.lit(0.0), lambda acc, x: acc + x * x))).first()[0]
    ranged = RangedRows(rows, params.k, max(1, PIECE // params.k))
    losses: list[float] = []
    while True:
        upper, lower, loss = _pass_by_ranges(ranged, table, params, squares)
        if len(losses) == params.max_iter:
            break
        gram, mass = _about(table, params.k)
        losses.append(float(loss + l1 * mass.sum() + l2 * np.trace(gram) / 2))
        if _ends(losses, params):
            break
        table = _update_by_ranges(table, upper, lower, params)
    ranged.unpersist()
    if not _about(table, params.k)[1].any():
        raise DataValidationError("all topic weights are zero")
    return _model(params, vocab, losses, loss, None, table)


def solve_rows_by_ranges(rows: DataFrame, table: DataFrame, params: NmfParams) -> DataFrame:
    """As ``solve_rows``, for H as rows (part, m) of term ranges."""
    ranged = RangedRows(rows, params.k, max(1, PIECE // params.k))
    gram, mass = _about(table, params.k)
    if params.beta_loss == "frobenius":
        found = _solved_products(ranged.project(table), params, gram).select("doc_id", "w")
    else:
        found = _solved_pieces(ranged.gather(table), params, mass).filter("loss IS NOT NULL").select("doc_id", "w")
    none = F.array_repeat(F.lit(0.0), params.k)
    return rows.select("doc_id").join(found, "doc_id", "left").select("doc_id", F.coalesce("w", none).alias("w"))


def save_nmf(model: NmfModel, path: str) -> str:
    """Three Parquet tables: term ranges of H, vocabulary and parameters."""
    spark = model.vocab.sparkSession
    model.ranges().write.mode("overwrite").parquet(f"{path}/h")
    model.vocab.write.mode("overwrite").parquet(f"{path}/vocab")
    p = model.params
    record = (p.k, p.max_iter, p.tol, p.beta_loss, p.alpha_w, p.alpha_h, p.l1_ratio, p.inner_iter, p.seed,
              [float(x) for x in model.losses], model.reconstruction_error)
    spark.createDataFrame(
        [record],
        "k int, max_iter int, tol double, beta_loss string, alpha_w double, alpha_h double, l1_ratio double, "
        "inner_iter int, seed int, losses array<double>, reconstruction_error double",
    ).write.mode("overwrite").parquet(f"{path}/params")
    return path


def load_nmf(spark: SparkSession, path: str) -> NmfModel:
    record = spark.read.parquet(f"{path}/params").first().asDict()
    losses, error = record.pop("losses"), record.pop("reconstruction_error")
    params, vocab, table = NmfParams(**record), spark.read.parquet(f"{path}/vocab"), spark.read.parquet(f"{path}/h")
    width = vocab.count()
    if params.k * width > FACTOR_CELL_LIMIT:
        return NmfModel(params, None, vocab, losses, error, table)
    blocks = [np.array(r.m).reshape(params.k, -1) for r in table.orderBy("part").collect()]
    return NmfModel(params, np.hstack(blocks)[:, :width], vocab, losses, error)
