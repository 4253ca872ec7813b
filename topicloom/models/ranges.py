"""A k x V matrix as a distributed table of column ranges, and sparse rows cut along them.

No task and no driver holds the matrix: a range meets the entries of its columns in a slice, a group of bounded size, and a
range of many entries has several slices. What a document needs of the matrix, or gives to it, moves as one row for each
document and range."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from topicloom.runtime import bounded, cut_lineage

MATRIX = "part int, m array<double>"


def width_of(k: int) -> int:
    """Columns of a range: some 400 KB of numbers."""
    return max(64, 50_000 // k)


def lists(values: np.ndarray, sizes: np.ndarray) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))


def flat(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Values and lengths of a list column."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks() if column.num_chunks else pa.array([], column.type)
    return column.flatten().to_numpy(zero_copy_only=False), np.diff(column.offsets.to_numpy())


def by_row(rows: np.ndarray, contributions: np.ndarray, n: int) -> np.ndarray:
    """Sums of the contributions (entries x k) over the entries of each row."""
    return np.stack([np.bincount(rows, contributions[:, t], n) for t in range(contributions.shape[1])], axis=1)


def table_of(spark: SparkSession, k: int, width: int, block) -> DataFrame:
    """The matrix (part, m) whose ranges ``block(part, columns)`` makes, k x columns each; the rest of the last range is 0."""
    size = width_of(k)

    def run(batches):
        for batch in batches:
            for part in batch.column(0).to_pylist():
                m = np.zeros((k, size))
                columns = min(size, width - part * size)
                m[:, :columns] = block(part, columns)
                yield pa.record_batch([pa.array([part], pa.int32()), pa.array([m.ravel()], pa.list_(pa.float64()))], ["part", "m"])

    return spark.range(-(-width // size)).mapInArrow(run, MATRIX)


def entries_of(matrix: DataFrame, k: int) -> DataFrame:
    """(topic_id, term_id, weight) of the matrix, the rest of the last range included."""
    size = width_of(k)
    cells = matrix.select("part", F.posexplode("m").alias("pos", "weight"))
    column = F.col("part").cast("bigint") * size + F.col("pos") % size
    return cells.select(F.floor(F.col("pos") / size).cast("int").alias("topic_id"), column.alias("term_id"), "weight")


def summed(arrays: DataFrame, column: str, *keys: str) -> DataFrame:
    """Elementwise sums of equally long arrays, combined in the map tasks."""
    return arrays.groupBy(*keys).agg(vector_to_array(Summarizer.sum(array_to_vector(column))).alias(column))


def added(arrays: DataFrame, column: str, *keys: str) -> DataFrame:
    """As ``summed`` for many numbers: equal keys (integers) meet in a task, which adds whole arrays."""
    schema = ", ".join([*(f"{k} int" for k in keys), f"{column} array<double>"])

    def run(batches):
        held: dict[tuple, np.ndarray] = {}
        for batch in batches:
            values, lengths = flat(batch.column(column))
            ends = np.cumsum(lengths)
            for key, a, b in zip(zip(*(batch.column(k).to_pylist() for k in keys)), (ends - lengths).tolist(), ends.tolist()):
                if key in held:
                    held[key] += values[a:b]
                else:
                    held[key] = values[a:b].copy()
        order = list(held)
        for a in range(0, len(order), 500):
            some = order[a : a + 500]
            rows = [pa.array(k, pa.int32()) for k in zip(*some)]
            yield pa.record_batch([*rows, lists(np.concatenate([held[k] for k in some]), np.array([len(held[k]) for k in some]))], [*keys, column])

    return arrays.select(*keys, column).repartition(*keys).mapInArrow(run, schema)


class RangedRows:
    """Sparse rows (doc_id, idx, val), doc_id unique, cut into (part, cut, doc_id, idx, val) and kept in the partitions of their slices. A slice
    holds about ``entries`` entries."""

    def __init__(self, rows: DataFrame, k: int, entries: int):
        self.k, self.size = k, width_of(k)
        self.id_type = dict(rows.dtypes)["doc_id"]
        self.rows = rows
        split = self._split(rows).persist()
        cuts = split.groupBy("part").agg(F.sum(F.size("idx")).alias("n")).select("part", F.ceil(F.col("n") / entries).cast("int").alias("cuts"))
        self.cuts = cut_lineage(cuts)  # a row for each range
        cut = F.pmod(F.xxhash64("doc_id"), F.col("cuts")).cast("int").alias("cut")
        self.cells = split.join(bounded(self.cuts), "part").select("part", cut, "doc_id", "idx", "val").repartition("part", "cut").persist()
        self.cells.count()
        split.unpersist()

    def unpersist(self) -> None:
        self.cells.unpersist()
        self.cuts.unpersist()

    def _split(self, rows: DataFrame) -> DataFrame:
        size = self.size

        def run(batches):
            for batch in batches:
                columns, lengths = flat(batch.column("idx"))
                values, _ = flat(batch.column("val"))
                row = np.repeat(np.arange(batch.num_rows), lengths)
                part = columns // size
                order = np.lexsort((part, row))
                row, part, columns, values = row[order], part[order], columns[order], values[order]
                first = np.flatnonzero(np.concatenate([[True], (row[1:] != row[:-1]) | (part[1:] != part[:-1])])[: len(row)])
                sizes = np.diff(np.append(first, len(row)))
                yield pa.record_batch(
                    [batch.column("doc_id").take(pa.array(row[first])), pa.array(part[first], pa.int32()), lists((columns - part * size).astype(np.int32), sizes), lists(values, sizes)],
                    ["doc_id", "part", "idx", "val"],
                )

        return rows.select("doc_id", "idx", "val").mapInArrow(run, f"doc_id {self.id_type}, part int, idx array<int>, val array<double>")

    def _met(self, matrix: DataFrame, run, schema: str) -> DataFrame:
        """``run`` over each slice and its range of the matrix."""
        spread = matrix.join(bounded(self.cuts), "part").select(F.col("part").alias("p"), F.explode(F.sequence(F.lit(0), F.col("cuts") - 1)).alias("c"), "m")
        return self.cells.groupBy("part", "cut").cogroup(spread.groupBy("p", "c")).applyInArrow(run, schema)

    def project(self, matrix: DataFrame) -> DataFrame:
        """(doc_id, t): the product of each row with the k rows of the matrix."""
        k, size = self.k, self.size

        def run(left: pa.Table, right: pa.Table) -> pa.Table:
            columns, lengths = flat(left["idx"])
            values, _ = flat(left["val"])
            t = np.zeros((left.num_rows, k))
            if left.num_rows:
                m = flat(right["m"])[0].reshape(k, size)
                t = by_row(np.repeat(np.arange(left.num_rows), lengths), values[:, None] * m.T[columns], left.num_rows)
            return pa.table({"doc_id": left["doc_id"], "t": lists(t.ravel(), np.full(left.num_rows, k))})

        parts = self._met(matrix, run, f"doc_id {self.id_type}, t array<double>")
        sums = parts.groupBy("doc_id").agg(*[F.sum(F.col("t")[i]).alias(f"t{i}") for i in range(k)])
        return sums.select("doc_id", F.array(*[f"t{i}" for i in range(k)]).alias("t"))

    def gather(self, matrix: DataFrame) -> DataFrame:
        """(doc_id, pieces): each row with the columns of the matrix it needs, as pieces (part, cut, idx, val, m), m being entries x k."""
        k, size = self.k, self.size

        def run(left: pa.Table, right: pa.Table) -> pa.Table:
            columns, lengths = flat(left["idx"])
            m = flat(right["m"])[0].reshape(k, size).T[columns] if left.num_rows else np.zeros((0, k))
            return left.append_column("m", lists(m.ravel(), lengths * k))

        parts = self._met(matrix, run, f"part int, cut int, doc_id {self.id_type}, idx array<int>, val array<double>, m array<double>")
        return parts.groupBy("doc_id").agg(F.collect_list(F.struct("part", "cut", "idx", "val", "m")).alias("pieces"))

    def scatter(self, weights: DataFrame) -> DataFrame:
        """The matrix (part, m) of the sums of weight times entry: W'X of weights (doc_id, w)."""
        k, size = self.k, self.size

        def run(left: pa.Table, right: pa.Table) -> pa.Table:
            columns, lengths = flat(left["idx"])
            values, _ = flat(left["val"])
            m = np.zeros((k, size))
            if left.num_rows:
                w = flat(right["w"])[0].reshape(-1, k)
                row = np.repeat(pc.index_in(left["doc_id"], right["doc_id"].combine_chunks()).to_numpy(), lengths)
                for t in range(k):
                    m[t] = np.bincount(columns, values * w[row, t], size)
            return pa.table({"part": left["part"].slice(0, 1), "m": lists(m.ravel(), np.array([k * size]))}) if left.num_rows else left.select(["part"]).append_column("m", lists(m[:0].ravel(), np.zeros(0, int)))

        sent = weights.join(self.cells.select("doc_id", F.col("part").alias("p"), F.col("cut").alias("c")), "doc_id")
        met = self.cells.groupBy("part", "cut").cogroup(sent.groupBy("p", "c")).applyInArrow(run, MATRIX)
        return added(met, "m", "part")

    def scatter_pieces(self, pieces: DataFrame) -> DataFrame:
        """As ``scatter``, of pieces (part, cut, idx, scale, w) that carry their own factor of each entry."""
        k, size = self.k, self.size

        def run(group: pa.Table) -> pa.Table:
            columns, lengths = flat(group["idx"])
            scale, _ = flat(group["scale"])
            w = np.repeat(flat(group["w"])[0].reshape(-1, k), lengths, axis=0)
            m = np.stack([np.bincount(columns, scale * w[:, t], size) for t in range(k)])
            return pa.table({"part": group["part"].slice(0, 1), "m": lists(m.ravel(), np.array([k * size]))})

        sent = pieces.select("part", "cut", "idx", "scale", "w")
        return added(sent.groupBy("part", "cut").applyInArrow(run, MATRIX), "m", "part")
