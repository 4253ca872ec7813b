"""Centroid clustering in exact integers, by equal-average equal-variance search.

Centroids stand sorted by the sum of their components (their mean). A vector starts between the two of nearest sum and looks
outwards: a centroid whose sum alone is too far ends the scan, one whose deviation is too far is left out, and only the rest
are measured component by component. Both inequalities reject only what is strictly farther than the best so far, so the
nearest centroid (the smaller number on a tie) is the one a full comparison finds.

Vectors stay where they are read: a pass sends k x (dimension + 1) sums of each task, never a vector."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from topicloom.llm.staging import stage

DIMENSION = 64
SCALE = 256
CENTROIDS = 40
ROUNDS = 5
SALT = "2"


def integer_vectors(table: DataFrame, dimension: int = DIMENSION, scale: int = SCALE, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(vec_id, x): the vectors of exactly ``dimension`` components, none null or non-finite, each component as
    floor(scale * component). Other columns are not read. A null key stays; rows that repeat stay as vectors of their own."""
    raw = table.select(F.col(key).alias("vec_id"), F.col(vector).alias("e"))
    sound = (F.size("e") == dimension) & F.forall("e", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return raw.filter(sound).select("vec_id", F.transform("e", lambda v: F.floor(v.cast("double") * F.lit(float(scale)))).alias("x"))


def _matrix(column: pa.Array, dimension: int) -> np.ndarray:
    x = column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dimension)
    # squares of differences, times the dimension, stay within 62 bits
    if x.size and max(int(x.max()), -int(x.min())) > (1 << 30) // dimension:
        raise ValueError(f"a component is beyond {(1 << 30) // dimension}; use a smaller scale")
    return x


class Scan:
    """Centroids in the order of their sums."""

    def __init__(self, centroids: np.ndarray):
        sums = centroids.sum(axis=1)
        self.number = np.argsort(sums, kind="stable")
        self.points = centroids[self.number]
        self.sums = sums[self.number]
        self.spread = self._spread(self.points, self.sums)

    @staticmethod
    def _spread(x: np.ndarray, sums: np.ndarray) -> np.ndarray:
        """The root of dimension * sum of squared deviations from the mean."""
        return np.sqrt((x.shape[1] * np.einsum("ij,ij->i", x, x) - sums * sums).astype(np.float64))

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """Centroid and squared distance of each vector, and how many distances were measured."""
        n, d = x.shape
        k = len(self.sums)
        sums = x.sum(axis=1)
        spread = self._spread(x, sums)
        best = np.full(n, np.iinfo(np.int64).max)  # d times the squared distance
        found = np.full(n, k)
        high = np.searchsorted(self.sums, sums)
        low = high - 1
        far = (1 << 31) + 1  # beyond any difference of two sums
        live, measured = np.arange(n), 0
        while len(live):
            a, b = low[live], high[live]
            down = np.where(a >= 0, sums[live] - self.sums[a], far)
            up = np.where(b < k, self.sums[np.minimum(b, k - 1)] - sums[live], far)
            gap = np.minimum(down, up)
            on = (gap < far) & (gap * gap <= best[live])  # farther sums lie beyond the nearer side
            live, gap, left = live[on], gap[on], (down <= up)[on]
            take = np.where(left, a[on], b[on])
            low[live[left]] -= 1
            high[live[~left]] += 1
            apart = np.abs(spread[live] - self.spread[take]) - 1e-14 * (spread[live] + self.spread[take])
            bound = gap.astype(np.float64) ** 2 + np.maximum(apart, 0) ** 2
            near = bound * (1 - 1e-12) <= best[live]
            rows, take = live[near], take[near]
            step = x[rows] - self.points[take]
            distance = d * np.einsum("ij,ij->i", step, step)
            measured += len(rows)
            number = self.number[take]
            better = (distance < best[rows]) | ((distance == best[rows]) & (number < found[rows]))
            best[rows[better]], found[rows[better]] = distance[better], number[better]
        return found, best // d, measured


def starts(vectors: DataFrame, k: int = CENTROIDS, salt: str = SALT) -> np.ndarray:
    """The k vectors of smallest sha256 of 'salt:vec_id', in that order (repeated ids: the smaller vector first); all vectors with an id
    if there are fewer. Only these k rows reach the driver."""
    named = vectors.filter("vec_id IS NOT NULL").withColumn("h", F.sha2(F.concat(F.lit(f"{salt}:"), F.col("vec_id").cast("string")), 256))
    rows = named.orderBy("h", "x").limit(k).select("x").collect()
    return np.array([r.x for r in rows], np.int64)


def update(vectors: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """One round: each vector to its nearest centroid, each centroid that has any to the exact floor of their mean."""
    d = centroids.shape[1]

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scan = Scan(centroids)
        total, count = np.zeros(centroids.shape, np.int64), np.zeros(len(centroids), np.int64)
        for batch in batches:
            x = _matrix(batch.column(0), d)
            found, _, _ = scan.nearest(x)
            order = np.argsort(found, kind="stable")
            used, first = np.unique(found[order], return_index=True)
            if len(used):
                total[used] += np.add.reduceat(x[order], first, axis=0)
                count += np.bincount(found, minlength=len(count))
        used = np.flatnonzero(count)
        cells = np.column_stack([total[used], count[used]])
        yield pa.record_batch(
            [pa.array(np.repeat(used, d + 1), pa.int32()), pa.array(np.tile(np.arange(d + 1), len(used)), pa.int32()), pa.array(cells.ravel(), pa.int64())],
            ["cluster", "part", "n"],
        )

    parts = vectors.select("x").mapInArrow(sums, "cluster int, part int, n bigint")
    added = parts.groupBy("cluster", "part").agg(F.sum(F.col("n").cast("decimal(38,0)")).alias("n")).collect()  # at most k x (d + 1) rows
    cells = {(r.cluster, r.part): int(r.n) for r in added}
    return np.array([[cells[c, i] // cells[c, d] for i in range(d)] if (c, d) in cells else row for c, row in enumerate(centroids.tolist())], np.int64).reshape(centroids.shape)


def assign(vectors: DataFrame, centroids: np.ndarray) -> DataFrame:
    """(vec_id, cluster, distance) of every vector."""
    key = vectors.schema["vec_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scan = Scan(centroids)
        for batch in batches:
            found, distance, _ = scan.nearest(_matrix(batch.column(1), centroids.shape[1]))
            yield pa.record_batch([batch.column(0), pa.array(found, pa.int32()), pa.array(distance, pa.int64())], ["vec_id", "cluster", "distance"])

    return vectors.select("vec_id", "x").mapInArrow(run, f"vec_id {key.dataType.simpleString()}, cluster int, distance bigint")


def cluster(table: DataFrame, k: int = CENTROIDS, rounds: int = ROUNDS, dimension: int = DIMENSION, scale: int = SCALE, salt: str = SALT) -> tuple[DataFrame, DataFrame]:
    """Vectors as (vec_id, cluster, distance) and centroids as (cluster, centroid, size, cluster_inertia, inertia), size and inertias of the last
    assignment. Without a sound vector with an id both are empty. A round that moves no centroid ends the rounds, as the
    later ones could not either."""
    spark = table.sparkSession
    vectors = stage(integer_vectors(table, dimension, scale))
    centroids = starts(vectors, k, salt)
    if not len(centroids):
        return _empty(spark, vectors)
    for _ in range(rounds):
        moved = update(vectors, centroids)
        if (moved == centroids).all():
            break
        centroids = moved
    found = stage(assign(vectors, centroids))
    sums = {r.cluster: r for r in found.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"), F.sum("distance").alias("d")).collect()}
    whole = sum(r.d for r in sums.values())
    rows = [(c, x, sums[c].n if c in sums else 0, sums[c].d if c in sums else 0, whole) for c, x in enumerate(centroids.tolist())]
    return found, spark.createDataFrame(rows, CENTROID_ROWS)


CENTROID_ROWS = "cluster int, centroid array<bigint>, size bigint, cluster_inertia bigint, inertia bigint"


def _empty(spark: SparkSession, vectors: DataFrame) -> tuple[DataFrame, DataFrame]:
    none = vectors.filter("false").select("vec_id", F.lit(0).alias("cluster"), F.lit(0).cast("bigint").alias("distance"))
    return none, spark.createDataFrame([], CENTROID_ROWS)


def digest(centroid: list[int]) -> str:
    return hashlib.sha256(",".join(map(str, centroid)).encode()).hexdigest()
