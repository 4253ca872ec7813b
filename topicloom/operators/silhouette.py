"""Silhouette of labelled vectors."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCK_ROWS = 2048
BLOCK_BYTES = 32 << 20  # of the vectors of a large block
BLOCK_CELLS = 2_000_000  # points times labels of a large block
SPREAD = 16  # blocks that few points are cut into, if they fill them


def silhouette(points: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Mean Euclidean silhouette of (vector, label): one row (silhouette), null below two labels.

    The measure compares all points, so its work is quadratic; what is bounded is the memory. Equal
    points are first collapsed to one with a weight. The rest is cut into blocks by hash, as large as BLOCK_BYTES and BLOCK_CELLS
    allow, so that a point is sent to few tasks. A task sees two blocks, compares them ``block_rows`` points at a time,
    each pair once, and returns the summed distance of each point to each label under the point's 128-bit hash, never pairs or vectors.
    ``silhouette_squared`` is the linear alternative for large inputs."""
    folded = points.groupBy("vector", "label").agg(F.count(F.lit(1)).alias("weight"))
    folded = folded.withColumns({f"h{seed}": F.xxhash64(F.lit(seed), "vector", "label") for seed in (1, 2)}).persist()
    n, size, labels = folded.agg(F.count(F.lit(1)), F.max(F.size("vector")), F.count_distinct("label")).first()
    room = max(block_rows, min(BLOCK_BYTES // (8 * max(size or 1, 1)), BLOCK_CELLS // max(labels, 1)))
    blocks = max(1, -(-n // room), min(-(-n // block_rows), SPREAD))
    placed = folded.withColumn("block", F.pmod("h1", F.lit(blocks)).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("other")
    sent = placed.select("*", other).select("*", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"))
    label_type = dict(points.dtypes)["label"]

    def block_sums(group: pa.Table) -> pa.Table:
        sides = [group.filter(pc.equal(group["block"], group[c][0])) for c in ("i", "j")]
        if group["i"][0] == group["j"][0]:
            sides = sides[:1]
        at = [_points(s) for s in sides]
        center = at[0][0].mean(axis=0) if len(at[0][0]) else 0  # distances do not change, squares stay small
        found = [np.zeros((len(x), len(names))) for (x, *_), (*_, names) in zip(at, at[::-1])]
        (x, x_shares, _), (y, y_shares, _) = at[0], at[-1]
        for a in range(0, len(x), block_rows):
            p = x[a : a + block_rows] - center
            for b in range(0, len(y), block_rows):
                q = y[b : b + block_rows] - center
                distances = np.sqrt(np.maximum((p * p).sum(axis=1)[:, None] + (q * q).sum(axis=1)[None, :] - 2 * (p @ q.T), 0))
                found[0][a : a + block_rows] += distances @ y_shares(b)
                if len(sides) > 1:
                    found[1][b : b + block_rows] += distances.T @ x_shares(a)
        out = []
        for side, total, (*_, names) in zip(sides, found, at[::-1]):
            every, kinds = np.repeat(np.arange(side.num_rows), len(names)), np.tile(np.arange(len(names)), side.num_rows)
            out.append(side.select(["h1", "h2", "label", "weight"]).take(pa.array(every)).append_column("to_label", names.take(pa.array(kinds))).append_column("total", pa.array(total.ravel())))
        return pa.concat_tables(out)

    def _points(side: pa.Table):
        """Vectors, the weights by label of a run of them, and the labels."""
        vectors = np.stack([np.asarray(v.values, float) for v in side["vector"]]) if side.num_rows else np.zeros((0, size))
        label = side["label"].combine_chunks() if side["label"].num_chunks else pa.array([], side["label"].type)
        names = label.drop_null().unique()
        code, weight = pc.fill_null(pc.index_in(label, names), -1).to_numpy(zero_copy_only=False), side["weight"].to_numpy()

        def shares(start: int) -> np.ndarray:
            some = code[start : start + block_rows]
            out = np.zeros((len(some), len(names)))
            known = np.flatnonzero(some >= 0)
            out[known, some[known]] = weight[start : start + block_rows][known]
            return out

        return vectors, shares, names

    schema = f"h1 bigint, h2 bigint, label {label_type}, weight bigint, to_label {label_type}, total double"
    sums = sent.select("i", "j", "block", "vector", "label", "weight", "h1", "h2").groupBy("i", "j").applyInArrow(block_sums, schema)
    sizes = folded.groupBy("label").agg(F.sum("weight").alias("size"))
    return _score(sums.groupBy("h1", "h2", "label", "weight", "to_label").agg(F.sum("total").alias("total")), sizes)


def silhouette_squared(points: DataFrame) -> DataFrame:
    """Mean silhouette under squared Euclidean distance: one row (silhouette). Sums of squared distances
    to a cluster follow from its size, vector sum and sum of squared norms, so the work is linear. This is
    a different number from ``silhouette``."""
    from pyspark.ml.functions import array_to_vector, vector_to_array
    from pyspark.ml.stat import Summarizer

    v = F.col("vector").cast("array<double>")
    square = F.aggregate(v, F.lit(0.0), lambda acc, x: acc + x * x)
    points = points.select(v.alias("vector"), "label", square.alias("sq"))
    clusters = points.groupBy("label").agg(
        F.count(F.lit(1)).alias("size"),
        F.sum("sq").alias("sq_sum"),
        vector_to_array(Summarizer.sum(array_to_vector("vector"))).alias("v_sum"),
    )
    stats = clusters.agg(F.collect_list(F.struct("label", "size", "sq_sum", "v_sum")).alias("c"))  # one row per label

    def to_cluster(k):
        dot = F.aggregate(F.zip_with("vector", k["v_sum"], lambda a, b: a * b), F.lit(0.0), lambda acc, x: acc + x)
        total = F.greatest(k["size"] * F.col("sq") + k["sq_sum"] - 2 * dot, F.lit(0.0))
        return F.struct(k["label"].alias("label"), k["size"].alias("size"), total.alias("total"))

    # Each row compares itself with the clusters on its own, so the points are never shuffled.
    rows = points.withColumn("c", stats.scalar()).withColumn("t", F.transform("c", to_cluster))
    own = F.element_at(F.filter("t", lambda k: k["label"] == F.col("label")), 1)
    others = F.filter("t", lambda k: k["label"] != F.col("label"))
    per_point = rows.select(
        F.lit(1).alias("weight"),
        own["total"].alias("own_total"),
        own["size"].alias("own_size"),
        F.array_min(F.transform(others, lambda k: k["total"] / k["size"])).alias("b"),
    )
    return _mean(per_point)


def _score(sums: DataFrame, sizes: DataFrame) -> DataFrame:
    sized = sums.join(sizes.withColumnRenamed("label", "to_label"), "to_label")
    return _mean_silhouette(sized, ["h1", "h2", "label", "weight"])


def _mean_silhouette(sums: DataFrame, point: list[str]) -> DataFrame:
    own = F.col("label") == F.col("to_label")
    per_point = sums.groupBy(*point).agg(
        F.sum(F.when(own, F.col("total"))).alias("own_total"),
        F.max(F.when(own, F.col("size"))).alias("own_size"),
        F.min(F.when(~own, F.col("total") / F.col("size"))).alias("b"),
    )
    return _mean(per_point)


def _mean(per_point: DataFrame) -> DataFrame:
    a = F.col("own_total") / F.when(F.col("own_size") > 1, F.col("own_size") - 1)
    widest = F.greatest(a, F.col("b"))
    score = F.when(F.col("own_size") == 1, 0.0).when(widest > 0, (F.col("b") - a) / widest).otherwise(0.0)
    mean = F.sum(score * F.col("weight")) / F.sum("weight")
    return per_point.agg(F.when(F.count("b") > 0, mean).alias("silhouette"))
