"""Near-duplicates by an LSH forest. Each text has a MinHash signature; a tree of the forest sorts the signatures in an order
of its own. Texts that share a long enough prefix there form a region; in a region a text is compared with its neighbours
in the sorted order, whose common prefix is longest, and with the centres of the region, texts whose values are
the most common. Each candidate pair is confirmed on the full shingle sets. Texts of one region that these links have left
in different components are then compared with each other, all of them, so that a crowded region loses no link: by their
signatures first, and those that may be linked by their full sets, inside the task that compares two chunks of the
region. It sends a spanning forest of the links it confirmed, and nothing for pairs that are none."""

from __future__ import annotations

from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from topicloom.llm import textbytes as B
from topicloom.llm.staging import stage

SHINGLE = 5
PERCENT = 85  # 100 * intersection >= PERCENT * union
TREES, DEPTH = 16, 3  # a pair of similarity 0.85 shares the first DEPTH values in no tree in one of 4 million cases
LEVELS = (3, 8)  # depths at which a region has centres
CENTRES = 4  # of each region: the one of the most common values among the texts of each hash class
TAIL = 12  # values of a signature that a tree sorts by
NEIGHBOURS = 2
CHUNK = 512  # texts of a region that one step compares with as many others; a long text counts as several
LONG = 2048  # shingles that count as one text there
COLUMNS = 8192  # shingles whose holders are multiplied at a time
MISSED = 2.5e-7  # share of the linked pairs whose signatures may agree in fewer values than are asked for
BROADCAST_IDS = 1_000_000
VALUES = 128

_rng = np.random.default_rng(85)
ODD = _rng.integers(1, 2**62, VALUES, dtype=np.int64).astype(np.uint64) * np.uint64(2) + np.uint64(1)
ADD = _rng.integers(1, 2**62, VALUES, dtype=np.int64).astype(np.uint64)
RESULT = "n_shingles bigint, set_hash binary, signature array<int>"


def shingle_sets(data: np.ndarray, offsets: np.ndarray, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text, ascending within it: (hashes, first of each row and the end)."""
    data = B.LOWER[data]
    w = B.Words(data, offsets, B.SPACED)
    h = w.hashes()
    g, ok = B.gram_hashes(h, size), B.gram_starts(w.rows, size)
    rows = w.row_of()
    few = np.flatnonzero((w.counts > 0) & (w.counts < size))
    whole = np.array([_sequence(h[w.rows[r] : w.rows[r + 1]]) for r in few], np.uint64)
    hashes = np.concatenate([g[ok], whole])
    owner = np.concatenate([rows[: len(ok)][ok], few])
    order = np.lexsort((hashes, owner))
    hashes, owner = hashes[order], owner[order]
    first = np.ones(len(hashes), bool)
    first[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
    hashes, owner = hashes[first], owner[first]
    return hashes, np.searchsorted(owner, np.arange(len(offsets)))


def _sequence(h: np.ndarray) -> np.uint64:
    """The whole sequence of a short text, told apart by its length."""
    return B.gram_hashes(np.concatenate([np.array([len(h)], np.uint64), h]), len(h) + 1)[0]


def signatures(hashes: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """MinHash values (rows x VALUES) of the sets that are not empty, 0 for the others."""
    out = np.zeros((len(edges) - 1, VALUES), np.int32)
    full = np.flatnonzero(np.diff(edges))
    if len(full):
        for k in range(VALUES):
            v = (hashes * ODD[k] + ADD[k]) >> np.uint64(32)
            out[full, k] = np.minimum.reduceat(v, edges[full]).astype(np.uint32).view(np.int32)
    return out


def describe(column: pa.Array) -> pa.Array:
    sizes, names, values = [], [], []
    for _, data, offsets in B.blocks(column):
        hashes, edges = shingle_sets(data, offsets)
        sizes.append(np.diff(edges))
        names.append(np.stack([B.sums_by_row(B.mix(hashes + np.uint64(s)), edges) for s in (1, 2)], 1))
        values.append(signatures(hashes, edges))
    if not sizes:
        return pa.array([], pa.struct([("n_shingles", pa.int64()), ("set_hash", pa.binary()), ("signature", pa.list_(pa.int32()))]))
    raw = np.ascontiguousarray(np.concatenate(names)).tobytes()
    flat = np.concatenate(values)
    return pa.StructArray.from_arrays(
        [
            pa.array(np.concatenate(sizes), pa.int64()),
            pa.array([raw[k : k + 16] for k in range(0, len(raw), 16)], pa.binary()),
            B.list_array(flat.ravel(), np.full(len(flat), VALUES)),
        ],
        ["n_shingles", "set_hash", "signature"],
    )


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, th, n_shingles, set_hash, signature) of each row: one narrow pass over the texts."""
    run = F.arrow_udf(describe, RESULT)
    return docs.select("doc_id", F.xxhash64("text").alias("th"), run(F.col("text")).alias("f")).select("doc_id", "th", "f.*")


def tree_order(tree: int) -> list[int]:
    """The signature positions a tree sorts by: its own eight first, then others."""
    own = VALUES // TREES
    return [tree * own + k if k < own else (tree * own + 37 * k) % VALUES for k in range(TAIL)]


def path(tree: int, depth: int = TAIL) -> F.Column:
    return F.array(*[F.col("signature")[k] for k in tree_order(tree)[:depth]])


def alike(n: F.Column, m: F.Column, percent: int) -> F.Column:
    """Whether sets of these sizes may be linked."""
    return 100 * F.least(n, m) >= percent * F.greatest(n, m)


def candidates(sets: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """Distinct pairs (a, b), a < b, of the set ids that the forest names and whose sizes allow a link, and the members
    (id, tree, region) of the regions of more than one set. ``sets``: id, n, signature. Sizes travel with the ids, so that pairs need no join for them. A region with a third
    of all rows stays spread: regions are counted and their centres chosen by pre-aggregated counts and maxima, rows
    are sorted by ranges of (tree, path, id), and the last rows of each range are carried to the next."""
    slim = sets.select("id", F.posexplode(F.array(*[F.xxhash64(F.lit(t), path(t, DEPTH)) for t in range(TREES)])).alias("tree", "region"))
    # aggregates are staged before they are joined to rows, so that adaptive execution can split the keys of many rows
    crowded = stage(slim.groupBy("region").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"))
    # the values of a text are common if its regions are large
    trees = slim.join(crowded, "region").groupBy("id").agg(F.collect_set("tree").alias("trees"), F.sum("n").alias("weight"))
    paths = F.array(*[path(t) for t in range(TREES)])
    live = sets.join(trees, "id").select("id", "n", "weight", F.explode("trees").alias("tree"), paths.alias("paths"))
    live = stage(live.select("id", "n", "weight", "tree", F.col("paths")[F.col("tree")].alias("path")))
    members = live.select("id", "tree", F.xxhash64("tree", F.slice("path", 1, DEPTH)).alias("region"))
    # texts of equal weight differ in the sizes of their deep regions, which take in every value of the signature
    deep = live.select("id", F.xxhash64("tree", F.slice("path", 1, VALUES // TREES)).alias("region"))
    sizes = stage(deep.groupBy("region").agg(F.count(F.lit(1)).alias("n")))
    common = stage(deep.join(sizes, "region").groupBy("id").agg(F.sum("n").alias("deep")))
    live = live.join(common, "id")
    regions = F.array(*[F.xxhash64("tree", F.slice("path", 1, level)) for level in LEVELS])
    key = live.select("id", "n", "weight", "deep", F.explode(regions).alias("region"))
    classes = key.groupBy("region", F.pmod(F.xxhash64("id"), F.lit(CENTRES)).alias("class"))
    best = classes.agg(F.max(F.struct("weight", "deep", "id", "n")).alias("most"), F.count(F.lit(1)).alias("texts"))
    centre = F.struct(F.col("most.id").alias("id"), F.col("most.n").alias("n"))
    few = best.groupBy("region").agg(F.collect_list(centre).alias("centres"), F.sum("texts").alias("texts"))  # CENTRES at most
    few = stage(few.filter("texts > 1").select("region", "centres"))
    # a text meets the same centres in many of its regions (TREES times the levels at most): each once, before they become rows
    met = key.select("id", "n", "region").join(few, "region").groupBy("id", "n").agg(F.array_distinct(F.flatten(F.collect_list("centres"))).alias("centres"))
    met = met.select("id", "n", F.explode("centres").alias("o")).filter(alike(F.col("n"), F.col("o.n"), percent))
    pairs = [met.select(F.least("id", "o.id").alias("a"), F.greatest("id", "o.id").alias("b"))]
    parts = max(1, int(sets.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    ranged = live.repartitionByRange(parts, "tree", "path", "id").withColumn("part", F.spark_partition_id())
    ordered = stage(ranged.select("id", "n", "tree", "path", "part"))
    filled = [r[0] for r in ordered.select("part").distinct().orderBy("part").collect()]  # no more than the partitions
    if len(filled) > 1:
        following = F.create_map(*[F.lit(x) for ends in zip(filled, filled[1:]) for x in ends])
        last = Window.partitionBy("part").orderBy(F.desc("tree"), F.desc("path"), F.desc("id"))
        tails = ordered.withColumn("back", F.row_number().over(last)).filter(F.col("back") <= NEIGHBOURS)
        carried = tails.withColumn("part", following[F.col("part")]).filter("part IS NOT NULL")
        seen = ordered.unionByName(carried.drop("back"))
    else:
        seen = ordered
    within = Window.partitionBy("part").orderBy("tree", "path", "id")
    earlier = [F.lag(F.struct("id", "n", "tree", "path"), back).over(within) for back in range(1, NEIGHBOURS + 1)]
    near = seen.withColumn("earlier", F.array(*earlier)).select("id", "n", "tree", "path", F.explode("earlier").alias("o"))
    near = near.filter((F.col("o.tree") == F.col("tree")) & (F.slice("o.path", 1, DEPTH) == F.slice("path", 1, DEPTH)))
    near = near.filter(alike(F.col("n"), F.col("o.n"), percent))
    pairs.append(near.select(F.least("id", "o.id").alias("a"), F.greatest("id", "o.id").alias("b")))
    out = pairs[0]
    for more in pairs[1:]:
        out = out.unionByName(more)
    return out.filter("a < b").distinct(), members


def agreements(percent: int, values: int = VALUES) -> tuple[int, int]:
    """(many, least): values in which the signatures of nine out of ten pairs at the threshold agree, and of all but MISSED."""
    p = percent / 100
    below = np.cumsum([comb(values, k) * p**k * (1 - p) ** (values - k) for k in range(values + 1)])
    return int((below <= 0.1).sum()), int((below <= MISSED).sum())


def across(sets: DataFrame, members: DataFrame, roots: DataFrame, percent: int, agreeing: int, best: bool) -> DataFrame | None:
    """Sets of one region and of different components whose signatures agree in ``agreeing`` values, from the tasks that compare two
    chunks of a region each. With ``best`` distinct pairs (a, b), a < b: for each text of a task the one that agrees most; without it
    the texts (task, right, id, comp) that agree with one of the other side, each pair being met in the first tree they share.
    None if no region has two components. ``sets``: id, n, signature; ``members``: id, tree, region; ``roots``: id, root.

    A component that fills chunks is cut into some of its own, the small ones of a region share chunks, and each two chunks
    are compared by a task, but for two of the same component. So the work follows what is not linked yet."""
    weight = F.ceil(F.col("n") / LONG).alias("weight")
    slim = members.join(sets.select("id", weight), "id").join(roots, "id", "left")
    slim = slim.select("id", "tree", "weight", F.xxhash64(F.coalesce("root", "id")).alias("comp"), "region")
    counts = stage(slim.groupBy("region", "comp").agg(F.count(F.lit(1)).alias("n"), F.sum("weight").alias("weight")))
    small = F.sum(F.when(F.col("weight") < CHUNK, F.col("weight")).otherwise(0))
    whole = counts.groupBy("region").agg(F.count(F.lit(1)).alias("kinds"), F.sum("n").alias("n"), F.ceil(small / CHUNK).alias("shared"))
    whole = stage(whole.filter("kinds > 1 AND n > 2").select("region", F.greatest("shared", F.lit(1)).alias("shared")))
    if whole.isEmpty():
        return None
    large = counts.filter(F.col("weight") >= CHUNK).join(whole, "region", "left_semi")
    large = stage(large.select("region", "comp", F.ceil(F.col("weight") / CHUNK).alias("cuts")))
    rows = slim.join(whole, "region").join(large, ["region", "comp"], "left")
    own = F.when(F.col("cuts").isNotNull(), F.col("comp"))
    slot = F.when(F.col("cuts").isNotNull(), F.pmod(F.xxhash64("id"), F.col("cuts"))).otherwise(F.pmod(F.xxhash64("comp"), F.col("shared")))
    rows = stage(rows.select("id", "tree", "comp", "region", own.alias("own"), F.xxhash64("region", own.isNull(), own, slot).alias("chunk")))
    chunks = stage(rows.select("region", "chunk", "own").distinct())
    other = chunks.select("region", F.col("chunk").alias("with"), F.col("own").alias("own_with"))
    two = chunks.join(other, "region").filter(~F.coalesce(F.col("own") == F.col("own_with"), F.lit(False)) & (F.col("chunk") <= F.col("with")))
    two = two.select(F.xxhash64("chunk", "with").alias("task"), F.expr("explode(array_distinct(array(struct(chunk, false as right), struct(with as chunk, chunk != with as right))))").alias("s"))
    two = stage(two.select("task", "s.*"))
    dealt = rows.select("id", "tree", "comp", "chunk").join(two, "chunk").select("task", "right", "id", "comp", "tree")
    full = dealt.join(sets, "id").select("task", "right", "id", "comp", "tree", "n", "signature")
    if best:
        return _by_task(full, lambda held: best_pairs(held, percent, agreeing), "a binary, b binary").distinct()
    return _by_task(full, lambda held: agreeing_texts(held, percent, agreeing), "task bigint, right boolean, id binary, comp bigint")


def _by_task(rows: DataFrame, meet, schema: str) -> DataFrame:
    """``meet`` over the rows of each task, as an Arrow table with its numbers."""
    parts = max(1, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            task = batch.column(0).to_numpy()
            edges = np.concatenate([[0], np.flatnonzero(task[1:] != task[:-1]) + 1, [len(task)]])
            for a, b in zip(edges.tolist(), edges[1:].tolist()):
                if held and held[0].column(0)[0].as_py() != int(task[a]):
                    yield from meet(pa.Table.from_batches(held).combine_chunks())
                    held = []
                held.append(batch.slice(a, b - a))
        if held:
            yield from meet(pa.Table.from_batches(held).combine_chunks())

    return rows.repartition(parts, "task").sortWithinPartitions("task").mapInArrow(run, schema)


def _sides(right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The rows to compare with each other: left with right, or all where none is right."""
    left = np.flatnonzero(~right)
    return left, np.flatnonzero(right) if right.any() else left


def _agreeing(t: pa.Table, percent: int, agreeing: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(i, j, agreements, signatures) of the pairs of rows of different components that agree in enough values."""
    right, comp, n = (t[c].to_numpy() for c in ("right", "comp", "n"))
    signature = t["signature"].combine_chunks().flatten().to_numpy().reshape(-1, VALUES)
    left, against = _sides(right)
    for k in range(0, len(left), 16):
        rows = left[k : k + 16]
        can = comp[rows, None] != comp[against]
        can &= 100 * np.minimum(n[rows, None], n[against]) >= percent * np.maximum(n[rows, None], n[against])
        if against is left:
            can &= rows[:, None] < against
        x, y = np.nonzero(can)
        for c in range(0, len(x), 8192):
            i, j = rows[x[c : c + 8192]], against[y[c : c + 8192]]
            same = (signature[i] == signature[j]).sum(1)
            near = same >= agreeing
            if near.any():
                yield i[near], j[near], same[near], signature


def best_pairs(t: pa.Table, percent: int, agreeing: int) -> Iterator[pa.RecordBatch]:
    most, mate = np.full(len(t), agreeing - 1), np.zeros(len(t), np.int64)
    for i, j, same, _ in _agreeing(t, percent, agreeing):
        near = np.argsort(same, kind="stable")
        for own, its in ((i[near], j[near]), (j[near], i[near])):
            last = np.full(len(t), -1)
            last[own] = np.arange(len(near))  # the last is the largest
            at = np.flatnonzero(last >= 0)
            at = at[same[near[last[at]]] > most[at]]
            most[at], mate[at] = same[near[last[at]]], its[last[at]]
    own = np.flatnonzero(most >= agreeing)
    if len(own):
        yield _pairs(t["id"], own, mate[own])


def agreeing_texts(t: pa.Table, percent: int, agreeing: int) -> Iterator[pa.RecordBatch]:
    tree = t["tree"][0].as_py()
    found = np.zeros(len(t), bool)
    for i, j, _, signature in _agreeing(t, percent, agreeing):
        first = np.ones(len(i), bool)
        for earlier in range(tree):
            places = tree_order(earlier)[:DEPTH]
            first &= (signature[i][:, places] != signature[j][:, places]).any(axis=1)
        found[i[first]] = found[j[first]] = True
    if found.any():
        yield from t.filter(pa.array(found)).select(["task", "right", "id", "comp"]).to_batches()


def linked_within(docs: DataFrame, sets: DataFrame, marked: DataFrame, percent: int) -> DataFrame:
    """A spanning forest (a, b) of the links between the texts ``marked`` (task, right, id, comp) of each task, by their full sets."""
    wanted = stage(marked.select("id").distinct().join(sets.select("id", "first_doc"), "id").select(F.col("first_doc").alias("doc_id")).distinct())
    full = stage(full_sets(docs, wanted).dropDuplicates(["id"]))
    rows = marked.join(full, "id").select("task", "right", "id", "comp", "hashes")
    return stage(_by_task(rows, lambda held: forest(held, percent), "a binary, b binary").distinct())


def forest(t: pa.Table, percent: int) -> Iterator[pa.RecordBatch]:
    right, comp = t["right"].to_numpy(), t["comp"].to_numpy()
    left, against = _sides(right)
    lists = t["hashes"].combine_chunks()
    sizes = np.diff(lists.offsets.to_numpy())
    row = np.repeat(np.arange(len(t)), sizes)
    _, column, copies = np.unique(lists.flatten().to_numpy(), return_inverse=True, return_counts=True)
    shared = copies[column] > 1
    row, column = row[shared], np.unique(column[shared], return_inverse=True)[1]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    common = np.zeros((len(left), len(against)), np.float32)
    for first in range(0, int(column[-1]) + 1 if len(column) else 0, COLUMNS):
        a, b = np.searchsorted(column, (first, first + COLUMNS))
        held = np.zeros((len(t), COLUMNS), np.float32)
        held[row[a:b], column[a:b] - first] = 1
        common += held[left] @ held[against].T
    union = sizes[left][:, None] + sizes[against] - common
    x, y = np.nonzero((100 * common >= percent * union) & (comp[left][:, None] != comp[against]))
    i, j = left[x], against[y]
    label = np.unique(comp, return_inverse=True)[1]
    kept: list[tuple[int, int]] = []
    while len(i):
        open_ = label[i] != label[j]
        i, j = i[open_], j[open_]
        for at in np.unique(label[i], return_index=True)[1]:
            if label[i[at]] != label[j[at]]:
                kept.append((i[at], j[at]))
                label[label == label[j[at]]] = label[i[at]]
    if kept:
        yield _pairs(t["id"], *np.array(kept).T)


def _pairs(ids: pa.ChunkedArray, i: np.ndarray, j: np.ndarray) -> pa.RecordBatch:
    names = ids.take(pa.array(np.concatenate([i, j]))).to_pylist()
    pairs = [sorted(p) for p in zip(names[: len(i)], names[len(i) :])]
    return pa.record_batch([pa.array(s, pa.binary()) for s in zip(*pairs)], ["a", "b"])


def confirm(docs: DataFrame, sets: DataFrame, pairs: DataFrame, percent: int) -> DataFrame:
    """The ``pairs`` (a, b) that are linked, by the full sets. ``sets``: id, first_doc; the sizes of the pairs allow a link."""
    pairs = stage(pairs)
    named = pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    wanted = stage(named.join(sets.select("id", "first_doc"), "id").select(F.col("first_doc").alias("doc_id")).distinct())
    full = stage(full_sets(docs, wanted).dropDuplicates(["id"]))
    checked = pairs.select("a", "b")
    for side in ("a", "b"):
        checked = checked.join(full.select(F.col("id").alias(side), F.col("hashes").alias(f"set_{side}")), side)
    both = F.size(F.array_intersect("set_a", "set_b"))
    return stage(checked.filter(100 * both >= percent * (F.size("set_a") + F.size("set_b") - both)).select("a", "b"))


def full_sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(id, hashes): the sets of the documents ``wanted`` (doc_id). Up to BROADCAST_IDS ids are sent to the tasks that
    scan the texts; beyond it the texts are joined by shuffle."""

    @F.arrow_udf("id binary, hashes array<bigint>")
    def sets(column: pa.Array) -> pa.Array:
        ids, lists = [], []
        for _, data, offsets in B.blocks(column):
            hashes, edges = shingle_sets(data, offsets)
            names = np.stack([B.sums_by_row(B.mix(hashes + np.uint64(s)), edges) for s in (1, 2)], 1)
            raw = np.ascontiguousarray(names).tobytes()
            ids += [raw[k : k + 16] for k in range(0, len(raw), 16)]
            lists.append(B.list_array(hashes.view(np.int64), np.diff(edges)))
        if not ids:
            return pa.array([], pa.struct([("id", pa.binary()), ("hashes", pa.list_(pa.int64()))]))
        return pa.StructArray.from_arrays([pa.array(ids, pa.binary()), pa.concat_arrays(lists)], ["id", "hashes"])

    if wanted.count() <= BROADCAST_IDS:
        wanted = F.broadcast(wanted)
    found = docs.select("doc_id", "text").join(wanted, "doc_id", "left_semi")
    return found.select(sets(F.col("text")).alias("s")).select("s.*")


def components(edges: DataFrame) -> DataFrame:
    """(id, root): the least id each id is connected to, for the ids of ``edges`` (a, b). Every round hangs the
    neighbours of an id below its least neighbour, which at most doubles the rows and ends after a few rounds."""
    before, now = None, edges.select("a", "b")
    while True:
        both = now.select(F.col("a").alias("v"), F.col("b").alias("u")).unionByName(now.select(F.col("b").alias("v"), F.col("a").alias("u")))
        least = stage(both.groupBy("v").agg(F.least(F.min("u"), F.col("v")).alias("m")))
        moved = both.join(least, "v").filter("u != m").select(F.col("u").alias("a"), F.col("m").alias("b"))
        hung = least.filter("v != m").select(F.col("v").alias("a"), F.col("m").alias("b"))
        now = stage(moved.unionByName(hung).distinct())
        state = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            return now.select(F.col("a").alias("id"), F.col("b").alias("root"))
        before = state


def find_groups(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(doc_id, th, set_hash, n_shingles, component_id, kept) for every row of ``docs`` (doc_id, text, ...); th is
    the hash of the text.

    The set of a text are its distinct shingles of five words ([^\\x20\\x09-\\x0D]+, A-Z lower-cased), as 64-bit hashes;
    the whole sequence of a shorter text; nothing for a null text or one without words, which is linked with nothing.
    Texts of equal sets are one from the start; different ones are linked if 100 * intersection >= percent * union.
    component_id is the least doc_id reachable. Rows that repeat a doc_id are each a text of their own. A row without
    doc_id is linked with nothing, has no component and is kept."""
    prints = stage(fingerprints(docs))
    some = prints.filter("n_shingles > 0 AND doc_id IS NOT NULL")
    sets = stage(
        some.groupBy(F.col("set_hash").alias("id"))
        .agg(F.min("doc_id").alias("first_doc"), F.max("n_shingles").alias("n"), F.first("signature").alias("signature"))
    )
    pairs, members = candidates(sets.select("id", "n", "signature"), percent)
    roots = stage(components(confirm(docs, sets, pairs, percent)))
    likely, least = agreements(percent)
    for agreeing, best in ((likely, True), (least, False)):  # what likely links join is not compared again
        found = across(sets.select("id", "n", "signature"), members, roots, percent, agreeing, best)
        if found is None:
            break
        links = confirm(docs, sets, found, percent) if best else linked_within(docs, sets, stage(found), percent)
        if not links.isEmpty():
            roots = stage(components(links.unionByName(roots.select(F.col("id").alias("a"), F.col("root").alias("b")))))
    sizes = sets.select("id", "n", "first_doc")
    rooted = sizes.join(roots, "id", "left").select("id", "first_doc", F.coalesce("root", "id").alias("root"))
    least = stage(rooted.groupBy("root").agg(F.min("first_doc").alias("component_id")))
    known = stage(rooted.join(least, "root").select(F.col("id").alias("set_hash"), "component_id"))
    slim = prints.select("doc_id", "th", "set_hash", "n_shingles")
    linked = F.col("n_shingles") > 0
    out = slim.withColumn("key", F.when(linked & F.col("doc_id").isNotNull(), F.col("set_hash"))).join(known.withColumnRenamed("set_hash", "key"), "key", "left")
    component = F.coalesce("component_id", "doc_id")
    return out.select("doc_id", "th", "set_hash", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def keep_one(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """``docs`` with one row of each group: that of the least doc_id (and text, where rows repeat a doc_id). Rows without
    words or doc_id stay."""
    found = stage(find_groups(docs, percent).filter("n_shingles > 0 AND doc_id IS NOT NULL"))
    key = ["doc_id", "th"]
    texts = found.groupBy(*key, "component_id", "kept").agg(F.count(F.lit(1)).alias("n"))
    first = texts.filter("kept").groupBy("doc_id", "component_id").agg(F.min("th").alias("th"), F.count(F.lit(1)).alias("m"))
    other = texts.filter("kept").join(first.filter("m > 1").select("doc_id", F.col("th").alias("first")), "doc_id").filter("th != first")
    dropped = stage(texts.filter("NOT kept").select(*key).unionByName(other.select(*key)))
    repeats = stage(texts.filter("n > 1").select(*key))
    small = [F.broadcast if t.count() <= BROADCAST_IDS else (lambda t: t) for t in (dropped, repeats)]
    left = docs.withColumn("__th", F.xxhash64("text"))
    key = ["doc_id", "__th"]
    dropped, repeats = (s(t.withColumnRenamed("th", "__th")) for s, t in zip(small, (dropped, repeats)))
    left = left.join(dropped, key, "left_anti")
    if not repeats.isEmpty():
        once = left.join(repeats, key, "left_semi").dropDuplicates(key)
        left = left.join(repeats, key, "left_anti").unionByName(once)
    return left.select(docs.columns)
