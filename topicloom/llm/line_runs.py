"""Line dedup: repeated runs of lines are found in a suffix array over line ids, built by distributed prefix doubling, and
their later copies are deleted. DataFrame functions only.

Every position of a text is a suffix: the lines from there on. Level k ranks the suffixes by their first 2^k lines; the
next level ranks pairs (rank here, rank 2^k lines on). Suffixes of equal rank are an interval of the suffix array whose
longest common prefix is at least 2^k lines; an interval of one suffix can repeat nothing and is left out of the next
level. Doubling ends once the shortest runs that count are told apart. A run counts if it holds MIN_CHARS characters,
line ends included; two overlapping ranks name it, and all copies but the first in (doc_id, position) order are deleted.
A maximal repeated run is the union of such runs."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from topicloom.llm.staging import stage

MIN_CHARS = 50
ROW = ["doc_id", "th"]  # a text is told by its id and hash: rows that repeat both are one text


def positions(docs: DataFrame, min_chars: int) -> DataFrame:
    """(doc_id, th, pos, size, h1, h2, lines): the 128-bit hash of each line and how many lines from it on reach
    ``min_chars`` (null if the text ends before)."""
    texts = docs.select("doc_id", "text").filter("text IS NOT NULL")
    texts = texts.withColumns({"th": F.xxhash64("text"), "copy": F.monotonically_increasing_id()})  # copy: a row, where rows repeat
    lines = texts.select(*ROW, "copy", F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    hashed = lines.select(*ROW, "copy", "pos", (F.length("line") + 1).cast("bigint").alias("size"), F.xxhash64("line").alias("h1"), F.xxhash64(F.lit(7), "line").alias("h2"))
    text = Window.partitionBy(*ROW, "copy")
    before = F.sum("size").over(text.orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)) - F.col("size")
    placed = hashed.withColumn("at", before).withColumn("total", F.sum("size").over(text))
    reach = F.count("size").over(text.orderBy("at").rangeBetween(0, min_chars - 1)).cast("int")
    return placed.select(*ROW, "pos", "h1", "h2", F.when(F.col("total") - F.col("at") >= min_chars, reach).alias("lines"))


def ranked(rows: DataFrame, a: str, b: str) -> DataFrame:
    """(a, b, r): ranks, in order, of the pairs that stand in more than one row. Pairs are counted before they are
    sorted, so a pair of many rows is one row here."""
    counted = rows.groupBy(a, b).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    return stage(counted.select(a, b).orderBy(a, b).withColumn("r", F.monotonically_increasing_id()))


def later_copies(rows: DataFrame, *key: str) -> DataFrame:
    """(doc_id, th, pos, lines) of the rows that are not the first of their key. The firsts are staged: a join of two plain
    exchanges is one whose common keys adaptive execution can split."""
    first = rows.groupBy(*key).agg(F.min(F.struct(*ROW, "pos")).alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    both = rows.join(stage(first.drop("n")), list(key))
    return both.filter(~F.col("first").eqNullSafe(F.struct(*ROW, "pos"))).select(*ROW, "pos", "lines")


def repeated_lines(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """(doc_id, th, gone): the positions of each text to delete. A line with a third of all rows is one row in every count,
    and the joins back to the rows are sort-merge joins whose skewed keys adaptive execution splits."""
    every = positions(docs, min_chars)
    ranks = ranked(every, "h1", "h2")
    live = stage(every.join(ranks, ["h1", "h2"]).select(*ROW, "pos", "lines", "r"))
    found, step = [later_copies(live.filter("lines = 1"), "r")], 1
    longest = live.agg(F.max("lines")).first()[0] or 0
    while longest >= 2 * step:
        ahead = Window.partitionBy(*ROW).orderBy("pos").rangeBetween(step, step)
        pairs = live.withColumn("r2", F.max("r").over(ahead)).filter("r2 IS NOT NULL")
        pairs = stage(pairs.withColumnRenamed("r", "r1"))
        step *= 2
        ranks = ranked(pairs, "r1", "r2")
        live = stage(pairs.join(ranks, ["r1", "r2"]).select(*ROW, "pos", "lines", "r"))
        # runs of step .. 2 * step - 1 lines: the rank at their start and the one that ends with them
        here = live.filter(f"lines >= {step} AND lines < {2 * step}").withColumn("end", F.col("pos") + F.col("lines") - step)
        ends = live.select(F.col("doc_id").alias("d"), F.col("th").alias("t"), F.col("pos").alias("end"), F.col("r").alias("r_end")).distinct()
        runs = here.join(ends, here["doc_id"].eqNullSafe(ends["d"]) & (here["th"] == ends["t"]) & (here["end"] == ends["end"]))
        found.append(later_copies(runs.select(*ROW, "pos", "lines", "r", "r_end"), "lines", "r", "r_end"))
        longest = live.agg(F.max("lines")).first()[0] or 0
    each = reduce(DataFrame.unionByName, found)
    each = each.select(*ROW, F.explode(F.sequence("pos", F.col("pos") + F.col("lines") - 1)).alias("line"))
    return each.groupBy(*ROW).agg(F.sort_array(F.collect_set("line")).alias("gone"))


def dedup_lines(docs: DataFrame, min_chars: int = MIN_CHARS, into: str = "lines") -> DataFrame:
    """``docs`` (doc_id, text, ...) with ``text`` without later copies of repeated line runs, and a struct column ``into``:
    n_lines, n_removed, runs (first and last deleted line of each run, counted from 0).

    The first copy in (doc_id, text hash, position) order stays, also within one text. A line is deleted with its line
    end. Runs below ``min_chars`` characters are left alone, so short lines go only as part of a longer repeated run.
    Null texts stay null with no lines; an empty text is one empty line; rows that repeat id and text get equal results;
    a null doc_id comes before all others."""
    gone = repeated_lines(docs, min_chars).select(F.col("doc_id").alias("__d"), F.col("th").alias("__t"), F.col("gone").alias("__gone"))
    keyed = docs.withColumn("__th", F.xxhash64("text"))
    both = keyed.join(gone, keyed["doc_id"].eqNullSafe(gone["__d"]) & (keyed["__th"] == gone["__t"]), "left").drop("__th", "__d", "__t")
    lines, out = F.split("text", "\n"), F.coalesce(F.col("__gone"), F.array().cast("array<int>"))
    starts = F.sort_array(F.array_except(out, F.transform(out, lambda x: x + 1)))
    ends = F.sort_array(F.array_except(out, F.transform(out, lambda x: x - 1)))
    runs = F.zip_with(starts, ends, lambda a, b: F.struct(a.alias("first"), b.alias("last")))
    n_lines = F.when(F.col("text").isNull(), 0).otherwise(F.size(lines)).cast("bigint")
    stats = F.struct(n_lines.alias("n_lines"), F.size(out).cast("bigint").alias("n_removed"), runs.alias("runs"))
    left = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("__gone"))
    text = F.when(F.col("__gone").isNull(), F.col("text")).otherwise(F.array_join(F.transform(left, lambda i: F.get(lines, i)), "\n"))
    return both.withColumns({into: stats, "text": text}).drop("__gone")
