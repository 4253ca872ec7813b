"""TF-IDF: pruning, smoothed inverse document frequency and unit-length documents.

Over a corpus hashed by ``doc_id`` counting, weighing and normalising run in one stage when the
vocabulary is small enough to broadcast; a larger one is joined by shuffle."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import CountVectorizerModel, ElementwiseProduct, Normalizer
from pyspark.ml.linalg import SparseVector, Vectors, VectorUDT
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from topicloom.functions.tokens import word_ngrams
from topicloom.operators.vocab import doc_term, share_of, term_stats, with_term_ids
from topicloom.runtime import BROADCAST_ROW_LIMIT, DataValidationError, bounded, by_document, cut_lineage, is_small, keys_repeat

BLOCK_TOKENS = 500_000  # tokens that are counted together, which bounds the rows and the memory of a task

# The settings of the vectorizers.
PRESETS = {
    "default": dict(ngram_range=(1, 2), min_df=2, max_df=0.95, max_features=10_000),
    "tfidf": dict(ngram_range=(1, 1), min_df=3, max_df=0.9, max_features=30_000),
    "bow": dict(ngram_range=(1, 1), min_df=2, max_df=0.95, max_features=30_000),
    "search": dict(ngram_range=(1, 2), min_df=2, max_df=0.95, max_features=2_000),
}


def smooth_idf(df: Column, n_docs: Column) -> Column:
    return F.log((n_docs + 1) / (df + 1)) + 1


def weigh(counts: DataFrame, idf: DataFrame) -> DataFrame:
    """Join (doc_id, term, tf) with (term, idf, ...) and scale every document to unit length:
    (doc_id, term, w, ...)."""
    raw = counts.join(idf, "term").withColumn("_raw", F.col("tf") * F.col("idf"))
    norm = F.sqrt(F.sum(F.col("_raw") * F.col("_raw")).over(Window.partitionBy("doc_id")))
    return raw.withColumn("w", F.col("_raw") / norm).drop("_raw", "idf", "tf")


def mean_tfidf(weights: DataFrame, n_docs: Column) -> DataFrame:
    """Mean weight per term over all documents, those without the term included."""
    return weights.groupBy("term").agg(F.sum("w").alias("_sum")).select("term", (F.col("_sum") / n_docs).alias("mean_tfidf"))


def select_grams(docs: DataFrame, ngram_range: tuple[int, int], stop_words: Sequence[str]) -> DataFrame:
    """Stopwords are dropped first, n-grams are formed from what is left."""
    tokens = F.col("tokens")
    if stop_words:
        tokens = F.filter(tokens, lambda t: ~t.isin(list(stop_words)))
    return docs.select("doc_id", word_ngrams(tokens, *ngram_range).alias("tokens"))


def pruned_vocabulary(
    grams: DataFrame, n_docs: Column, min_df: int | float, max_df: int | float, max_features: int | None
) -> DataFrame:
    """(term, df, cf, term_id): document-frequency limits, then the most frequent terms, ids in term order."""
    df = F.col("df")
    stats = term_stats(grams).filter((df >= share_of(min_df, n_docs)) & (df <= share_of(max_df, n_docs)))
    if max_features is not None:
        stats = stats.orderBy(F.col("cf").desc(), "term").limit(max_features)
    return with_term_ids(stats, max_features)


@dataclass(frozen=True)
class TfidfModel:
    """A fitted vocabulary (term_id, term, df, cf, idf) and how to apply it. Corpora that are already
    hashed by ``doc_id`` are passed with ``partitioned=True`` and then need no exchange."""

    vocab: DataFrame
    ngram_range: tuple[int, int] = (1, 1)
    stop_words: tuple[str, ...] = ()

    def feature_names(self) -> DataFrame:
        return self.vocab.select("term_id", "term").orderBy("term_id")

    def transform(self, docs: DataFrame, partitioned: bool = False) -> DataFrame:
        """Long form (doc_id, term_id, term, w) of the non-zero weights. A vocabulary that a count proves small is sent to the tasks, and
        each document is counted, weighed and normalised inside its row; a larger one is joined by shuffle, and so are the
        documents if a ``doc_id`` is null or repeats, whose rows count as one document."""
        rows = self._rows(docs)
        if rows is not None:
            cells = rows.select("doc_id", F.explode(F.arrays_zip("idx", "val")).alias("e"))
            kind = dict(self.vocab.dtypes)["term_id"]
            named = cells.select("doc_id", F.col("e.idx").cast(kind).alias("term_id"), F.col("e.val").alias("w"))
            return named.join(F.broadcast(self.vocab.select("term_id", "term")), "term_id").select("doc_id", "term_id", "term", "w")
        placed = docs if partitioned else by_document(docs.select("doc_id", "tokens"))
        grams = select_grams(placed, self.ngram_range, self.stop_words)
        known = bounded(self.vocab).select("term", "term_id", "idf")
        return weigh(doc_term(grams, partitioned=True), known).select("doc_id", "term_id", "term", "w")

    def arrays(self, docs: DataFrame, partitioned: bool = False) -> DataFrame:
        """One row per document (doc_id, idx, val) with ascending term ids. Documents without a known term
        keep empty arrays, that is a zero vector."""
        rows = self._rows(docs)
        if rows is not None:
            return rows
        placed = docs if partitioned else by_document(docs.select("doc_id", "tokens"))
        return sparse_rows(self.transform(placed, partitioned=True), placed)

    def _rows(self, docs: DataFrame) -> DataFrame | None:
        """(doc_id, idx, val) made inside the rows, or None if the vocabulary is too large for the tasks or a ``doc_id`` is null or repeats."""
        kept = self.vocab if self.vocab.storageLevel.useMemory or self.vocab.storageLevel.useDisk else self.vocab.persist()
        if not is_small(kept) or keys_repeat(docs):
            return None
        known = kept.select("term_id", "term", "idf").orderBy("term_id").toArrow()
        if not known.num_rows or known["term_id"].to_pylist() != list(range(known.num_rows)):
            return None
        grams = select_grams(docs, self.ngram_range, self.stop_words).withColumn("tokens", F.coalesce("tokens", F.array().cast("array<string>")))
        counts = CountVectorizerModel.from_vocabulary(known["term"].to_pylist(), inputCol="tokens", outputCol="_tf").transform(grams)
        raw = ElementwiseProduct(scalingVec=Vectors.dense(known["idf"].to_numpy()), inputCol="_tf", outputCol="_raw").transform(counts)
        vector = F.unwrap_udt("_w")
        return Normalizer(p=2.0, inputCol="_raw", outputCol="_w").transform(raw).select("doc_id", vector["indices"].alias("idx"), vector["values"].alias("val"))

    def bags(self, docs: DataFrame) -> DataFrame:
        """(doc_id, features) with plain term counts as vectors for Spark ML. A vocabulary within BROADCAST_ROW_LIMIT is sent
        to the tasks and each document counted in place. A larger one meets the words of blocks of documents by shuffle, one row for each
        word of a block; if a ``doc_id`` is null or repeats, it is joined to the counts."""
        width = self.vocab.count()
        if width == 0:
            raise DataValidationError("the vocabulary is empty")
        grams = select_grams(docs, self.ngram_range, self.stop_words)
        if width <= BROADCAST_ROW_LIMIT:
            terms = [r.term for r in self.feature_names().collect()]
            model = CountVectorizerModel.from_vocabulary(terms, inputCol="tokens", outputCol="features")
            return model.transform(grams).select("doc_id", "features")
        ids = self.vocab.select("term", "term_id")
        if keys_repeat(docs):
            counts = doc_term(grams).join(ids, "term")
            rows = sparse_rows(counts.select("doc_id", "term_id", F.col("tf").cast("double").alias("w")), docs)
        else:
            rows = counts_by_blocks(grams, ids)

        @F.udf(VectorUDT())
        def vector(idx, val):
            return SparseVector(width, idx, val)

        return rows.select("doc_id", vector("idx", "val").alias("features"))


def counts_by_blocks(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """(doc_id, idx, val): the counts of the known terms (term, term_id) in every document (doc_id, tokens), doc_id unique.

    Documents are counted once, in blocks of some BLOCK_TOKENS tokens that number their own words. Only the different words of a block are
    joined to the terms; each block is then given the ids of its words. No token and no count is a row of a shuffle."""
    kind = dict(docs.dtypes)["doc_id"]
    tokens = docs.select("doc_id", F.coalesce(F.array_compact("tokens"), F.array().cast("array<string>")).alias("tokens"))
    schema = f"doc_ids array<{kind}>, sizes array<int>, codes array<int>, counts array<int>, terms array<string>"

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            offsets, start = batch.column("tokens").offsets.to_numpy(), 0
            while start < batch.num_rows:
                stop = max(int(np.searchsorted(offsets, offsets[start] + BLOCK_TOKENS, "right")) - 1, start + 1)
                part, lengths = batch.slice(start, stop - start), np.diff(offsets[start : stop + 1])
                start = stop
                words = part.column("tokens").flatten().dictionary_encode()
                width = max(1, len(words.dictionary))
                cells, counts = np.unique(np.repeat(np.arange(len(lengths)), lengths) * width + words.indices.to_numpy(), return_counts=True)
                sizes = np.bincount(cells // width, minlength=len(lengths))
                columns = [part.column("doc_id"), *(pa.array(x.astype(np.int32)) for x in (sizes, cells % width, counts)), words.dictionary]
                yield pa.record_batch([pa.ListArray.from_arrays(pa.array([0, len(c)], pa.int32()), c) for c in columns], ["doc_ids", "sizes", "codes", "counts", "terms"])

    def name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row, batch in ((r, b) for b in batches for r in range(b.num_rows)):
            doc_ids, *columns = (batch.column(c)[row].values for c in ("doc_ids", "sizes", "codes", "counts"))
            sizes, codes, counts = (c.to_numpy() for c in columns)
            known, place = batch.column("known")[row].values, np.full(codes.max(initial=-1) + 1, -1, np.int32)
            if known is not None:
                place[known.field("code").to_numpy()] = known.field("id").to_numpy()
            doc, idx = np.repeat(np.arange(len(sizes)), sizes), place[codes]
            order = np.lexsort((idx, doc))
            order = order[idx[order] >= 0]
            offsets = pa.array(np.concatenate([[0], np.cumsum(np.bincount(doc[order], minlength=len(sizes)))]), pa.int32())
            values = (pa.array(idx[order]), pa.array(counts[order].astype(np.float64)))
            yield pa.record_batch([doc_ids, *(pa.ListArray.from_arrays(offsets, v) for v in values)], ["doc_id", "idx", "val"])

    blocks = cut_lineage(tokens.mapInArrow(count, schema)).withColumn("block", F.monotonically_increasing_id())
    met = blocks.select("block", F.posexplode("terms").alias("code", "term")).join(ids, "term")
    known = met.groupBy("block").agg(F.collect_list(F.struct("code", F.col("term_id").cast("int").alias("id"))).alias("known"))
    return blocks.drop("terms").join(known, "block", "left").mapInArrow(name, f"doc_id {kind}, idx array<int>, val array<double>")


def sparse_rows(weights: DataFrame, docs: DataFrame) -> DataFrame:
    """Collect (doc_id, term_id, w) to (doc_id, idx, val) for every document of ``docs``."""
    entries = F.array_sort(F.collect_list(F.struct(F.col("term_id").cast("int").alias("i"), F.col("w").alias("v"))))
    rows = weights.groupBy("doc_id").agg(entries.alias("e")).select("doc_id", F.col("e.i").alias("idx"), F.col("e.v").alias("val"))
    return docs.select("doc_id").join(rows, "doc_id", "left").select(
        "doc_id",
        F.coalesce("idx", F.array().cast("array<int>")).alias("idx"),
        F.coalesce("val", F.array().cast("array<double>")).alias("val"),
    )


def fit_tfidf(
    docs: DataFrame,
    ngram_range: tuple[int, int] = (1, 2),
    min_df: int | float = 2,
    max_df: int | float = 0.95,
    max_features: int | None = 10_000,
    stop_words: Sequence[str] = (),
) -> TfidfModel:
    """Fit on (doc_id, tokens). The vocabulary is computed once; a table without documents is an error."""
    n = docs.count()
    if n == 0:
        raise DataValidationError("cannot fit TF-IDF on no documents")
    n_docs = F.lit(n)
    grams = select_grams(docs, ngram_range, stop_words)
    vocab = pruned_vocabulary(grams, n_docs, min_df, max_df, max_features)
    vocab = vocab.withColumn("idf", smooth_idf(F.col("df"), n_docs)).select("term_id", "term", "df", "cf", "idf")
    return TfidfModel(vocab.persist(), tuple(ngram_range), tuple(stop_words))


def fit_transform(docs: DataFrame, **options) -> tuple[DataFrame, DataFrame]:
    """TF-IDF weights and the feature names in id order."""
    model = fit_tfidf(docs, **options)
    return model.transform(docs), model.feature_names()


def save_tfidf(model: TfidfModel, path: str) -> str:
    """The vocabulary and the settings as two Parquet tables."""
    model.vocab.write.mode("overwrite").parquet(f"{path}/vocab")
    settings = [(*model.ngram_range, list(model.stop_words))]
    spark = model.vocab.sparkSession
    spark.createDataFrame(settings, "low int, high int, stop_words array<string>").write.mode("overwrite").parquet(f"{path}/settings")
    return path


def load_tfidf(spark: SparkSession, path: str) -> TfidfModel:
    settings = spark.read.parquet(f"{path}/settings").first()
    vocab = spark.read.parquet(f"{path}/vocab")
    return TfidfModel(vocab, (settings.low, settings.high), tuple(settings.stop_words))
