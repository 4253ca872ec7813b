"""The registered queries: every operator over the whole of the given tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from topicloom.functions import text as T
from topicloom.functions import tokens as K
from topicloom.functions.stopwords import ENGLISH, merged_stopwords, stopword_table
from topicloom.models import lda as L
from topicloom.models import nmf as N
from topicloom.models import online_lda as O
from topicloom.models import scoring as S
from topicloom.models import tuning as U
from topicloom.models.ranges import RangedRows, entries_of
from topicloom.operators import coherence as C
from topicloom.operators import embed as E
from topicloom.operators import lexicon as X
from topicloom.operators import metrics as M
from topicloom.operators import phrases as P
from topicloom.operators import relational as R
from topicloom.operators import silhouette as H
from topicloom.operators import tfidf as I
from topicloom.operators import validate as B
from topicloom.operators import vocab as V
from topicloom.plans import evaluate as G
from topicloom.plans.preprocess import preprocess, tokenize
from topicloom.runtime import by_document, checkpoint_dir, cut_lineage, row_count
from topicloom.sources import readers, writers

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

LANGS = ["de", "en", "es", "fr"]


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    # Lets adaptive execution merge the near-empty partitions of cached tables on small data.
    spark.conf.set("spark.sql.optimizer.canChangeCachedPlanOutputPartitioning", "true")
    return spark.read.parquet(f"{sf}/{name}.parquet")


def documents(spark, sf):
    return table(spark, sf, "documents")


def corpus(spark, sf):
    """Documents as tokens, hashed by document and cached, as most operators read them more than once."""
    return tokenize(documents(spark, sf)).persist()


def place(spark: SparkSession) -> str:
    """A new folder below the shared one, for a table that a query writes and reads back."""
    return f"{checkpoint_dir(spark).rstrip('/')}/topicloom-{uuid.uuid4().hex}"


def rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) + F.lit(0.0) for c in columns})


def topic_of_lang() -> F.Column:
    return (F.array_position(F.array(*[F.lit(x) for x in LANGS]), F.col("lang")) - 1).cast("int")


def lang_term_df(spark, sf) -> DataFrame:
    """Documents per language and term: (topic_id, term, df)."""
    langs = documents(spark, sf).select("doc_id", topic_of_lang().alias("topic_id"))
    tokens = corpus(spark, sf).join(langs, "doc_id")
    distinct = tokens.select("topic_id", F.explode(F.array_distinct("tokens")).alias("term"))
    return distinct.groupBy("topic_id", "term").agg(F.count(F.lit(1)).alias("df"))


def lang_topics(spark, sf, n: int = 10) -> DataFrame:
    """A topic per language: its terms of highest document frequency."""
    top = R.top_per_group(lang_term_df(spark, sf), ["topic_id"], n, F.col("df").desc(), F.col("term"))
    return top.select("topic_id", "rank", "term", F.col("df").cast("double").alias("weight"))


def topic_weights(spark, sf) -> DataFrame:
    """Document weights over the four language topics: the share of tokens that are top words of the topic."""
    words = lang_topics(spark, sf).select("term", "topic_id")
    counts = V.doc_term(corpus(spark, sf), partitioned=True).join(F.broadcast(words), "term")  # 40 rows at most
    hits = counts.groupBy("doc_id").pivot("topic_id", list(range(4))).agg(F.sum("tf"))
    lengths = corpus(spark, sf).select("doc_id", F.size("tokens").alias("n"))
    share = [F.coalesce(F.col(str(t)) / F.col("n"), F.lit(0.0)) for t in range(4)]
    return lengths.join(hits, "doc_id", "left").select("doc_id", F.array(*share).alias("w"))


def model_metrics(spark, sf) -> DataFrame:
    """Metrics of one pseudo-model per document source, from the tables."""
    docs = documents(spark, sf).join(table(spark, sf, "labels"), "doc_id", "left")
    stats = docs.groupBy("source").agg(
        F.avg("quality").alias("coherence_score"),
        (F.count_distinct("lang") / F.count(F.lit(1))).alias("topic_diversity"),
        F.when(F.max("toxic") > 0, F.avg("toxic") - 0.05).alias("silhouette_score"),
        (-F.log(F.avg("n_chars"))).alias("perplexity"),
        F.count_distinct("lang").cast("double").alias("num_topics"),
        F.min("doc_id").alias("first"),
        F.min("n_chars").alias("shortest"),
    )
    names = ["coherence_score", "topic_diversity", "silhouette_score", "perplexity", "num_topics"]
    long = stats.unpivot(["source", "first", "shortest"], names, "metric", "value")
    error = F.when(F.col("shortest") < 12, F.lit("not loaded"))
    return long.select(F.col("source").alias("model"), F.col("first").alias("model_ord"), "metric", "value", error.alias("error"))


# --- sources and sinks


@query
def ragged_lines(spark, sf):
    lines = table(spark, sf, "conversations").select("conv_id", "turn", F.replace("text", F.lit(" "), F.lit("\t")).alias("line"))
    return readers.split_ragged(lines, "line", ["f0", "f1", "f2", "f3"])


@query
def parse_token_lists(spark, sf):
    rendered = F.concat(F.lit("['"), F.array_join("tokens", "', '"), F.lit("']"))
    stored = corpus(spark, sf).select("doc_id", F.when(F.size("tokens") == 0, F.lit("[]")).otherwise(rendered).alias("tokens"))
    return readers.load_tokens(stored).select(
        "doc_id", F.size("tokens").cast("bigint").alias("n_tokens"), K.join_tokens(F.col("tokens")).alias("joined")
    )


@query
def parse_topics(spark, sf):
    listed = writers.topic_words(lang_topics(spark, sf)).withColumn("words", writers.words_as_text(F.col("words")))
    return readers.parse_topics(listed)


@query
def stored_csv(spark, sf):
    """Documents as quoted CSV and back; texts keep their quotes, commas, line breaks and outer spaces."""
    path = place(spark)
    kept = {"header": True, "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    documents(spark, sf).select("doc_id", "text", "lang").write.options(**kept).csv(path)
    return readers.read_csv(spark, path, "doc_id bigint, text string, lang string", multiline=True)


@query
def stored_tsv(spark, sf):
    """Documents, with tabs and line breaks as spaces, as unquoted lines of tab-separated fields and back; an empty field is null."""
    path = place(spark)
    kept = {"header": True, "sep": "\t", "quote": "", "escape": "", "emptyValue": "", "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    flat = documents(spark, sf).select("doc_id", F.translate("text", "\t\n\r", "   ").alias("text"), "lang")
    flat.write.options(**kept).csv(path)
    return readers.read_tsv(spark, path).withColumn("doc_id", F.col("doc_id").cast("bigint"))


@query
def stored_json(spark, sf):
    path = writers.write_json(documents(spark, sf).select("doc_id", "text", "lang"), place(spark))
    return readers.read_corpus(spark, path, "json").select("doc_id", "text", "lang")


@query
def stored_corpus(spark, sf):
    """Preprocessed documents as Parquet and back through the token loader."""
    path = writers.write_corpus(corpus(spark, sf).withColumnRenamed("tokens", "cleaned_tokens"), place(spark))
    docs = readers.load_tokens(readers.read_corpus(spark, path))
    return docs.select("doc_id", F.size("tokens").cast("bigint").alias("n_tokens"), K.join_tokens(F.col("tokens")).alias("joined"))


@query
def stored_topics(spark, sf):
    return readers.read_topics_csv(spark, writers.write_topics(lang_topics(spark, sf), place(spark), "csv"))


@query
def stored_documents_with_topics(spark, sf):
    path = place(spark)
    writers.write_documents_with_topics(documents(spark, sf), N.dominant_topic(topic_weights(spark, sf)), path)
    return spark.read.parquet(path).select("doc_id", "lang", "source", "dominant_topic")


@query
def stored_vectorizer(spark, sf):
    """TF-IDF of the documents by a vectorizer that was saved and loaded."""
    docs = corpus(spark, sf)
    path = I.save_tfidf(I.fit_tfidf(docs, stop_words=merged_stopwords(), **I.PRESETS["tfidf"]), place(spark))
    return rounded(I.load_tfidf(spark, path).transform(docs, partitioned=True), "w")


@query
def stored_embeddings(spark, sf):
    """Document vectors as Parquet and back, one row a component."""
    path = writers.write_embeddings(doc_vectors(spark, sf), place(spark))
    return spark.read.parquet(path)


@query
def documents_with_topics(spark, sf):
    joined = writers.documents_with_topics(documents(spark, sf), N.dominant_topic(topic_weights(spark, sf)))
    return joined.select("doc_id", "lang", "source", "dominant_topic")


@query
def comparison_counts(spark, sf):
    return writers.comparison_counts(G.model_status(model_metrics(spark, sf)))


# --- validation and profiles


@query
def table_profile(spark, sf):
    joined = documents(spark, sf).join(table(spark, sf, "labels"), "doc_id", "left")
    return B.profile(joined.select("doc_id", "text", "lang", "quality", "toxic"))


@query
def duplicate_count(spark, sf):
    return B.duplicate_count(documents(spark, sf).select("text", "lang"))


@query
def dedup_rows(spark, sf):
    return B.drop_duplicates(documents(spark, sf).select("text", "lang"))


@query
def trim_strings(spark, sf):
    padded = table(spark, sf, "conversations").select(
        "conv_id", "turn", F.concat(F.lit(" \t "), "text", F.lit(" \n ")).alias("text")
    )
    return B.trim_strings(padded)


@query
def quality_summary(spark, sf):
    raw = documents(spark, sf).join(table(spark, sf, "labels"), "doc_id", "left")
    done = corpus(spark, sf).withColumn("first_token", F.get("tokens", F.lit(0)))
    return B.quality_summary(raw, done)


# --- text functions


@query
def unescape_html(spark, sf):
    return table(spark, sf, "pages").select("page_id", T.unescape_html(F.col("html")).alias("html"))


@query
def strip_tags(spark, sf):
    return table(spark, sf, "pages").select("page_id", T.strip_tags(F.col("html")).alias("html"))


@query
def expand_contractions(spark, sf):
    quoted = F.replace("text", F.lit(" t"), F.lit("'t"))
    return documents(spark, sf).select("doc_id", T.expand_contractions(F.lower(quoted)).alias("text"))


@query
def clean_text(spark, sf):
    return documents(spark, sf).select("doc_id", T.clean(F.col("text")).alias("cleaned"))


@query
def clean_pages(spark, sf):
    return table(spark, sf, "pages").select("page_id", T.clean(F.col("html")).alias("cleaned"))


@query
def clean_light(spark, sf):
    return documents(spark, sf).select("doc_id", T.clean_light(F.col("text")).alias("cleaned"))


@query
def clean_raw(spark, sf):
    return documents(spark, sf).select("doc_id", T.clean_raw(F.col("text")).alias("cleaned"))


@query
def clean_words(spark, sf):
    return documents(spark, sf).select("doc_id", T.clean_words(F.col("text"), ENGLISH).alias("cleaned"))


@query
def process_text(spark, sf):
    done = T.process_text(F.col("text"), remove_punctuation=True, max_length=500)
    rows = table(spark, sf, "conversations").select("conv_id", "turn", done.alias("r"))
    return rows.select(
        "conv_id",
        "turn",
        "r.processed_text",
        F.col("r.original_length").cast("bigint").alias("original_length"),
        F.col("r.processed_length").cast("bigint").alias("processed_length"),
        F.col("r.options_used.max_length").cast("bigint").alias("max_length"),
    )


@query
def repeat_text(spark, sf):
    return table(spark, sf, "benchmark").select("item_id", T.repeat_text(F.col("text"), 3).alias("text"))


# --- tokens


@query
def tokenize_documents(spark, sf):
    return corpus(spark, sf).select(
        "doc_id", F.size("tokens").cast("bigint").alias("n_tokens"), K.join_tokens(F.col("tokens")).alias("joined")
    )


@query
def token_passthrough(spark, sf):
    docs = documents(spark, sf).select("doc_id", K.as_tokens(F.col("text"), is_array=False).alias("tokens"))
    again = docs.select("doc_id", K.as_tokens(F.col("tokens"), is_array=True).alias("tokens"))
    return again.select("doc_id", F.size("tokens").cast("bigint").alias("n_tokens"), F.array_join("tokens", "|").alias("joined"))


@query
def alphabetic_tokens(spark, sf):
    words = K.alphabetic_tokens(K.split_words(F.lower("text")), ENGLISH)
    return documents(spark, sf).select("doc_id", F.array_join(words, " ").alias("joined"))


@query
def lemma_join(spark, sf):
    """The lexicon strips a final s from the longer words of the corpus."""
    docs = corpus(spark, sf)
    words = docs.select(F.explode("tokens").alias("surface")).distinct()
    lexicon = words.filter(F.col("surface").endswith("s") & (F.length("surface") > 4))
    lexicon = lexicon.select("surface", F.substr("surface", F.lit(1), F.length("surface") - 1).alias("lemma"))
    return X.collect_tokens(X.lemmatize(X.token_rows(docs), lexicon)).select(
        "doc_id", K.join_tokens(F.col("tokens")).alias("joined")
    )


@query
def lemmas_by_class(spark, sf):
    """Words ending in n or g count as nouns, in e or s as verbs; a final s is stripped as the lemma."""
    docs = corpus(spark, sf)
    words = docs.select(F.explode("tokens").alias("surface")).distinct()
    last = F.right("surface", F.lit(1))
    classes = words.select("surface", F.when(last.isin("n", "g"), "NOUN").when(last.isin("e", "s"), "VERB").otherwise("X").alias("pos"))
    lemmas = words.filter(F.col("surface").endswith("s")).select(
        "surface", F.substr("surface", F.lit(1), F.length("surface") - 1).alias("lemma")
    )
    rows = X.lemmas_by_class(X.token_rows(docs), classes, lemmas, merged_stopwords())
    return rows.groupBy("token").agg(F.count(F.lit(1)).alias("n"))


@query
def stopword_counts(spark, sf):
    """How often each word of the merged stopword list occurs in the raw documents."""
    words = documents(spark, sf).select(F.explode(K.raw_words(F.col("text"))).alias("word"))
    hits = words.join(F.broadcast(stopword_table(spark)), "word").groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return stopword_table(spark).join(hits, "word", "left").select("word", F.coalesce("n", F.lit(0)).alias("n"))


@query
def corpus_stopwords(spark, sf):
    return V.corpus_stopwords(documents(spark, sf), ENGLISH)


@query
def phrases_learn(spark, sf):
    return rounded(P.learn_phrases(corpus(spark, sf)), "score")


@query
def phrases_apply(spark, sf):
    docs = corpus(spark, sf)
    merged = P.apply_phrases(docs, P.learn_phrases(docs))
    return merged.select("doc_id", K.join_tokens(F.col("tokens")).alias("joined"))


@query
def trigrams(spark, sf):
    """Bigram and trigram pass with the lower threshold."""
    merged, _ = P.build_ngrams(corpus(spark, sf), threshold=50.0)
    return merged.select("doc_id", K.join_tokens(F.col("tokens")).alias("joined"))


@query
def preprocess_documents(spark, sf):
    done = preprocess(documents(spark, sf))
    return done.select("doc_id", "text", "cleaned_text", F.size("tokens").cast("bigint").alias("n_tokens"))


# --- aggregates and features


@query
def word_freq_topn(spark, sf):
    cleaned = documents(spark, sf).select(T.clean(F.col("text")).alias("text"))
    return V.word_frequencies(cleaned, n=50)


@query
def token_freq_topn(spark, sf):
    return V.top_terms(corpus(spark, sf), 25)


@query
def doc_freq(spark, sf):
    return V.document_frequency(corpus(spark, sf))


@query
def vocab_ids(spark, sf):
    return V.dictionary(corpus(spark, sf))


@query
def vocab_extremes(spark, sf):
    return V.dictionary(corpus(spark, sf), no_below=5, no_above=0.5)


@query
def bag_of_words(spark, sf):
    docs = corpus(spark, sf)
    return V.bag_of_words(docs, V.dictionary(docs, no_below=5, no_above=0.5), partitioned=True)


@query
def tfidf_vocab(spark, sf):
    model = I.fit_tfidf(corpus(spark, sf), stop_words=merged_stopwords(), **I.PRESETS["search"])
    return rounded(model.vocab, "idf")


@query
def tfidf(spark, sf):
    docs = corpus(spark, sf)
    model = I.fit_tfidf(docs, stop_words=merged_stopwords(), **I.PRESETS["tfidf"])
    return rounded(model.transform(docs, partitioned=True), "w")


@query
def tfidf_ngram(spark, sf):
    docs = corpus(spark, sf)
    return rounded(I.fit_tfidf(docs, **I.PRESETS["default"]).transform(docs, partitioned=True), "w")


@query
def tfidf_bow_preset(spark, sf):
    docs = corpus(spark, sf)
    weights = I.fit_tfidf(docs, **I.PRESETS["bow"]).transform(docs, partitioned=True)
    return rounded(weights.groupBy("term").agg(F.count(F.lit(1)).alias("df"), F.sum("w").alias("sum_w")), "sum_w")


@query
def mean_tfidf(spark, sf):
    docs = corpus(spark, sf)
    model = I.fit_tfidf(docs, (1, 1), 1, 1.0, None)
    return rounded(I.mean_tfidf(model.transform(docs, partitioned=True), row_count(docs)), "mean_tfidf", digits=9)


@query
def tfidf_top_terms(spark, sf):
    """The heaviest terms of each language by summed TF-IDF."""
    docs = corpus(spark, sf)
    weights = I.fit_tfidf(docs, **I.PRESETS["tfidf"]).transform(docs, partitioned=True)
    langs = documents(spark, sf).select("doc_id", "lang")
    sums = weights.join(langs, "doc_id").groupBy("lang", "term").agg(F.round(F.sum("w"), 6).alias("sum_w"))
    return R.top_per_group(sums, ["lang"], 10, F.col("sum_w").desc(), F.col("term"))


@query
def doc_vectors(spark, sf):
    """Word vectors are the embeddings laid over the vocabulary in id order."""
    docs = corpus(spark, sf)
    words = V.dictionary(docs, no_below=5, no_above=0.5).select("term", "term_id")
    table_ = table(spark, sf, "embeddings").select(F.col("vec_id").alias("term_id"), F.col("embedding").alias("vec"))
    vectors = words.join(table_, "term_id").select(F.col("term").alias("word"), "vec")
    means = E.mean_word_vectors(docs, vectors, 64, partitioned=True)
    entries = means.select("doc_id", F.posexplode("vector").alias("dim", "value"))
    return rounded(entries.select("doc_id", F.col("dim").cast("bigint").alias("dim"), "value"), "value")


@query
def batch_vectors(spark, sf):
    """A stand-in model: characters, spaces and share of the letter e of each text."""

    def load():
        return lambda texts: [[len(t), t.count(" "), t.count("e") / len(t)] for t in texts]

    vectors = E.batch_vectors(documents(spark, sf), load, 3)
    columns = [F.col("vector")[i].cast("double").alias(f"v{i}") for i in range(3)]
    return rounded(vectors.select("doc_id", *columns), "v0", "v1", "v2", digits=4)


# --- models


def _matrix(spark, sf, preset="tfidf"):
    docs = corpus(spark, sf)
    model = I.fit_tfidf(docs, stop_words=merged_stopwords(), **I.PRESETS[preset])
    return docs, model, model.arrays(docs, partitioned=True).persist()


def given_h(spark, sf, vectorizer):
    """Topic weights over the vocabulary from the tables: a thousandth of the document frequencies of the language topics."""
    known = lang_topics(spark, sf).join(vectorizer.vocab.select("term", "term_id"), "term").collect()  # 40 rows
    h = np.zeros((len(LANGS), vectorizer.vocab.count()))
    for row in known:
        h[row.topic_id, row.term_id] = row.weight / 1000
    return h


def given_model(spark, sf, vectorizer, **options):
    return N.NmfModel(N.NmfParams(k=len(LANGS), inner_iter=2, **options), given_h(spark, sf, vectorizer), vectorizer.vocab)


def topic_shape(topics):
    """What holds for the top words of any fitted model: ranks without gaps, weights that do not rise, known words."""
    rank = Window.partitionBy("topic_id").orderBy("rank")
    rows = topics.withColumn("falls", F.col("weight") <= F.coalesce(F.lag("weight").over(rank), F.col("weight")))
    return rows.groupBy(F.col("topic_id").cast("int").alias("topic_id")).agg(
        F.count(F.lit(1)).alias("n_terms"), F.count_distinct("term").alias("n_different"), F.min("rank").cast("int").alias("first"),
        F.max("rank").cast("int").alias("last"), F.every("falls").alias("falling"), F.every(F.col("weight") >= 0).alias("non_negative"),
    )


@query
def nmf_topics(spark, sf):
    """A property row for each fitted topic; the values of the solver are checked by the queries with a given H."""
    _, vectorizer, rows = _matrix(spark, sf)
    return topic_shape(N.fit_nmf(rows, vectorizer.vocab, k=6).topics(10))


@query
def nmf_kl_topics(spark, sf):
    """As ``nmf_topics``, by the other loss."""
    _, vectorizer, rows = _matrix(spark, sf)
    return topic_shape(N.fit_nmf(rows, vectorizer.vocab, k=4, beta_loss="kullback-leibler", inner_iter=10).topics(10))


@query
def nmf_doc_topics(spark, sf):
    """Properties of every document's fitted topics: as many shares as topics, of sum 1, or 0 without a known term."""
    _, vectorizer, rows = _matrix(spark, sf)
    fitted = N.fit_nmf(rows, vectorizer.vocab, k=6).document_topics(rows)
    total = F.aggregate("topic_distribution", F.lit(0.0), lambda a, x: a + x)
    heaviest = F.col("topic_distribution")[F.col("dominant_topic")]
    return fitted.select(
        "doc_id",
        F.size("topic_distribution").cast("bigint").alias("n_topics"),
        F.round(total, 2).alias("total"),
        (F.col("dominant_probability") == heaviest).alias("dominant_is_heaviest"),
    )


@query
def nmf_losses(spark, sf):
    """Of both losses: that no pass of the full fit raises it, and that the error is finite and not negative."""
    _, vectorizer, rows = _matrix(spark, sf)
    found = []
    for loss in U.GRID_LOSSES:
        model = N.fit_nmf(rows, vectorizer.vocab, k=6, beta_loss=loss)
        falling = all(b <= a * (1 + 1e-9) for a, b in zip(model.losses, model.losses[1:]))
        found.append((loss, falling, len(model.losses) > 1, bool(np.isfinite(model.reconstruction_error) and model.reconstruction_error >= 0)))
    return spark.createDataFrame(found, "loss string, falling boolean, several boolean, error_is_finite boolean")


def _weights(solved):
    return rounded(solved.select("doc_id", F.posexplode("w").alias("topic_id", "weight")), "weight")


@query
def nmf_solve_given_h(spark, sf):
    """The rows of W for a given H: two multiplicative steps of the solver."""
    _, vectorizer, rows = _matrix(spark, sf)
    return _weights(given_model(spark, sf, vectorizer).transform(rows))


@query
def nmf_solve_kl_given_h(spark, sf):
    _, vectorizer, rows = _matrix(spark, sf)
    return _weights(given_model(spark, sf, vectorizer, beta_loss="kullback-leibler").transform(rows))


@query
def nmf_step_given_h(spark, sf):
    """One whole pass from a given H: the sums over all documents and the next H."""
    _, vectorizer, rows = _matrix(spark, sf)
    model = given_model(spark, sf, vectorizer)
    upper, lower, _ = N._pass(rows, model.h, model.params)
    model.h = N._update_h(model.h, upper, lower, model.params, 0.0, 0.0)
    return rounded(model.topic_terms().filter("weight > 0").select("topic_id", "term", "weight"), "weight", digits=8)


@query
def nmf_step_by_ranges(spark, sf):
    """As ``nmf_step_given_h``, with H and the sums as tables of term ranges."""
    _, vectorizer, rows = _matrix(spark, sf)
    model = given_model(spark, sf, vectorizer)
    table, squares = model.ranges(), rows.agg(F.sum(F.aggregate("val", F.lit(0.0), lambda a, x: a + x * x))).first()[0]
    upper, lower, _ = N._pass_by_ranges(RangedRows(rows, model.params.k, 100_000), table, model.params, squares)
    moved = N.NmfModel(model.params, None, model.vocab, table=N._update_by_ranges(table, upper, lower, model.params))
    return rounded(moved.topic_terms().filter("weight > 0").select("topic_id", "term", "weight"), "weight", digits=8)


@query
def nmf_loss_given_h(spark, sf):
    """The losses of both kinds for a given H and the W it gives, from one read of the rows."""
    _, vectorizer, rows = _matrix(spark, sf)
    models = [given_model(spark, sf, vectorizer, beta_loss=loss) for loss in U.GRID_LOSSES]
    sums = N._passes(rows, [m.h for m in models], [m.params for m in models])
    return rounded(spark.createDataFrame([(m.params.beta_loss, float(s[2])) for m, s in zip(models, sums)], "loss string, value double"), "value")


@query
def nmf_given_h(spark, sf):
    """Top terms of given topic weights: the document frequencies per language."""
    terms = lang_term_df(spark, sf).select("topic_id", "term", (F.col("df") / 100).alias("weight"))
    return N.top_terms_per_topic(terms, 12)


@query
def nmf_given_w(spark, sf):
    """Normalised topics of given document weights."""
    rows = N.document_topics(topic_weights(spark, sf))
    shares = [F.col("topic_distribution")[t].alias(f"p{t}") for t in range(4)]
    return rows.select("doc_id", "dominant_topic", "dominant_probability", *shares)


@query
def reconstruction_error(spark, sf):
    """X from TF-IDF, W and H from the language topics."""
    docs = corpus(spark, sf)
    weights = I.fit_tfidf(docs, **I.PRESETS["tfidf"]).transform(docs, partitioned=True)
    entries = topic_weights(spark, sf).select("doc_id", F.posexplode("w").alias("topic_id", "weight"))
    topics = lang_topics(spark, sf).select("topic_id", "term", (F.col("weight") / 1000).alias("weight"))
    return rounded(N.reconstruction_error(weights, entries, topics), "reconstruction_error")


@query
def nmf_predict(spark, sf):
    """Unseen texts scored with the vocabulary of the documents and a given H: every predicted topic."""
    _, vectorizer, _ = _matrix(spark, sf)
    unseen = table(spark, sf, "benchmark").select(F.col("item_id").alias("doc_id"), "text")
    return _predicted(S.predict(unseen, given_model(spark, sf, vectorizer), vectorizer, 3))


def _predicted(scored):
    rows = scored.select("doc_id", "dominant_topic", F.posexplode("topics").alias("pos", "t"))
    flat = rows.select("doc_id", "dominant_topic", F.col("pos").cast("bigint").alias("pos"), "t.topic_id", F.col("t.probability").alias("weight"))
    return rounded(flat, "weight")


def _lda(spark, sf):
    """Every term of the corpus, a preset of the trainer."""
    docs = corpus(spark, sf)
    vectorizer = I.fit_tfidf(docs, (1, 1), 1, 1.0, None)
    bags = vectorizer.bags(docs).persist()
    return docs, vectorizer, bags, O.fit_online_lda(bags, vectorizer.vocab, **L.PRESETS["standard"])


@query
def lda_topics(spark, sf):
    """A property row for each topic, not the values: the seeded start decides those."""
    return topic_shape(_lda(spark, sf)[3].topics(10))


@query
def lda_doc_topics(spark, sf):
    """Properties: as many weights as topics, of sum 1, or 0 and topic -1 for a document without tokens."""
    _, _, bags, model = _lda(spark, sf)
    found = model.transform(bags).persist()
    total = F.round(F.aggregate("w", F.lit(0.0), lambda a, x: a + x), 6) + F.lit(0.0)
    sums = found.select("doc_id", F.size("w").cast("bigint").alias("n_topics"), total.alias("total"))
    none = L.dominant_topics(found).select("doc_id", (F.col("dominant_topic") == -1).alias("none"))
    return sums.join(none, "doc_id")


@query
def lda_perplexity(spark, sf):
    """That the bound of a word is finite and below that of a certain one, and better than the uniform guess."""
    _, vectorizer, bags, model = _lda(spark, sf)
    bound = model.log_perplexity(bags)
    better = bound > -float(np.log(vectorizer.vocab.count()))
    return spark.createDataFrame([(bool(np.isfinite(bound)), bound < 0, better)], "finite boolean, negative boolean, informed boolean")


def given_lda(spark, sf, ranged=False):
    """Topics from the tables: a tenth and the document frequency in the language; two inner iterations and fixed priors."""
    docs = corpus(spark, sf)
    vectorizer = I.fit_tfidf(docs, (1, 1), 1, 1.0, None)
    lam = np.full((len(LANGS), vectorizer.vocab.count()), 0.1)
    known = lang_term_df(spark, sf).filter("topic_id IS NOT NULL").join(vectorizer.vocab.select("term", "term_id"), "term")
    cells = known.select("topic_id", "term_id", "df").toArrow()
    lam[cells["topic_id"].to_numpy(), cells["term_id"].to_numpy()] += cells["df"].to_numpy()
    params = O.LdaParams(k=len(LANGS), learn_priors=False, iterations=2, threshold=0.0)
    model = O.OnlineLda(params, vectorizer.vocab, np.full(len(LANGS), 0.25), lam, np.full(lam.shape[1], 0.5))
    if ranged:
        model = O.OnlineLda(params, vectorizer.vocab, model.alpha, table=cut_lineage(O._table(model)))
    return model, vectorizer.bags(docs)


@query
def lda_infer_given_topics(spark, sf):
    """Topic distributions of all documents for given topics."""
    model, bags = given_lda(spark, sf)
    return _weights(model.transform(bags))


def _topics_after(model, bags):
    """All weights of the topics after one step that replaces them."""
    table = O._table(model.update(bags, 1.0)).select("part", "m")
    named = entries_of(table, model.params.k).join(model.vocab.select("term_id", "term"), "term_id")
    return rounded(named.select("topic_id", "term", "weight"), "weight")


@query
def lda_step_given_topics(spark, sf):
    """One step of online variational Bayes from given topics: inference of all documents and the next topics."""
    return _topics_after(*given_lda(spark, sf))


@query
def lda_step_by_ranges(spark, sf):
    """As ``lda_step_given_topics``, with the topics as a table of word ranges."""
    return _topics_after(*given_lda(spark, sf, ranged=True))


@query
def lda_bound_given_topics(spark, sf):
    """The variational bound of a word for given topics, and that of topics in word ranges."""
    found = [(kind, *given_lda(spark, sf, kind == "ranges")) for kind in ("whole", "ranges")]
    return rounded(spark.createDataFrame([(kind, model.log_perplexity(bags)) for kind, model, bags in found], "topics string, bound double"), "bound")


@query
def lda_given_distributions(spark, sf):
    """Dominant topic with -1 for documents without any topic word."""
    return L.dominant_topics(topic_weights(spark, sf))


@query
def predict_topk(spark, sf):
    top = S.top_topics(topic_weights(spark, sf), 3)
    entries = top.select("doc_id", "dominant_topic", "confidence", F.posexplode("topics").alias("pos", "t"))
    flat = entries.select(
        "doc_id", "dominant_topic", "confidence", F.col("pos").cast("bigint").alias("pos"), "t.topic_id", "t.probability"
    )
    return rounded(flat, "confidence", "probability")


@query
def predict_words(spark, sf):
    """Predictions with the top words of each predicted topic."""
    top = S.attach_words(S.top_topics(topic_weights(spark, sf), 2), lang_topics(spark, sf), 5)
    entries = top.select("doc_id", F.explode("topics").alias("t"))
    return entries.select("doc_id", "t.topic_id", F.array_join("t.topic_words.word", " ").alias("words"))


def _turns(spark, sf):
    """Conversation turns, those of the system role without text."""
    text = F.when(F.col("role") != "system", F.col("text"))
    return table(spark, sf, "conversations").select((F.col("conv_id") * 1000 + F.col("turn")).alias("doc_id"), text.alias("text"))


@query
def predict_batch(spark, sf):
    """Conversation turns scored in bulk with a given H: every prediction, and the error of those without text."""
    _, vectorizer, _ = _matrix(spark, sf)
    scored = S.predict_batch(_turns(spark, sf), given_model(spark, sf, vectorizer), vectorizer)
    flat = scored.select("doc_id", "error", F.coalesce("prediction.dominant_topic", F.lit(-1)).alias("dominant_topic"), F.col("prediction.confidence").alias("confidence"))
    return rounded(flat, "confidence")


@query
def predict_batch_counts(spark, sf):
    _, vectorizer, _ = _matrix(spark, sf)
    return S.batch_counts(S.predict_batch(_turns(spark, sf), given_model(spark, sf, vectorizer), vectorizer))


# --- evaluation


@query
def coherence_cv(spark, sf):
    return rounded(C.coherence_cv(corpus(spark, sf), lang_topics(spark, sf)), "coherence")


@query
def coherence_of_runs(spark, sf):
    """All measures of two topic sets from one scan: ten and five words of each language."""
    topics = lang_topics(spark, sf)
    runs = topics.withColumn("run_id", F.lit(0)).unionByName(topics.filter("rank <= 5").withColumn("run_id", F.lit(1)))
    return rounded(C.coherence_of_runs(corpus(spark, sf), runs, list(C.MEASURES)), "coherence", digits=4)


@query
def coherence_npmi(spark, sf):
    return rounded(C.coherence_npmi(corpus(spark, sf), lang_topics(spark, sf)), "coherence")


@query
def coherence_uci(spark, sf):
    return rounded(C.coherence_uci(corpus(spark, sf), lang_topics(spark, sf)), "coherence")


@query
def coherence_umass(spark, sf):
    return rounded(C.coherence_umass(corpus(spark, sf), lang_topics(spark, sf)), "coherence")


@query
def topic_diversity(spark, sf):
    return rounded(M.topic_diversity(lang_topics(spark, sf)), "diversity")


@query
def topic_intrusion(spark, sf):
    """On the short texts, where the score is not saturated."""
    turns = table(spark, sf, "conversations").select(K.split_clean(T.clean(F.col("text"))).alias("tokens"))
    return rounded(M.topic_intrusion(turns, lang_topics(spark, sf)), "intrusion")


@query
def silhouette(spark, sf):
    points = table(spark, sf, "embeddings").select(F.col("embedding").cast("array<double>").alias("vector"), "label")
    return rounded(H.silhouette(points), "silhouette")


@query
def silhouette_squared(spark, sf):
    points = table(spark, sf, "embeddings").select(F.col("embedding").cast("array<double>").alias("vector"), "label")
    return rounded(H.silhouette_squared(points), "silhouette")


@query
def evaluate_models(spark, sf):
    """The metric records of two models made of the tables, one of which cannot be loaded; the time is left out."""

    def broken():
        raise ValueError("not there")

    given = G.Candidate("given", lang_topics(spark, sf), topic_weights(spark, sf), -7.5, 12.25)
    found, _, _ = G.compare([("given", lambda: given), ("broken", broken)], corpus(spark, sf))
    kept = found.filter(~F.col("metric").isin("evaluation_time", "silhouette_squared"))
    return rounded(kept.select("model", "metric", "value", "error"), "value", digits=4)


@query
def metric_winners(spark, sf):
    return rounded(M.metric_winners(model_metrics(spark, sf)), "score")


@query
def metric_summary(spark, sf):
    return rounded(M.metric_summary(model_metrics(spark, sf)), "mean", "std", "min", "max")


@query
def metric_matrix(spark, sf):
    names = ["topic_diversity", "coherence_score", "perplexity", "silhouette_score", "num_topics"]
    return rounded(M.metric_matrix(model_metrics(spark, sf)), *names)


@query
def radar_scores(spark, sf):
    names = ["topic_diversity", "coherence_score", "perplexity_inverted", "silhouette_score"]
    metrics = model_metrics(spark, sf)
    flipped = F.when(F.col("metric") == "perplexity", -100 * F.col("value")).otherwise(F.col("value"))
    return rounded(M.radar_scores(metrics.withColumn("value", flipped)), *names)


@query
def topic_sizes(spark, sf):
    return M.topic_sizes(L.dominant_topics(topic_weights(spark, sf)))


@query
def topic_consistency(spark, sf):
    return rounded(M.topic_consistency(C.coherence_npmi(corpus(spark, sf), lang_topics(spark, sf))), "mean", "std")


@query
def topic_prevalence(spark, sf):
    entries = topic_weights(spark, sf).select("doc_id", F.posexplode("w").alias("topic_id", "weight"))
    lengths = corpus(spark, sf).select("doc_id", F.size("tokens").alias("doc_len"))
    return rounded(M.topic_prevalence(entries, lengths), "mass", "prevalence")


@query
def term_relevance(spark, sf):
    stats = lang_term_df(spark, sf)
    totals = stats.groupBy("topic_id").agg(F.sum("df").alias("total"))
    phi = stats.join(totals, "topic_id").select("topic_id", "term", (F.col("df") / F.col("total")).alias("phi"))
    ranked = M.term_relevance(phi, V.term_counts(corpus(spark, sf)), lam=0.6, n=30)
    return rounded(ranked, "relevance")


@query
def latest_predictions(spark, sf):
    events = table(spark, sf, "events")
    last = R.latest(events, 10, "ts", "event_id", per="event_type")
    return last.select("event_type", "event_id", F.col("value").alias("confidence"), F.col("rank").cast("bigint").alias("rank"))


@query
def latest_overall(spark, sf):
    return R.latest(table(spark, sf, "events"), 10, "ts", "event_id").select("event_id", "event_type", "value")


# --- tuning


def _run_shape(runs, higher_is_better=True):
    """Properties of a table of runs: each setting once with a finite score, none better than that of ``best_run``."""
    best = U.best_run(runs, higher_is_better).select("value").scalar()
    beaten = F.col("value") <= best if higher_is_better else F.col("value") >= best
    return runs.select(
        F.coalesce("max_features", F.lit(0)).alias("max_features"), F.coalesce("beta_loss", F.lit("-")).alias("beta_loss"), "k", "metric",
        F.coalesce(~F.isnan("value"), F.lit(False)).alias("scored"), beaten.alias("within"),
    )


@query
def topic_sweep_lda(spark, sf):
    docs = corpus(spark, sf)
    vectorizer = I.fit_tfidf(docs, (1, 1), 1, 1.0, None)
    bags = vectorizer.bags(docs).persist()
    return _run_shape(U.sweep_lda(docs, bags, vectorizer.vocab, U.LDA_COUNTS, passes=10))


@query
def topic_sweep_nmf(spark, sf):
    docs, vectorizer, rows = _matrix(spark, sf)
    return _run_shape(U.sweep_nmf(docs, rows, vectorizer.vocab, U.NMF_COUNTS, "reconstruction_error", inner_iter=10), higher_is_better=False)


@query
def grid_search(spark, sf):
    """All settings of the grid: vocabulary sizes, losses and topic counts."""
    found = U.grid_search_nmf(corpus(spark, sf), counts=U.GRID_COUNTS, inner_iter=10)
    return _run_shape(found.runs)


def _runs(spark, sf):
    """Runs made of the tables: a setting per source and language, scored by mean length."""
    stats = documents(spark, sf).groupBy("source", "lang").agg(F.avg("n_chars").alias("value"), F.min("doc_id").alias("first"))
    return stats.select(
        F.col("first").alias("run_id"), F.lit("nmf").alias("model"), F.length("source").alias("max_features"),
        F.col("lang").alias("beta_loss"), F.lit(0.0).alias("alpha_w"), F.lit(0.0).alias("alpha_h"), F.lit(0.0).alias("l1_ratio"), F.col("first").cast("int").alias("k"), F.lit("coherence").alias("metric"), "value",
    )


@query
def best_run(spark, sf):
    return rounded(U.best_run(_runs(spark, sf)).select("run_id", "k", "beta_loss", "value"), "value")


@query
def sweep_table(spark, sf):
    return rounded(U.sweep_table(_runs(spark, sf)), "value").select("max_features", "beta_loss", "k", "value")


# --- relational operators


@query
def filter_sorted(spark, sf):
    rows = documents(spark, sf).select("doc_id", "lang").join(table(spark, sf, "labels"), "doc_id", "left")
    kept, _ = R.filter_equal(rows, "toxic", None, "quality", "doc_id")
    return kept.select("doc_id", "lang", "quality")


@query
def filter_count(spark, sf):
    _, count = R.filter_equal(table(spark, sf, "events"), "event_type", "click")
    return count


@query
def threshold_filter(spark, sf):
    docs = documents(spark, sf).select("doc_id", K.split_clean(T.clean(F.col("text"))).alias("tokens"))
    return V.document_frequency(docs).filter(F.col("df") > V.share_of(0.2, row_count(docs)))


@query
def tokens_union(spark, sf):
    return R.union_distinct(*_token_sets(spark, sf))


@query
def tokens_difference(spark, sf):
    return R.difference(*_token_sets(spark, sf))


def _token_sets(spark, sf):
    words = K.split_clean(T.clean(F.col("text")))
    return tuple(
        table(spark, sf, name).select(F.explode(words).alias("token")) for name in ("documents", "conversations")
    )


@query
def head_documents(spark, sf):
    return R.head(documents(spark, sf), 100).select("doc_id", "lang", "n_chars")
