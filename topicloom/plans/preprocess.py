"""The whole preprocessing job: clean, tokenize, lemmatize, merge phrases."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from topicloom.functions.stopwords import merged_stopwords
from topicloom.functions.text import clean
from topicloom.functions.tokens import join_tokens, keep_tokens, split_clean
from topicloom.operators.lexicon import collect_tokens, lemmatize, token_rows
from topicloom.operators.phrases import apply_phrases, build_ngrams
from topicloom.runtime import by_document


def surface_tokens(
    text: Column,
    stopwords: Sequence[str] | None = None,
    min_length: int = 2,
    cleaner: Callable[[Column], Column] = clean,
    splitter: Callable[[Column], Column] = split_clean,
) -> Column:
    """Tokens of a text, without short ones and stopwords; none for a null text."""
    words = merged_stopwords() if stopwords is None else list(stopwords)
    return keep_tokens(splitter(cleaner(F.coalesce(text, F.lit("")))), words, min_length)


def tokenize(
    docs: DataFrame,
    text: str = "text",
    stopwords: Sequence[str] | None = None,
    min_length: int = 2,
    lexicon: DataFrame | None = None,
    cleaner: Callable[[Column], Column] = clean,
    splitter: Callable[[Column], Column] = split_clean,
) -> DataFrame:
    """(doc_id, tokens) hashed by ``doc_id``. The length and stopword tests are on the surface form, the
    output is the lemma. ``cleaner`` (text to text) and ``splitter`` (text to array) may be any Column functions,
    for example ``clean_light`` and ``split_words``."""
    found = surface_tokens(F.col(text), stopwords, min_length, cleaner, splitter)
    tokens = by_document(docs.select("doc_id", found.alias("tokens")))
    return tokens if lexicon is None else collect_tokens(lemmatize(token_rows(tokens), lexicon))


@dataclass(frozen=True)
class Preprocessed:
    """The corpus (doc_id, text, cleaned_text, tokens), its tokens alone (doc_id, tokens) hashed by ``doc_id``, and the
    phrase table of each pass."""

    corpus: DataFrame
    tokens: DataFrame
    phrases: list[DataFrame]


def fit_preprocess(
    docs: DataFrame,
    text: str = "text",
    stopwords: Sequence[str] | None = None,
    min_length: int = 2,
    lexicon: DataFrame | None = None,
    bigrams: bool = True,
    trigrams: bool = True,
    min_count: int = 5,
    threshold: float = 100.0,
    cleaner: Callable[[Column], Column] = clean,
    splitter: Callable[[Column], Column] = split_clean,
) -> Preprocessed:
    """Clean, tokenize and merge phrases. Without a lexicon a text stays beside its tokens, and phrases are merged inside the row, so
    no text is shuffled; lemmas are collected by ``doc_id`` and the texts joined to them. The token table of each phrase pass
    is cached, as the pass reads it several times."""
    texts = docs.select("doc_id", F.col(text).alias("text"))
    if lexicon is None:
        first = texts.withColumn("tokens", surface_tokens(F.col("text"), stopwords, min_length, cleaner, splitter)).persist()
    else:
        first = tokenize(docs, text, stopwords, min_length, lexicon, cleaner, splitter).persist()
    merged, phrases = build_ngrams(first, bigrams, trigrams, min_count, threshold)
    if phrases:
        first.unpersist()
    corpus = merged if lexicon is None else texts.join(merged, "doc_id")
    tokens = merged if lexicon is not None else by_document(merged.select("doc_id", "tokens")).persist()
    return Preprocessed(corpus.select("doc_id", "text", join_tokens(F.col("tokens")).alias("cleaned_text"), "tokens"), tokens, phrases)


def preprocess(docs: DataFrame, **options) -> DataFrame:
    """(doc_id, text, cleaned_text, tokens)."""
    return fit_preprocess(docs, **options).corpus


def preprocess_new(
    docs: DataFrame,
    phrase_tables: Sequence[DataFrame],
    text: str = "text",
    stopwords: Sequence[str] | None = None,
    min_length: int = 2,
    lexicon: DataFrame | None = None,
    cleaner: Callable[[Column], Column] = clean,
    splitter: Callable[[Column], Column] = split_clean,
) -> DataFrame:
    """Tokens of unseen documents with the phrases learned in training, one table per pass."""
    tokens = tokenize(docs, text, stopwords, min_length, lexicon, cleaner, splitter)
    for phrases in phrase_tables:
        tokens = apply_phrases(tokens, phrases)
    return tokens
