"""Text cleaning as Column expressions. Everything but entity decoding stays in the JVM."""

from __future__ import annotations

import string
from collections.abc import Sequence
from functools import cache

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# Contraction expansions, applied in this order, unanchored.
CONTRACTIONS = (
    ("it's", "it is"),
    ("can't", "cannot"),
    ("'re", " are"),
    ("'s", " is"),
    ("'d", " would"),
    ("'ll", " will"),
    ("'t", " not"),
    ("'ve", " have"),
    ("'m", " am"),
)

# White space as Python's str methods and Unicode regexes see it; Java's \s is ASCII only.
WHITESPACE = r"\s\x1c-\x1f\x85\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
# Word characters as in a Unicode regex (letters, digits of all kinds, underscore).
WORD = r"\p{L}\p{N}_"


@cache
def _entity_decoder():
    # One UDF object per process: equal plans stay equal, so Spark can reuse caches and shuffles. It is defined
    # inside a function to be shipped by value.
    def decode(texts: pd.Series) -> pd.Series:
        import html

        return texts.map(html.unescape, na_action="ignore")

    return F.pandas_udf(decode, "string")


def unescape_html(text: Column) -> Column:
    """Decode HTML entities once. Only texts that hold an ampersand travel to Python; the others
    are sent as nulls and taken from the JVM column."""
    return F.coalesce(_entity_decoder()(F.when(F.contains(text, F.lit("&")), text)), text)


def strip_tags(text: Column) -> Column:
    """Replace each shortest ``<...>`` on one line by a space; only a line feed ends a line."""
    return F.regexp_replace(text, r"(?d)<.*?>", " ")


def expand_contractions(text: Column) -> Column:
    for short, full in CONTRACTIONS:
        text = F.replace(text, F.lit(short), F.lit(full))
    return text


def letters_only(text: Column) -> Column:
    """Keep a-z, collapse everything else to single spaces and trim, in one pass."""
    return F.trim(F.regexp_replace(text, r"[^a-z]+", " "))


def clean(text: Column, contractions: bool = True, entities: bool = True) -> Column:
    """Full cleaner: entities, tags, lower case, contractions, letters only."""
    if entities:
        text = unescape_html(text)
    text = F.lower(strip_tags(text))
    if contractions:
        text = expand_contractions(text)
    return letters_only(text)


def clean_light(text: Column, entities: bool = True) -> Column:
    """Cleaner without contraction expansion."""
    return clean(text, contractions=False, entities=entities)


def clean_raw(text: Column) -> Column:
    """Cleaner that drops web and mail addresses first; a null text becomes an empty one."""
    text = F.lower(F.coalesce(text, F.lit("")))
    web = F.regexp_replace(text, rf"https?://[^{WHITESPACE}]+|www\.[^{WHITESPACE}]+", "")
    text = F.when(F.contains(text, F.lit("://")) | F.contains(text, F.lit("www.")), web).otherwise(text)
    # A word with an @ inside goes whole. Each word is entered at its start only and read once, however long it is.
    mail = F.regexp_replace(text, rf"(?<![^{WHITESPACE}])[^{WHITESPACE}][^@{WHITESPACE}]*+@[^{WHITESPACE}]+", "")
    return letters_only(F.when(F.contains(text, F.lit("@")), mail).otherwise(text))


def clean_words(text: Column, stopwords: Sequence[str], min_length: int = 3) -> Column:
    """Cleaner that also drops stopwords and short words and joins the rest again."""
    words = F.split(letters_only(F.lower(text)), " ")
    kept = F.filter(words, lambda w: (F.length(w) >= min_length) & ~w.isin(list(stopwords)))
    return F.array_join(kept, " ")


def process_text(
    text: Column,
    lowercase: bool = True,
    remove_punctuation: bool = False,
    max_length: int | None = None,
) -> Column:
    """Configurable processing; returns a struct of the text, its lengths before and after and the
    options used. A null or empty text fails the query, as it is an error for the caller."""
    done = text
    if lowercase:
        done = F.lower(done)
    if remove_punctuation:
        done = F.translate(done, string.punctuation, "")
    if max_length:
        done = F.left(done, F.lit(max_length))
    result = F.struct(
        done.alias("processed_text"),
        F.length(text).alias("original_length"),
        F.length(done).alias("processed_length"),
        F.struct(
            F.lit(lowercase).alias("lowercase"),
            F.lit(remove_punctuation).alias("remove_punctuation"),
            F.lit(max_length).cast("int").alias("max_length"),
        ).alias("options_used"),
    )
    empty = text.isNull() | (text == "")
    return F.when(empty, F.raise_error("text cannot be empty or null")).otherwise(result)


def repeat_text(text: Column, multiplier: int = 2) -> Column:
    return F.repeat(text, F.lit(multiplier))


def trim_whitespace(text: Column) -> Column:
    return F.regexp_replace(text, rf"^[{WHITESPACE}]+|[{WHITESPACE}]+$", "")
