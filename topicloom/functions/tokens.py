"""Token arrays as Column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from topicloom.functions.text import WHITESPACE, WORD


def split_words(text: Column) -> Column:
    """Split on white space, without empty tokens."""
    return F.array_remove(F.split(text, rf"[{WHITESPACE}]+"), "")


def split_clean(text: Column) -> Column:
    """Split a text that holds single spaces only, as the cleaners return it. A literal separator is
    much cheaper than a class of white space."""
    return F.array_remove(F.split(text, " "), "")


def as_tokens(column: Column, is_array: bool) -> Column:
    """Pass token arrays through, split strings."""
    return column if is_array else split_words(column)


def keep_tokens(tokens: Column, stopwords: Sequence[str] = (), min_length: int = 2) -> Column:
    """Drop short tokens and stopwords. The list becomes a hash set at planning time."""

    def kept(token: Column) -> Column:
        long_enough = F.length(token) >= min_length
        return long_enough & ~token.isin(list(stopwords)) if stopwords else long_enough

    return F.filter(tokens, kept)


def alphabetic_tokens(tokens: Column, stopwords: Sequence[str], min_length: int = 3) -> Column:
    """Tokens of letters only that are long enough and no stopwords."""
    return F.filter(
        tokens,
        lambda t: t.rlike(r"^\p{L}+$") & (F.length(t) >= min_length) & ~t.isin(list(stopwords)),
    )


def raw_words(text: Column, min_length: int = 1) -> Column:
    """Maximal runs of word characters of the lower-cased raw text."""
    pattern = rf"[{WORD}]+" if min_length == 1 else rf"[{WORD}]{{{min_length},}}"
    return F.regexp_extract_all(F.lower(text), F.lit(pattern), F.lit(0))


def adjacent_pairs(tokens: Column) -> Column:
    """Array of structs (w1, w2) of neighbouring tokens; empty below two tokens."""
    n = F.greatest(F.size(tokens) - 1, F.lit(0))
    return F.arrays_zip(F.slice(tokens, 1, n).alias("w1"), F.slice(tokens, 2, n).alias("w2"))


def word_ngrams(tokens: Column, low: int, high: int) -> Column:
    """All n-grams for low <= n <= high, words joined by a space. Shifted copies are zipped, because a
    slice per n-gram would copy the whole array each time."""
    grams = []
    for n in range(low, high + 1):
        if n == 1:
            grams.append(tokens)
            continue
        count = F.greatest(F.size(tokens) - (n - 1), F.lit(0))
        names = [f"w{d}" for d in range(n)]
        shifted = F.arrays_zip(*[F.slice(tokens, 1 + d, count).alias(w) for d, w in enumerate(names)])
        grams.append(F.transform(shifted, _joined(names)))
    return grams[0] if len(grams) == 1 else F.concat(*grams)


def _joined(names: list[str]):
    return lambda z: F.concat_ws(" ", *[z[w] for w in names])


def join_tokens(tokens: Column) -> Column:
    return F.array_join(tokens, " ")
