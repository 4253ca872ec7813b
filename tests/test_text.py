import html
import re

import pytest
from pyspark.errors import PythonException, SparkRuntimeException  # noqa: F401
from pyspark.sql import functions as F

from topicloom.functions import text as T
from topicloom.functions import tokens as K
from topicloom.functions.stopwords import ENGLISH, NEWS, merged_stopwords, stopword_table


def expected_clean(text, contractions=True):
    text = re.sub(r"<.*?>", " ", html.unescape(text)).lower()
    if contractions:
        for short, full in T.CONTRACTIONS:
            text = text.replace(short, full)
    return re.sub(r"\s+", " ", re.sub(r"[^a-z\s]", " ", text)).strip()


CASES = [
    "It's can't we're 'this don't won't they've I'm he'd she'll",
    "&amp;lt;b&amp;gt; &lt;b&gt;bold&lt;/b&gt; &eacute;&#39;s &copy 2024",
    "a < b and <i>c</i>\n<open\ntag> <x\ry>",
    "Tabs\tand spaces and　more",
    "",
    "   ",
    "Ünïcode ÀÉ straße",
    "'t is’t",
]


@pytest.mark.parametrize("text", CASES)
def test_cleaners_match_the_steps(value, text):
    assert value(T.clean, text) == expected_clean(text)
    assert value(T.clean_light, text) == expected_clean(text, contractions=False)


def test_contraction_side_effects(value):
    assert value(T.expand_contractions, "'this don't won't") == " nothis don not won not"
    assert value(T.expand_contractions, "it's can't") == "it is cannot"


def test_entities_are_decoded_once(value):
    assert value(T.unescape_html, "&amp;lt;b&amp;gt;") == "&lt;b&gt;"
    assert value(T.unescape_html, None) is None
    assert value(T.unescape_html, "no entity") == "no entity"


def test_tag_spanning_a_line_feed_stays(value):
    assert value(T.strip_tags, "<a\nb> <c>") == "<a\nb>  "
    assert value(T.strip_tags, "<a\rb>") == " "


def test_clean_raw(value):
    text = "See HTTP://x.org/a?b or www.y.com mail me.you@z.org now!"
    plain = re.sub(r"\S+@\S+", "", re.sub(r"https?://\S+|www\.\S+", "", text.lower()))
    assert value(T.clean_raw, text) == re.sub(r"\s+", " ", re.sub(r"[^a-z\s]", " ", plain)).strip()
    assert value(T.clean_raw, None) == ""


def test_clean_words(value):
    assert value(lambda c: T.clean_words(c, ["the"]), "The cat, a big-dog is 42 up") == "cat big dog"


def test_process_text(value):
    row = value(lambda c: T.process_text(c, remove_punctuation=True, max_length=4), "He,L-Lo wörld")
    assert (row.processed_text, row.original_length, row.processed_length) == ("hell", 13, 4)
    assert row.options_used.asDict() == {"lowercase": True, "remove_punctuation": True, "max_length": 4}
    assert value(lambda c: T.process_text(c, max_length=0), "Hello, World!").processed_text == "hello, world!"
    assert value(lambda c: T.process_text(c, lowercase=False), "AbC").processed_text == "AbC"


@pytest.mark.parametrize("text", ["", None])
def test_process_text_rejects_empty(value, text):
    with pytest.raises(Exception, match="empty or null"):
        value(T.process_text, text)


def test_repeat_and_trim(value):
    assert value(lambda c: T.repeat_text(c, 3), "hello") == "hello" * 3
    assert value(T.trim_whitespace, " \t a b  \n") == "a b"


def test_split_and_keep(value):
    assert value(K.split_words, " a b\t c ") == ["a", "b", "c"]
    assert value(K.split_clean, "") == []
    assert value(lambda c: K.keep_tokens(K.split_clean(c), ["the"], 2), "the a cat") == ["cat"]
    assert value(lambda c: K.as_tokens(K.as_tokens(c, False), True), "x y") == ["x", "y"]
    assert value(lambda c: K.alphabetic_tokens(K.split_words(c), ["and"]), "cat x9 and dogs it") == ["cat", "dogs"]


def test_raw_words_are_unicode(value):
    text = "Été_1 d'une x!"
    assert value(K.raw_words, text) == re.findall(r"\b\w+\b", text.lower())
    assert value(lambda c: K.raw_words(c, 2), text) == re.findall(r"\b\w\w+\b", text.lower())


def test_ngrams(spark):
    df = spark.createDataFrame([(["a", "b", "c"],), (["a"],), ([],)], "t array<string>")
    rows = [r.g for r in df.select(K.word_ngrams(F.col("t"), 1, 3).alias("g")).collect()]
    assert rows == [["a", "b", "c", "a b", "b c", "a b c"], ["a"], []]


def test_stopwords(spark):
    from pyspark.ml.feature import StopWordsRemover

    assert ENGLISH == StopWordsRemover.loadDefaultStopWords("english")
    assert len(NEWS) == 15
    merged = merged_stopwords(["Foo"])
    assert set(merged) == set(ENGLISH) | set(NEWS) | {"foo"}
    assert sorted(r.word for r in stopword_table(spark, ["Foo"]).collect()) == merged
