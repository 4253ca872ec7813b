"""Sources, sinks, validation and relational operators."""

import pytest
from pyspark.sql import functions as F

from topicloom.operators import relational as R
from topicloom.operators import validate as B
from topicloom.runtime import DataValidationError
from topicloom.sources import readers, writers


def test_csv(spark, tmp_path):
    (tmp_path / "c.csv").write_text('category,text\nnews,"a, ""b""\nc"\nsport,\n', encoding="utf-8")
    rows = readers.read_csv(spark, str(tmp_path / "c.csv"), multiline=True).collect()
    assert [(r.category, r.text) for r in rows] == [("news", 'a, "b"\nc'), ("sport", None)]


def test_csv_without_line_breaks_can_be_split(spark, tmp_path):
    (tmp_path / "c.csv").write_text('category,text\nnews,"a, ""b"""\nsport,\n', encoding="utf-8")
    rows = readers.read_csv(spark, str(tmp_path / "c.csv")).collect()
    assert [(r.category, r.text) for r in rows] == [("news", 'a, "b"'), ("sport", None)]


TSV = "category\tfilename\ttitle\tcontent\nb\t1\tt\tshort \"quote\nb\t2\tt\tok\textra\nb\t3\tt\nb\t4\tt\tlast\n"


def test_tsv_skips_long_lines(spark, tmp_path):
    (tmp_path / "c.tsv").write_text(TSV)
    rows = readers.read_tsv(spark, str(tmp_path / "c.tsv")).collect()
    assert [(r.filename, r.content) for r in rows] == [("1", 'short "quote'), ("3", None), ("4", "last")]


def test_a_row_equal_to_the_header_is_kept(spark, tmp_path):
    for name in "ab":
        (tmp_path / f"{name}.tsv").write_text("x\ty\n1\t2\nx\ty\n")
    rows = readers.read_tsv(spark, str(tmp_path)).collect()
    assert sorted((r.x, r.y) for r in rows) == [("1", "2"), ("1", "2"), ("x", "y"), ("x", "y")]


def test_ragged_tsv_keeps_long_lines(spark, tmp_path):
    (tmp_path / "c.tsv").write_text(TSV)
    rows = readers.read_ragged_tsv(spark, str(tmp_path / "c.tsv")).collect()
    assert [(r.filename, r.content) for r in rows] == [("1", 'short "quote'), ("2", "ok"), ("4", "last")]
    assert readers.read_ragged_tsv(spark, str(tmp_path / "c.tsv"), max_rows=1).count() == 1


def test_in_memory_and_generic_sources(spark, tmp_path):
    docs = readers.corpus_from_list(spark, ["x", 5])
    assert [(r.doc_id, r.text) for r in docs.orderBy("doc_id").collect()] == [(0, "x"), (1, "5")]
    writers.write_json(docs, str(tmp_path / "j"))
    again = readers.read_corpus(spark, str(tmp_path / "j"), "json")
    assert sorted(again.columns) == ["doc_id", "text"] and again.count() == 2


def test_token_columns(spark):
    text = spark.createDataFrame([("['a', \"it's\", 'c_d']",), ("[]",)], "tokens string")
    assert [r.tokens for r in readers.load_tokens(text).collect()] == [["a", "it's", "c_d"], []]
    other = spark.createDataFrame([(["x"], "y z")], "cleaned_tokens array<string>, cleaned_text string")
    assert readers.load_tokens(other).first().tokens == ["x"]
    assert readers.load_tokens(other.select("cleaned_text")).first().tokens == ["y", "z"]
    with pytest.raises(DataValidationError):
        readers.load_tokens(spark.range(1))


def test_topics_round_trip(spark, tmp_path):
    rows = [(0, 1, "high_definition", 0.0104), (0, 2, "dvd", 0.01), (1, 1, "game", 0.02)]
    topics = spark.createDataFrame(rows, "topic_id int, rank int, term string, weight double")
    writers.write_topics(topics, str(tmp_path / "t"), "csv")
    back = readers.read_topics_csv(spark, str(tmp_path / "t"))
    assert sorted(map(tuple, back.collect())) == rows
    writers.write_topics(topics, str(tmp_path / "p"))
    assert spark.read.parquet(str(tmp_path / "p")).count() == 2


def test_document_sinks(spark, tmp_path, corpus):
    docs = corpus("a b", "c")
    writers.write_corpus(docs, str(tmp_path / "c"))
    assert readers.load_tokens(spark.read.parquet(str(tmp_path / "c"))).count() == 2
    topics = spark.createDataFrame([(0, 3), (1, 1)], "doc_id bigint, dominant_topic int")
    writers.write_documents_with_topics(docs, topics, str(tmp_path / "d"))
    assert {r.dominant_topic for r in spark.read.parquet(str(tmp_path / "d")).collect()} == {1, 3}
    writers.write_embeddings(spark.createDataFrame([(0, [1.0])], "doc_id bigint, vector array<float>"), str(tmp_path / "e"))
    assert spark.read.parquet(str(tmp_path / "e")).first().vector == [1.0]


def test_report(spark, tmp_path):
    metrics = spark.createDataFrame([("m", "a", 1.0), ("m", "b", None)], "model string, metric string, value double")
    topics = spark.createDataFrame([("m", 0, 1, "x", 0.5)], "model string, topic_id int, rank int, term string, weight double")
    writers.write_json(writers.evaluation_report(metrics, topics), str(tmp_path / "r"))
    row = spark.read.json(str(tmp_path / "r")).first()
    assert row.metrics.a == 1.0 and row.topics[0].words[0].term == "x"


def test_validation(spark):
    df = spark.createDataFrame([(1, " a "), (1, " a "), (2, None)], "id int, text string")
    assert {(r.column_name, r.n_nulls, r.n_rows, r.n_columns) for r in B.profile(df).collect()} == {("id", 0, 3, 2), ("text", 1, 3, 2)}
    assert tuple(B.duplicate_count(df).first()) == (3, 1)
    assert B.drop_duplicates(df).count() == 2
    with pytest.raises(DataValidationError, match="columns"):
        B.validated(df, ["id", "body"])
    with pytest.raises(DataValidationError, match="values.*text"):
        B.validated(df)
    full = df.na.drop()
    with pytest.raises(DataValidationError, match="1 duplicate"):
        B.validated(full)

    def too_few(table):
        raise DataValidationError("custom")

    with pytest.raises(DataValidationError, match="custom"):
        B.validated(full, allow_duplicates=True, extra_checks=[too_few])
    assert [r.text for r in B.validated(full, ["id"], allow_duplicates=True).collect()] == ["a", "a"]
    empty = B.duplicate_count(df.limit(0)).first()
    assert tuple(empty) == (0, 0)


def test_relational(spark):
    df = spark.createDataFrame([(1, "a", 3), (2, "a", None), (3, None, 1), (4, "a", -1)], "id int, k string, v int")
    kept, count = R.filter_equal(df, "k", "a", "v", "id")
    assert [r.id for r in kept.collect()] == [4, 2, 1] and count.first().n_matches == 3
    assert [r.id for r in R.filter_equal(df, "k", None)[0].collect()] == [3]
    assert [r.id for r in R.top_n(df, 2, F.col("id").desc()).collect()] == [4, 3]
    assert R.top_per_group(df, ["k"], 1, F.col("id")).count() == 2
    assert sorted(r.k or "" for r in R.union_distinct(df.select("k"), df.select("k")).collect()) == ["", "a"]
    assert R.difference(df.select("id"), df.filter("id < 3").select("id")).count() == 2
    assert [r.id for r in R.head(df, 2, "id").collect()] == [1, 2]
    assert [r.id for r in R.latest(df, 1, "id").collect()] == [4]


def test_key_and_repeated_texts(spark):
    from topicloom.operators.validate import validated

    rows = lambda *r: spark.createDataFrame(list(r), "doc_id bigint, text string")
    assert validated(rows((1, "a"), (2, "b")), ["text"], key="doc_id").count() == 2
    with pytest.raises(DataValidationError, match="1 duplicate rows"):
        validated(rows((1, "a"), (2, "a")), ["text"], key="doc_id")
    assert validated(rows((1, "a"), (2, "a")), ["text"], True, key="doc_id").count() == 2
    with pytest.raises(DataValidationError, match="repeat a doc_id"):
        validated(rows((1, "a"), (1, "b")), ["text"], True, key="doc_id")


REPEATS = [("a", 1, 0.0), ("a", 1, -0.0), ("a", None, 0.0), (None, None, None), (None, None, None), ("b", None, 1.0), ("c" * 100_000, 2, None), ("c" * 100_000, 2, None), ("c" * 100_000, 2, None)]


@pytest.mark.parametrize("limit", [0, 1000])
@pytest.mark.parametrize("values", [1, 2, 2**62])
def test_duplicates_by_fingerprint(spark, monkeypatch, limit, values):
    """With few values most rows share a fingerprint with rows that differ."""
    made = B.fingerprint
    monkeypatch.setattr(B, "fingerprint", lambda df: F.struct(F.pmod(made(df)["h1"], F.lit(values)).alias("h1")))
    monkeypatch.setattr(B, "BROADCAST_ROW_LIMIT", limit)
    df = spark.createDataFrame(REPEATS, "`te.xt` string, _n int, _fingerprint double")
    assert tuple(B.duplicate_count(df).first()) == (9, 4)
    once = B.drop_duplicates(df)
    assert once.columns == df.columns
    assert sorted(map(str, once.collect())) == sorted(map(str, df.dropDuplicates().collect()))
    assert tuple(B.duplicate_count(df.limit(0)).first()) == (0, 0) and B.drop_duplicates(df.limit(0)).count() == 0


def test_rows_of_their_own_fingerprint_are_not_shuffled(spark):
    df = spark.range(1000).select(F.repeat(F.col("id").cast("string"), 1000).alias("text"))
    counts, _, _, repeated = B._suspects(df)
    assert repeated.count() == 0
    plan = counts._jdf.queryExecution().executedPlan().toString()
    assert "text" not in plan[: plan.index("Project")]
    assert B.drop_duplicates(df).count() == 1000
