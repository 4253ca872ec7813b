"""Registered queries of the subpackage beside their DuckDB statements, and the pipeline beside brute force."""

import os

import duckdb
import pytest

import corpus_pipeline
from checks.compare import TABLES, canonical
from tests.llm.test_decontaminate import brute as contaminated
from tests.llm.test_line_runs import brute as without_lines
from topicloom.llm.catalog import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_statement(spark, con, name):
    assert canonical(QUERIES[name](spark, SF).toPandas()).equals(canonical(con.sql(ORACLE[name]).df()))


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_whole_table(spark, con, name):
    key, source = ("page_id", "pages") if name.startswith("op10") else ("doc_id", "documents")
    rows = QUERIES[name](spark, SF)
    if name.startswith("op13"):  # a row for each piece
        rows = rows.filter("start = 0")
    found = sorted(r[0] for r in rows.select(key).collect())
    assert found == [r[0] for r in con.sql(f"SELECT {key} FROM {source} ORDER BY 1").fetchall()]


def test_stages(spark, con):
    """Each stage on what its predecessor kept, against brute force on the same rows."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["language", "line_dedup", "near_duplicates", "decontamination", "byte_bpe"]
    stages = dict(corpus_pipeline.STAGES)
    odd = spark.createDataFrame([(90_000, None, None, "s", 0), (90_001, "12 34", "en", "s", 5), (None, "the of and in the that", None, None, None)], docs.schema)
    told = stages["language"](spark, docs.unionByName(odd), SF)
    assert told.columns == columns
    kept = told.collect()
    assert not {90_000, 90_001} & {r.doc_id for r in kept} and len(kept) >= docs.count()

    cut = stages["line_dedup"](spark, docs, SF)
    expected = without_lines([(r.doc_id, r.text) for r in docs.collect()])
    rows = {r.doc_id: r for r in cut.collect()}
    assert cut.columns == columns
    for (doc_id, text), left in expected.items():
        if left or left == text:
            assert rows[doc_id].text == left and rows[doc_id].n_chars == len(left)

    left = stages["near_duplicates"](spark, docs, SF)
    assert left.columns == columns
    statement = ORACLE["op4_minhash_forest"].replace("85 * (p.n", f"{corpus_pipeline.SIMILAR} * (p.n")
    first = con.sql(f"SELECT doc_id FROM ({statement}) WHERE kept ORDER BY 1").fetchall()
    assert sorted(r.doc_id for r in left.collect()) == [r[0] for r in first]

    clean = stages["decontamination"](spark, docs, SF)
    assert clean.columns == columns
    hits = contaminated([(r.doc_id, r.text) for r in docs.collect()], con.sql("SELECT item_id, text FROM benchmark").fetchall())
    assert sorted(r.doc_id for r in clean.collect()) == sorted(d for d, _, n, _ in hits if not n)


@pytest.mark.parametrize("edits, linked", [(7, True), (8, True), (9, False)])
def test_near_duplicates_from_eighty(spark, documents, edits, linked):
    """Two documents of 400 words on either side of 80 percent, and below the 85 of op4."""
    words = [f"w{k}" for k in range(400)]
    other = [f"x{k}" if k % 40 == 20 and k < 40 * edits else w for k, w in enumerate(words)]
    a, b = ({tuple(t[k : k + 5]) for k in range(396)} for t in (words, other))
    assert (80 <= 100 * len(a & b) / len(a | b) < 85) == linked
    left = dict(corpus_pipeline.STAGES)["near_duplicates"](spark, documents((1, " ".join(words)), (2, " ".join(other))), SF)
    assert sorted(r.doc_id for r in left.collect()) == ([1] if linked else [1, 2])


def test_run(spark):
    found = corpus_pipeline.run(spark, SF)
    assert found.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert 0 < found.count() < 200
