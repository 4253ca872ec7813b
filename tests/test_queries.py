"""Every registered query beside its DuckDB statement on the smallest data."""

import importlib.util
import os

import duckdb
import pytest

from checks.catalog import QUERIES
from checks.compare import TABLES, compare
from checks.oracle import ORACLE
from topicloom.models import tuning as U

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def test_statements_belong_to_queries():
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query(spark, con, name):
    result = compare(spark, con, SF, name)
    assert result.startswith("ok"), result


@pytest.mark.parametrize("name, function", [("grid_search", "grid_search_nmf"), ("topic_sweep_lda", "sweep_lda"), ("topic_sweep_nmf", "sweep_nmf")])
def test_sweeps_run_the_whole_reference(spark, monkeypatch, name, function):
    """All topic counts, at least the reference's 10 passes and the library's tolerance."""
    asked = {}

    def stop(*args, **options):
        asked.update(options, counts=options.get("counts", args[3] if len(args) > 3 else U.GRID_COUNTS))
        raise InterruptedError

    monkeypatch.setattr(U, function, stop)
    with pytest.raises(InterruptedError):
        QUERIES[name](spark, SF)
    assert asked["counts"] == {"grid_search": range(4, 13), "topic_sweep_lda": range(5, 21), "topic_sweep_nmf": range(2, 11)}[name]
    assert asked.get("passes", 20) >= 10 and asked.get("tol", 1e-4) == 1e-4


def test_entry(spark):
    path = os.path.join(os.path.dirname(os.path.dirname(__file__)), "__spark_entry__.py")
    spec = importlib.util.spec_from_file_location("spark_entry", path)
    module = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(module)
    assert module.entry(spark).count() == 40
    assert set(module.oracle_sql()) <= set(module.queries())
