import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(autouse=True)
def no_caches_left(spark):
    yield
    spark.catalog.clearCache()


@pytest.fixture
def corpus(spark):
    """Token lists to (doc_id, tokens)."""

    def build(*docs):
        rows = [(i, list(d.split()) if isinstance(d, str) else list(d)) for i, d in enumerate(docs)]
        return spark.createDataFrame(rows, "doc_id bigint, tokens array<string>")

    return build


@pytest.fixture
def value(spark):
    """Evaluate a text expression on one input."""
    from pyspark.sql import functions as F

    def run(function, text):
        return spark.createDataFrame([(text,)], "text string").select(function(F.col("text")).alias("v")).first().v

    return run
