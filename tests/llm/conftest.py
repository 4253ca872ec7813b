import pytest


@pytest.fixture(autouse=True, scope="session")
def shared_folder(spark, tmp_path_factory):
    spark.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("checkpoints")))


SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture
def documents(spark):
    """Rows of (doc_id, text[, lang]) as documents, with a column whose name clashes with those of results."""

    def build(*rows):
        full = [(r[0], r[1], r[2] if len(r) > 2 else None, "s", len(r[1] or "")) for r in rows]
        return spark.createDataFrame(full, SCHEMA)

    return build


WORDS = "ba be bi bo bu da de di do du fa fe fi fo fu ga ge gi go gu ha he hi ho hu".split()


@pytest.fixture
def prose():
    """n words from a fixed sequence, a different one for each seed."""
    import random

    def build(n, seed=0):
        rng = random.Random(seed)
        return " ".join("".join(rng.choice(WORDS) for _ in range(rng.randint(1, 3))) for _ in range(n))

    return build
