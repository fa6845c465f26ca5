from collections import Counter

import pytest
from pyspark.sql import functions as F

from tests.llm import brute

CLASH = ["tokens", "h", "idx", "template", "domain", "tokens_", "pack_id", "line", "keep", "node", "root", "key", "lang_", "source_", "f0", "ts", "__id", "__mark", "__place", "__c0", "__c1", "__key", "__epoch", "__shard", "__rank", "__n", "n", "x"]


@pytest.fixture(scope="session")
def awkward(spark):
    return spark.createDataFrame(brute.awkward(), brute.SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], brute.SCHEMA)


@pytest.fixture(scope="session")
def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (2, 1, 0), (12, 1, 0), (13, 1, 0), (6, 0, 0), (7, 0, 0), (None, 0, 0), (7, None, None)], "doc_id long, quality int, toxic int")


@pytest.fixture(scope="session")
def clash():
    """Adds columns that operators might use themselves."""
    return lambda df: df.withColumns({c: F.concat(F.lit(f"{c} of "), F.coalesce(F.col(df.columns[0]).cast("string"), F.lit("null"))) for c in CLASH})


@pytest.fixture(scope="session")
def whole():
    """Whether every row of a result still has the values of the row it comes from."""

    def check(got, docs):
        assert got.columns == docs.columns
        left = Counter(map(repr, docs.collect()))
        assert all(repr(r) in left for r in got.collect())

    return check


@pytest.fixture(scope="session")
def rows():
    return lambda df: sorted(map(tuple, df.collect()), key=repr)
