"""Every query against its SQL counterpart, on the smallest tables."""

import pytest

import __spark_entry__ as entry_module
from checks.compare import both_sides, database

SF_DIR = "/root/testdata/sf0.001"
QUERIES, ORACLE = entry_module.queries(), entry_module.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return database(SF_DIR)


def test_entry(spark):
    df = entry_module.entry(spark)
    assert df.columns[:4] == ["recipe_id", "raw_mean_rating", "review_count", "bayesian_rating"]
    assert df.count() > 0


def test_every_oracle_has_a_query():
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, con, name):
    df = QUERIES[name](spark, SF_DIR)
    if name not in ORACLE:
        assert df.count() > 0
        return
    ours, theirs, problems = both_sides(df, con, ORACLE[name])
    assert not problems
    assert ours == theirs
