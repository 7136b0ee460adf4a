"""Every registered query against its SQL on the small tables."""

import pytest

import __spark_entry__ as entry
from compare import compare, duck
from riskspark import plans

QUERIES, ORACLES = plans.QUERIES, plans.ORACLES


@pytest.fixture(scope="module")
def con(sf_dir):
    return duck(sf_dir)


def test_every_query_has_sql():
    assert set(ORACLES) == set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_agrees_with_sql(spark, con, sf_dir, name):
    problem = compare(spark, con, name, QUERIES[name], ORACLES[name], sf_dir)
    assert problem in (None, "no rows on both sides")


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.columns[:2] == ["party", "ref_date"] and df.count() > 0
