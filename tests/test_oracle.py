"""Every query that has SQL gives the rows of that SQL, column types included."""

import pytest

import __spark_entry__ as entry
from oracle import connect, differences

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_matches_sql(spark, con, name):
    assert differences(spark, con, SF, entry.queries()[name], entry.oracle_sql()[name]) == []


def test_every_sql_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.columns == ["EXT_SOURCE_MEAN_BIN", "n", "default_rate", "mean_debt_credit_ratio"]
    assert df.count() > 0
