"""Every registered query against its SQL, on the smallest tables."""

import pytest

import __spark_entry__ as entry
from oracle_check import compare, oracle

SF = "/root/testdata/sf0.001"
SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return oracle(SF)


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query(spark, con, name):
    df = entry.queries()[name](spark, SF)
    if name not in SQL:
        assert df.count() > 0
        return
    problem = compare(df, con, SQL[name])
    assert problem is None, problem


def test_every_sql_has_a_query():
    assert set(SQL) <= set(entry.queries())


def test_entry(spark):
    rows = entry.entry(spark).collect()
    assert 0 < len(rows) <= 20 and rows == sorted(rows, key=lambda r: (-r.value, r.id))
