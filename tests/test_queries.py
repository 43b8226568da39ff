"""Every registered query against its SQL twin, or at least to a non-empty result, on the smallest tables."""

import os

import pytest

import __spark_entry__ as entry
from tablework.workload.check import compare, duck

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="needs the generated tables")

SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_twin_has_a_query():
    assert set(SQL) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query(spark, con, name):
    df = entry.queries()[name](spark, SF)
    if name in SQL:
        assert compare(df, con, SQL[name]) is None
    else:
        assert df.count() > 0


def test_entry(spark):
    assert len(entry.entry(spark).columns) == 25
