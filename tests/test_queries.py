"""Every query with a SQL counterpart gives the same result."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent / "tools"))

from check import compare, connect  # noqa: E402

from __spark_entry__ import entry, oracle_sql, queries  # noqa: E402

FOLDER = "/root/testdata/sf0.001"
SQL = oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


def test_entry(spark):
    assert entry(spark).count() > 0


def test_every_oracle_has_a_query():
    assert set(SQL) <= set(queries())


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, con, name):
    got = queries()[name](spark, FOLDER).toPandas()
    assert compare(got, con.execute(SQL[name]).df()) == []
