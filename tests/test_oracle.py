"""Every registered query against its SQL on the smallest data set."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as entry
from tests.conftest import DATA
from tools.check import compare, connection

SLOW = {"gbt_backtest"}
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="needs the given tables")


@pytest.fixture(scope="module")
def con():
    return connection(DATA)


@pytest.mark.parametrize("name", sorted(set(entry.queries()) - SLOW))
def test_query(spark, con, name):
    got = entry.queries()[name](spark, DATA).toPandas()
    assert len(got) > 0
    sql = entry.oracle_sql().get(name)
    if sql is not None:
        assert compare(got, con.sql(sql).df()) == ""


def test_oracles_belong_to_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_is_the_feature_store(spark):
    assert entry.entry(spark).columns[:3] == ["user_id", "date", "duration_min"]
