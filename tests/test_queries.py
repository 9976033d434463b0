"""Every query against its SQL on the smallest tables."""

import os

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tests.compare import connect, difference, spark_result, sql_result

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_equals_sql(spark, con, name):
    got = spark_result(queries()[name](spark, FOLDER))
    assert difference(got, sql_result(con, oracle_sql()[name])) is None


@pytest.mark.parametrize("name", sorted(set(queries()) - set(oracle_sql())))
def test_query_without_sql_runs(spark, name):
    assert queries()[name](spark, FOLDER).count() > 0


def test_every_sql_has_its_query(spark):
    assert set(oracle_sql()) <= set(queries())
    assert entry(spark).count() > 0


def test_recall_of_the_query_is_high(spark):
    assert [r.reached for r in queries()["recall_at_k"](spark, FOLDER).collect()] == [True]
