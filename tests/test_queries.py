"""Every registered query against its SQL on the smallest tables."""

import pytest

import __spark_entry__ as entry
from oracle import registry
from oracle.check import connect, difference

SF = "/root/testdata/sf0.001"
# the queries of the training-data operations are tested beside them
QUERIES = {name: query for name, query in entry.queries().items() if name in registry.QUERIES}
ORACLE = {name: text for name, text in entry.oracle_sql().items() if name in QUERIES}


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, duck, name):
    assert difference(QUERIES[name](spark, SF).toPandas(), duck.execute(ORACLE[name]).df()) is None


def test_entry(spark):
    assert entry.entry(spark).count() == 10
