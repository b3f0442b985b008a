import pytest

import __spark_entry__ as entries
from tests.oracle import compare, connect

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_query_has_its_sql():
    optional = entries._optional()[0].keys()
    assert entries.queries().keys() - optional == entries.ORACLES.keys()
    assert entries.oracle_sql().keys() <= entries.queries().keys()


@pytest.mark.parametrize("name", sorted(entries.oracle_sql()))
def test_query_agrees_with_sql(spark, con, name):
    assert compare(spark, con, entries.queries()[name], entries.oracle_sql()[name], SF) == ""


def test_entry(spark):
    rows = entries.entry(spark)
    assert rows.columns[-1] == "tfidf"
    assert rows.count() == 54_737
