import pytest

import __spark_entry__ as entry
from corpusloom.plans.oracles import SQL
from corpusloom.plans.registry import QUERIES
from oracle_check import connect, difference


@pytest.fixture(scope="module")
def db(data):
    return connect(data)


def test_entry(spark):
    assert entry.entry(spark).count() == 1


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, data, db, name):
    got = QUERIES[name](spark, data).toPandas()
    assert list(got.columns) == list(dict.fromkeys(got.columns))
    if name in SQL:
        assert difference(got, db.execute(SQL[name]).fetchdf()) == ""
