"""Queries against their SQL twins."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(__file__), ".."))
from oracle_check import connect, difference  # noqa: E402

from corpusloom.llm.queries import QUERIES  # noqa: E402
from corpusloom.llm.sql import SQL  # noqa: E402


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, data, name):
    got = QUERIES[name](spark, data).toPandas()
    want = connect(data).execute(SQL[name]).df()
    # Columns with nulls differ in how pandas shows whole numbers.
    want = want.astype({c: got[c].dtype for c in want.columns if str(want[c].dtype) == "Int64"})
    assert difference(got, want) == ""
    assert len(got) > 0
