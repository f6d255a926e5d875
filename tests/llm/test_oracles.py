"""Queries of the subpackage that SQL can express, against DuckDB on whole tables."""

import os

import pytest

from campusweave.llm import queries
from tools import check

SF = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")


@pytest.mark.parametrize("name", list(queries.ORACLES))
def test_query(spark, name):
    df = queries.QUERIES[name](spark, SF)
    got = check.canonical(df.columns, [tuple(r) for r in df.collect()])
    cursor = check.connect(SF).execute(queries.ORACLES[name])
    assert got == check.canonical([c[0] for c in cursor.description], cursor.fetchall())
