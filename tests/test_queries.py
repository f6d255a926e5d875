"""Every registered query against its SQL in DuckDB."""

import os

import pytest

import __spark_entry__ as driver
from campusweave import catalog
from tools import check

SF = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")


@pytest.fixture(scope="module")
def con():
    return check.connect(SF)


@pytest.mark.parametrize("name", list(catalog.QUERIES))
def test_query(spark, con, name):
    ok, message = check.compare(spark, con, name, SF)
    assert ok is not False, message


def test_contract(spark):
    assert set(driver.oracle_sql()) <= set(driver.queries())
    assert driver.entry(spark).count() > 0
