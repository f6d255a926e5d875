import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from campusweave.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    return local_session("tests", "4")


@pytest.fixture
def page(spark):
    """One-page DataFrame of a type."""

    def make(html, kind="info", college_id="1", slug="a"):
        return spark.createDataFrame(
            [(college_id, slug, kind, "u", html)], "college_id string, slug string, page_type string, url string, html string"
        )

    return make


def rows(df, *columns):
    """Collected rows as sorted tuples."""
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)
