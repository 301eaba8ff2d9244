"""All queries against their SQL; ``compare.py`` does it on other data."""

from __future__ import annotations

import pytest
from compare import connect, differences

from kolumna.queries import catalog

SF_DIR = "/root/testdata/sf0.001"
QUERIES = sorted(catalog.SQL)


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, duck, name):
    assert differences(catalog.QUERIES[name](spark, SF_DIR), duck, catalog.SQL[name]) == ""
