"""Every named query against its checking SQL on the smallest tables."""

from __future__ import annotations

import pytest

from rillmart.fixtures.oracle import ORACLES
from rillmart.fixtures.queries import QUERIES
from tests.checking import compare, connect

# the streams run through tests/run_checks.py and, small, through test_streaming.py
BATCH = [name for name in QUERIES if not name.startswith("stream_")]


@pytest.fixture(scope="module")
def tables(small):
    return connect(small)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", BATCH)
def test_query_matches_sql(spark, small, tables, name):
    assert compare(QUERIES[name](spark, small), tables, ORACLES[name]) == []
