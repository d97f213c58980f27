"""The queries that SQL can express against their SQL, whole results."""

from __future__ import annotations

import os

import pytest
from check_sql import compare, connect

import __spark_entry__ as entry
from tallyline.llm.queries import QUERIES, SQL

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="sample tables are not here")


@pytest.mark.parametrize("name", SQL)
def test_query(spark, name):
    assert compare(spark, connect(FOLDER), name, QUERIES[name], SQL[name], FOLDER) is None


def test_all_are_registered():
    assert {*QUERIES, "pipeline"} <= entry.queries().keys() and SQL.keys() <= entry.oracle_sql().keys()
    assert [n.split("_")[0] for n in QUERIES] == [f"op{n}" for n in range(1, 14)]
