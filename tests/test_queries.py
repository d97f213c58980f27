"""Every query of the engine against its SQL on the smallest sample, whole results."""

from __future__ import annotations

import os

import pytest
from check_sql import compare, connect

import __spark_entry__ as entry
from tallyline.plans.sample_queries import QUERIES
from tallyline.plans.sample_sql import SQL
from tallyline.schemas import SLICE_UPDATE

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="sample tables are not here")


@pytest.fixture(scope="module")
def database():
    return connect(FOLDER)


def test_every_query_has_its_sql():
    assert QUERIES.keys() == SQL.keys()
    assert QUERIES.items() <= entry.queries().items() and SQL.items() <= entry.oracle_sql().items()


def test_entry(spark):
    result = entry.entry(spark)
    assert result.columns == SLICE_UPDATE.fieldNames() and result.count() > 0


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, database, name):
    assert compare(spark, database, name, QUERIES[name], SQL[name], FOLDER) is None
