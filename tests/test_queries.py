"""Every query against its SQL, and the driver contract."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as driver
from compare import connect, differences
from tidemark.queries import QUERIES, SQL

SF_DIR = os.environ.get("QUERY_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def db():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, db, name):
    assert differences(spark, db, SF_DIR, name) == []


def test_every_query_has_sql():
    assert set(SQL) == set(QUERIES)
    assert set(driver.oracle_sql()) <= set(driver.queries())


def test_entry(spark):
    assert driver.entry(spark).count() > 0
