import os

import pytest

import __spark_entry__ as entry
from check_oracle import compare, connect

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_entry(spark):
    rows = entry.entry(spark).collect()
    assert len(rows) == 14 and all(0 <= r["quality_score"] <= 100 for r in rows)


def test_every_statement_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query_equals_sql(spark, con, name):
    assert compare(spark, con, SF, name) is None
