"""Every registered query against its check SQL."""

import os

import pytest

import check
import __spark_entry__ as entry

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
ORACLES = entry.oracle_sql()
QUERIES = entry.queries()


@pytest.fixture(scope="module")
def con():
    return check.duck(SF_DIR)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    df = QUERIES[name](spark, SF_DIR)
    if name in ORACLES:
        assert check.compare(df, con, ORACLES[name]) is None
    else:
        assert df.count() > 0


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_every_sql_has_a_query():
    assert set(ORACLES) <= set(QUERIES)
