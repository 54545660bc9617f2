"""Every query gives the same columns, rows and values as its SQL twin."""

import pytest

import __spark_entry__ as entry
import check

from parcelflow.plans import QUERIES, SQL

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return check.connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    ok, note = check.compare(spark, con, name, SF_DIR)
    assert ok, note


def test_every_query_has_a_twin():
    assert set(SQL) == set(QUERIES)


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert "term_length_months" in df.columns
    assert df.count() > 0
