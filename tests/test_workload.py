"""Every query against its SQL twin, on the smallest data set."""

from __future__ import annotations

from pathlib import Path

import pytest

import __spark_entry__ as entry_points
from tools.check_queries import compare, views
from workload.queries import QUERIES, SQL

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="the given tables are not here")


@pytest.fixture(scope="module")
def con():
    return views(SF_DIR)


def test_twins_belong_to_queries():
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())
    assert set(QUERIES) == set(SQL)


def test_entry(spark):
    df = entry_points.entry(spark)
    assert df.columns == ["gss_out", "gss_in", "sex", "year", "age", "value"]
    assert df.count() > 0


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_sql(spark, con, name):
    outcome = compare(spark, con, SF_DIR, name)
    assert outcome.startswith(("same", "rows only")) and "TYPES" not in outcome, outcome
