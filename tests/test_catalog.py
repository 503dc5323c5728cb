"""Registry contract: entry() and every registered query run on sf0.001."""

import os

import pytest

import __spark_entry__ as E
from cardiolake.plans import catalog

SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")
def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns == ["subject_id", "day", "resting_hr", "hr_max", "trend", "p25", "p75"]


def test_every_query_has_an_oracle():
    q, o = catalog.QUERIES, catalog.ORACLE
    assert set(q) <= set(E.queries()) and set(o) <= set(E.oracle_sql())
    assert set(q) == set(o)


@pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")
def test_all_queries_run_small(spark):
    for name, fn in catalog.QUERIES.items():
        df = fn(spark, SF)
        assert df.count() >= 0, name
        assert len(df.columns) == len(set(df.columns)), name
