"""Every registered query against its SQL, on the smallest tables."""

from __future__ import annotations

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tools.compare import compare, duck
from workload import ALL

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(FOLDER)


@pytest.mark.parametrize("name", sorted(ALL))
def test_query_agrees_with_sql(spark, con, name):
    assert compare(spark, con, queries()[name], oracle_sql()[name], FOLDER) is None


def test_every_query_has_sql():
    assert set(ALL) <= set(queries())
    assert set(ALL) <= set(oracle_sql()) <= set(queries())


def test_entry(spark):
    report = entry(spark)
    assert report.columns == ["event_date", "daily_active_learners"]
    dates = [r[0] for r in report.collect()]
    assert dates == sorted(dates, reverse=True) and dates
