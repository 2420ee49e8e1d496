"""Every registered query next to its SQL on the smallest tables; rows only where none is given."""

import pytest
from compare import differences, oracle_connection

from zonecast.plans.catalog import CATALOG

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return oracle_connection(SF_DIR)


# At this size every day fails validation and no zone has 30 forecasts in 90 days.
MAY_BE_EMPTY = {"parsed_records", "conformal_margins", "live_margins"}


@pytest.mark.parametrize("name", [n for n, (_, sql) in CATALOG.items() if sql is not None])
def test_query_equals_its_sql(spark, con, name):
    query, sql = CATALOG[name]
    problems = differences(query(spark, SF_DIR), con, sql)
    if name in MAY_BE_EMPTY:
        problems = [p for p in problems if p != "no rows"]
    assert problems == []


@pytest.mark.parametrize("name", ["battery_arbitrage", "battery_summary", "feature_importance"])
def test_query_without_sql_has_rows(spark, name):
    query, _ = CATALOG[name]
    assert query(spark, SF_DIR).count() > 0


def test_entry_and_contract(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
