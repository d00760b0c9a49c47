"""Every registered query against its DuckDB oracle on the smallest fixture,
plus whole-pipeline properties (incremental == full, lookup failures)."""

import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from oracle_check import compare, duck

ORACLE_NAMES = sorted(set(E.queries()) & set(E.oracle_sql()))


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", ORACLE_NAMES)
def test_query_matches_oracle(spark, con, name):
    ok, msg = compare(spark, name, SF_SMALL, con)
    assert ok, msg


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "revenue" in df.columns


def test_queries_without_oracle_run(spark):
    for name in sorted(set(E.queries()) - set(E.oracle_sql())):
        assert E.queries()[name](spark, SF_SMALL).count() >= 0


def test_fixture_expected_sizes(spark):
    """Golden sizes measured independently when the fixtures were surveyed."""
    from pyspark.sql import functions as F

    from starmart.plans.star import FIXTURE_PARAMS as P
    from starmart.plans.star import stage_all
    from starmart.sources import fixtures as FX

    s = stage_all(FX.sources(spark, SF_SMALL), P)
    assert s["stg_rejects"].where(F.col("reject_reason") == "Delivery date before purchase date").count() == 291
    assert s["stg_items"].count() == 5051
    assert s["stg_items"].where("status_category = 'Completed'").count() == 1710
    assert s["stg_orders"].where("is_on_time = 1").count() == 602
