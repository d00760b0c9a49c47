"""Year-month cube: slices are merges, a refresh rewrites the touched months alone."""

import tempfile

import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F
from starmart.plans import cube as CU
from starmart.plans import marts as M
from starmart.plans.star import FIXTURE_PARAMS as P
from starmart.plans.star import star_from_fixtures
from starmart.plans.warehouse import Warehouse


@pytest.fixture(scope="module")
def base(spark):
    star = star_from_fixtures(spark, SF_SMALL, P)
    path = tempfile.mkdtemp(prefix="starmart-cube-")
    with Warehouse(spark, path).begin(1, "star") as tx:
        for n in ("dim_customer_current", "dim_product", "dim_date"):
            tx.append(n, star[n.removesuffix("_current")])
        fact = star["fact_sales"].withColumn("fact_year", F.expr("date_key div 10000").cast("int"))
        tx.append("fact_sales", fact, ["fact_year"])
    CU.refresh(spark, path, 2)
    return path


def _rows(df):
    return sorted(map(str, df.select(*sorted(df.columns)).collect()))


def test_slices_equal_the_marts(spark, base):
    wh, cube = Warehouse(spark, base), CU.read(spark, base)
    star = {n: wh.read(n) for n in ("fact_sales", "dim_customer", "dim_product", "dim_date")}
    for when in ({}, {"year": 1997}, {"year": 1997, "month": 5}):
        for mart in ("m1_kpi_cards", "m2_monthly", "m7_state_metrics", "m3_top_categories"):
            assert _rows(getattr(CU, mart)(cube, **when)) == _rows(getattr(M, mart)(star, **when)), (mart, when)


def test_a_slice_reads_its_months_of_the_cube_only(spark, base):
    plan = CU.m1_kpi_cards(CU.read(spark, base), year=1997, month=5)._jdf.queryExecution().toString()
    assert "fact_sales" not in plan
    assert "month" in plan and "199705" in plan


def test_refresh_keeps_other_months(spark, base):
    wh = Warehouse(spark, base)
    before, whole = wh.snapshot(), _rows(CU.m1_kpi_cards(CU.read(spark, base), every=True))
    CU.refresh(spark, base, 3, months=[199705])
    after = wh.snapshot()
    for t in CU.TABLES:
        gone = {p for f, p in before.folders[t].items() if f not in after.folders[t]}
        assert gone == {"199705"}
    assert _rows(CU.m1_kpi_cards(CU.read(spark, base), every=True)) == whole


def test_no_rows(spark, base):
    """A slice without orders gives the marts' empty result."""
    cube = CU.read(spark, base)
    row = CU.m1_kpi_cards(cube, year=1950).collect()
    assert [(r["total_revenue"], r["total_orders"], r["total_customers"]) for r in row] == [(None, 0, 0)]
    assert CU.m7_state_metrics(cube, year=1950).count() == 0
