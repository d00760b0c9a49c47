"""Command line: run the warehouse phases on a data folder.

    python -m starmart --data /root/testdata/sf0.01 --out /shared/wh --run 1 \
        [--phases profile,stage,dims,fact,analytics] [--fixture-params] [--run-date 2018-10-18]

Phases (each writes tables under ``--out``):
  profile    profiling summary row, orphan items (exception sink)
  stage      landed extract, staged tables, reject log for the run
  dims       dimension snapshots (calendar once, stable keys, SCD2 merge)
  fact       fact load: FULL first, INCREMENTAL afterwards, control log
  analytics  X1-X9, the marts and the verification tables, one table each
The run date (default: today) stamps the rows, starts and ends customer
versions and is the day after which a purchase counts as in the future.
The checkpoint folder comes from ``spark.checkpoint.dir`` (required on a
cluster).
"""

from __future__ import annotations

import argparse
import datetime as _dt
from dataclasses import replace

from pyspark.sql import SparkSession

from . import session as S
from .operators import facts as FA
from .operators import quality as Q
from .plans import analytics as X
from .plans import etl as ETL
from .plans import marts as M
from .plans.star import FIXTURE_PARAMS, Params, stage_all, star_from_tables
from .sources import fixtures as FX
from .sources import io as IO
from .sources import raw as RAW


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="starmart")
    ap.add_argument("--data", required=True, help="folder with the source tables (parquet, or CSV with --csv)")
    ap.add_argument("--out", required=True, help="shared output folder for the warehouse")
    ap.add_argument("--run", type=int, default=1, help="run number (snapshot version, log ids)")
    ap.add_argument("--phases", default="profile,stage,dims,fact,analytics")
    ap.add_argument("--fixture-params", action="store_true", help="use the fixture parameter overrides")
    ap.add_argument("--csv", action="store_true", help="the data folder holds the raw extract: seven CSV tables with headers (see sources/raw.py)")
    ap.add_argument("--full-reload", action="store_true", help="replace the fact instead of adding to it")
    ap.add_argument("--watermark-basis", default="data", choices=("data", "load_time"), help="load_time: orders of files that arrived since the last load")
    ap.add_argument("--run-date", help="date of the load, YYYY-MM-DD (default: today, or the fixture's own)")
    a = ap.parse_args(argv)

    spark = SparkSession.builder.appName("starmart").getOrCreate()
    S.configure(spark, cluster=not spark.sparkContext.master.startswith("local"))
    p: Params = FIXTURE_PARAMS if a.fixture_params else Params()
    if a.run_date or not a.fixture_params:
        day = _dt.date.fromisoformat(a.run_date) if a.run_date else _dt.date.today()
        p = replace(p, run_date=str(day), as_of_ts=f"{day} 00:00:00")
    out = a.out.rstrip("/")
    phases = set(a.phases.split(","))
    if a.csv:
        extract = RAW.read_extract(spark, a.data)
        src = extract.sources
        IO.write_rejects(extract.malformed, out, str(a.run), "reject_log_lines")
    else:
        src = FX.sources(spark, a.data)
    if a.watermark_basis == "load_time":
        src = dict(src, orders=IO.with_arrival(src["orders"]))

    if "profile" in phases:
        ETL.write_snapshot(Q.profile_summary(src, p.as_of_ts, p.as_of_ts), out, "profiling_summary", str(a.run), pointer=False)
        IO.write_exceptions(Q.orphan_rows(src["items"], "order_id", src["orders"], "order_id"), f"{out}/orphan_items/v={a.run}")

    stg = None
    if phases & {"stage", "dims", "fact"}:
        landed = ETL.land_raw(src, out, str(a.run))
        stg_all = stage_all(landed, p, materialize=True)
        names = ("stg_orders", "stg_items", "stg_customers", "stg_products", "stg_payments")
        paths = ETL.write_all({k: stg_all[k] for k in names}, out, str(a.run), pointer=False)
        IO.write_rejects(stg_all["stg_rejects"], out, str(a.run))
        IO.write_exceptions(stg_all["stg_null_price"], f"{out}/stg_null_price/v={a.run}")
        stg = {k: spark.read.parquet(v) for k, v in paths.items()}
        ETL.write_snapshot(Q.staging_summary({**stg_all, **stg}, p.as_of_ts), out, "staging_summary", str(a.run), pointer=False)
        src = landed

    dims = None
    if "dims" in phases or "fact" in phases:
        dims = ETL.load_dimensions(spark, src, stg, p, out, str(a.run), first_log_id=a.run * 100)

    if "fact" in phases:
        ETL.load_fact(spark, stg, dims, out, p.run_date, log_id=a.run * 100 + 99, full_reload=a.full_reload, watermark_basis=a.watermark_basis)

    if "analytics" in phases:
        star = star_from_tables(spark, out)
        reports = {
            "x1_monthly": X.x1_monthly_trend(star),
            "x2_yoy": X.x2_year_over_year(star, years=p.yoy_years),
            "x3_rfm": X.x3_rfm_segments(star, as_of=p.rfm_as_of),
            "x4_product_ranking": X.x4_product_ranking(star),
            "x5_seller_performance": X.x5_seller_performance(star),
            "x6_cohort_retention": X.x6_cohort_retention(star),
            "x7_delivery": X.x7_delivery_performance(star, buckets=p.delivery_buckets),
            "x8_pareto": X.x8_pareto(star),
            "x9_quarterly": X.x9_quarterly_kpis(star),
            "m1_kpis": M.m1_kpi_cards(star),
            "m2_monthly": M.m2_monthly(star),
            "m3_top_categories": M.m3_top_categories(star),
            "m4_payment_types": M.m4_payment_types(star),
            "m5_states": M.m5_states(star),
            "m5_cities": M.m5_cities(star),
            "m6_order_status": M.m6_order_status(star),
            "m7_state_metrics": M.m7_state_metrics(star),
            "m8_category_revenue": M.m8_category_revenue(star),
            "m8_price_band_by_year": M.m8_price_band_by_year(star),
            "dim_verify_counts": M.dim_verify_counts(star),
            "dim_price_bands": M.dim_price_bands(star),
            "fact_verify_totals": M.fact_totals(star),
            "fact_rev_by_year": M.fact_revenue_by_year(star),
            "fact_rev_by_status": M.fact_revenue_by_status(star),
            "fact_rev_by_payment": M.fact_revenue_by_payment(star),
            "fact_top_categories": M.fact_top_categories(star),
            "fact_key_audit": FA.fact_key_audit(star),
            "duplicate_members": FA.duplicate_members({
                "dim_product": (star["dim_product"], "product_id"), "dim_seller": (star["dim_seller"], "seller_id"),
                "dim_customer": (star["dim_customer"].where("is_current"), "customer_id"),
            }),
        }
        for name, df in reports.items():
            df.write.mode("overwrite").parquet(f"{out}/reports/{name}/v={a.run}")


if __name__ == "__main__":
    main()
