"""Benchmark: ETL build + headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints ONE JSON line:
  {"metric": "total_query_sec", "value": N, "unit": "sec", "queries": {...}, "sf": ...}

Phase 1 runs the ETL job once (staging, dimensions with surrogate keys, fact
partitioned by year) into a fresh scratch folder, as a warehouse would; the
analytics, marts and verification queries then read the written star.
Profiling queries read the raw tables. Each query is timed to completion of
its (small) result.
"""

from __future__ import annotations

import json
import os
import re
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    m = re.search(r"sf([0-9.]+)", sf_dir)
    sf = float(m.group(1)) if m else None

    from starmart.session import local_session

    spark = local_session(cores=cpus, shuffle_partitions=max(8, 2 * int(cpus)), app="starmart-bench")
    from starmart.operators import quality as Q
    from starmart.plans import analytics as X
    from starmart.plans import etl as ETL
    from starmart.plans import marts as M
    from starmart.plans.registry_more import PROFILE_TABLES
    from starmart.plans.star import FIXTURE_PARAMS as P
    from starmart.sources import fixtures as FX

    times: dict[str, float] = {}

    def timed(name, fn):
        t = time.perf_counter()
        out = fn()
        if out is not None:
            out.collect()
        times[name] = round(time.perf_counter() - t, 3)

    base = tempfile.mkdtemp(prefix="starmart-bench-", dir=os.environ.get("BENCH_SCRATCH", "/tmp"))
    src = FX.sources(spark, sf_dir)
    paths: dict[str, str] = {}
    landed: dict = {}
    # the raw extract lands once (S1); the ETL proper starts from it
    timed("etl_land", lambda: landed.update(ETL.land_raw(src, base, "1")))
    timed("etl_build", lambda: paths.update(ETL.run_etl(spark, landed, P, base, "2", land=False)))
    star = {k: spark.read.parquet(paths[k]) for k in ("dim_date", "dim_seller", "dim_product", "dim_customer", "fact_sales")}

    queries = {
        "x1_monthly": lambda: X.x1_monthly_trend(star),
        "x2_yoy": lambda: X.x2_year_over_year(star, years=P.yoy_years),
        "x3_rfm": lambda: X.x3_rfm_segments(star, as_of=P.rfm_as_of),
        "x4_product_ranking": lambda: X.x4_product_ranking(star),
        "x5_seller_performance": lambda: X.x5_seller_performance(star),
        "x6_cohort_retention": lambda: X.x6_cohort_retention(star),
        "x7_delivery": lambda: X.x7_delivery_performance(star, buckets=P.delivery_buckets),
        "x8_pareto": lambda: X.x8_pareto(star),
        "x9_quarterly": lambda: X.x9_quarterly_kpis(star),
        "m1_kpis": lambda: M.m1_kpi_cards(star),
        "m3_top_categories": lambda: M.m3_top_categories(star),
        "m8_price_band_by_year": lambda: M.m8_price_band_by_year(star),
        "m4_payment_types": lambda: M.m4_payment_types(star),
        "m7_state_metrics": lambda: M.m7_state_metrics(star),
        "fact_rev_by_year": lambda: M.fact_revenue_by_year(star),
        "q_null_audit": lambda: Q.null_audit({k: src[k] for k in PROFILE_TABLES}),
        "q_describe": lambda: Q.describe_money(src["items"], "price"),
        "q_referential_integrity": lambda: Q.referential_integrity(
            [
                (f"{t}_without_{m}", src[t], f"{m}_id", src[f"{m}s"], f"{m}_id")
                for t, m in (("items", "order"), ("orders", "customer"), ("items", "product"), ("items", "seller"))
            ]
        ),
    }
    for name, fn in queries.items():
        timed(name, fn)

    total = round(sum(v for k, v in times.items() if not k.startswith("etl_")), 3)
    print(
        json.dumps(
            {
                "metric": "total_query_sec",
                "value": total,
                "unit": "sec",
                "queries": times,
                "sf": sf,
                "etl_build_sec": times["etl_build"],
                "etl_land_sec": times["etl_land"],
                "cpus": int(cpus),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
