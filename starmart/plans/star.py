"""The star schema as one lazy plan: sources -> staging -> dimensions -> fact.

``build_star`` only composes DataFrames; nothing runs until an action. The
ETL job in ``plans/etl.py`` writes each layer as a table; analytics can run
either on the lazy plan or on the written tables.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from ..functions import expr as E
from ..operators import dims as D
from ..operators import facts as FA
from ..operators import staging as S
from ..operators.routing import union_rejects
from ..session import stored
from ..sources import fixtures as FX


# what the year-month cube groups lines by
PRODUCT_ATTRIBUTES = ("product_category", "price_band")


@dataclass(frozen=True)
class Params:
    """Run parameters; the defaults are the source system's values."""

    date_start: str = "2016-01-01"
    date_end: str = "2019-12-31"
    price_band_edges: tuple = E.PRICE_BAND_EDGES
    weight_band_edges: tuple = E.WEIGHT_BAND_EDGES
    delivery_buckets: tuple = (5, 10, 20)
    yoy_years: tuple = (2016, 2017, 2018)
    rfm_as_of: str = "2018-10-17"
    run_date: str = "2002-01-01"
    as_of_ts: str = "2002-01-01 00:00:00"
    extra: dict = field(default_factory=dict)


FIXTURE_PARAMS = Params(
    date_start=FX.FIXTURE_PARAMS["date_start"],
    date_end=FX.FIXTURE_PARAMS["date_end"],
    price_band_edges=FX.FIXTURE_PARAMS["price_band_edges"],
    weight_band_edges=FX.FIXTURE_PARAMS["weight_band_edges"],
    delivery_buckets=FX.FIXTURE_PARAMS["delivery_buckets"],
    yoy_years=FX.FIXTURE_PARAMS["yoy_years"],
    rfm_as_of=FX.FIXTURE_PARAMS["rfm_as_of"],
    run_date=FX.FIXTURE_PARAMS["run_date"],
    as_of_ts=FX.FIXTURE_PARAMS["as_of_ts"],
)


def stage_all(src: dict[str, DataFrame], p: Params, materialize: bool = False) -> dict[str, DataFrame]:
    so = S.stage_orders(src["orders"])
    si = S.stage_items(src["items"], so.kept, materialize=materialize)
    return {
        "stg_orders": so.kept,
        "stg_items": si.kept,
        "stg_customers": S.stage_customers(src["customers"], p.run_date),
        "stg_products": S.stage_products(
            src["products"], src["category_translation"], src["items"], p.price_band_edges, p.weight_band_edges
        ),
        "stg_payments": S.stage_payments(src["payments"]),
        "stg_rejects": union_rejects([so.rejects, si.rejects]),
        "stg_null_price": si.null_price,
    }


def build_dims(spark: SparkSession, src: dict[str, DataFrame], stg: dict[str, DataFrame], p: Params) -> dict[str, DataFrame]:
    """The four dimensions. Key assignment runs small materialising jobs
    (range sample, chunk checkpoint); the three keyed dimensions are
    independent, so they are built as concurrent Spark jobs. They are stored, so that every
    lookup knows their size: a small one is broadcast before any line is shuffled to it."""
    from concurrent.futures import ThreadPoolExecutor

    builders = {
        "dim_seller": lambda: stored(D.build_dim_seller(src["sellers"], p.run_date)),
        "dim_product": lambda: stored(D.build_dim_product(stg["stg_products"], p.run_date)),
        "dim_customer": lambda: stored(D.scd2_merge(D.empty_dim_customer(spark), stg["stg_customers"], p.run_date).dim),
    }
    with ThreadPoolExecutor(max_workers=len(builders)) as ex:
        futs = {k: ex.submit(fn) for k, fn in builders.items()}
        out = {k: f.result() for k, f in futs.items()}
    return {"dim_date": D.build_dim_date(spark, p.date_start, p.date_end), **out}


def fact_of_extract(
    src: dict[str, DataFrame], stg: dict[str, DataFrame], dims: dict[str, DataFrame], p: Params, orders: DataFrame | None = None
) -> FA.FactBuild:
    """The fact of a lazily staged extract (of ``orders``, by default all staged ones). Lines get their product and seller keys
    before they are staged, so staging and assembly share one shuffle of the lines by order. The products' attributes of the
    cube come along (a reader that does not take them prunes them)."""
    carry = [c for c in PRODUCT_ATTRIBUTES if c in dims["dim_product"].columns]
    lines = S.stage_items(FA.with_line_keys(src["items"], dims["dim_product"], dims["dim_seller"], carry), stg["stg_orders"]).kept
    return FA.build_fact(
        lines, stg["stg_orders"] if orders is None else orders, stg["stg_payments"], dims["dim_customer"], dims["dim_product"],
        dims["dim_seller"], p.run_date, keyed=True, carry=carry,
    )


def build_star(spark: SparkSession, src: dict[str, DataFrame], p: Params, watermark=None) -> dict[str, DataFrame]:
    stg = stage_all(src, p)
    dims = build_dims(spark, src, stg, p)
    fb = fact_of_extract(src, stg, dims, p, FA.incremental_orders(stg["stg_orders"], watermark))
    return {**stg, **dims, "fact_sales": fb.fact, "fact_failures": fb.failures, "fact_assembled": fb.assembled, "fact_products": fb.carried}


def star_from_fixtures(spark: SparkSession, sf_dir: str, p: Params = FIXTURE_PARAMS) -> dict[str, DataFrame]:
    return build_star(spark, FX.sources(spark, sf_dir), p)


def star_from_tables(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """Read the star written by the load jobs, as of the latest commit."""
    from .warehouse import Warehouse

    wh = Warehouse(spark, path)
    snap = wh.snapshot()  # one snapshot for all five tables
    return {n: wh.read(n, snap) for n in ("dim_date", "dim_seller", "dim_product", "dim_customer", "fact_sales")}
