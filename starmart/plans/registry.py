"""Named queries over the fixture tables, for the driver contract and bench.

Each entry is ``fn(spark, sf_dir) -> DataFrame``. Outputs are normalised for
cross-engine comparison: integral -> BIGINT, decimal/float -> DOUBLE,
date/timestamp -> ISO string. The library functions themselves keep DECIMAL
money and DATE columns; only this presentation layer casts.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import analytics as X
from .star import FIXTURE_PARAMS as P
from .star import star_from_fixtures

Query = Callable[[SparkSession, str], DataFrame]


def normalize(df: DataFrame) -> DataFrame:
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        t = f.dataType
        if isinstance(t, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
            c = c.cast("bigint")
        elif isinstance(t, (T.FloatType, T.DoubleType, T.DecimalType)):
            c = c.cast("double")
        elif isinstance(t, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        elif isinstance(t, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        out.append(c.alias(f.name))
    return df.select(*out)


_REGISTRY: dict[str, Query] = {}


def register(name: str):
    def deco(fn: Query) -> Query:
        _REGISTRY[name] = lambda spark, sf_dir: normalize(fn(spark, sf_dir))
        return fn

    return deco


def all_queries() -> dict[str, Query]:
    from . import registry_more  # noqa: F401  (registers the remaining families)

    return dict(_REGISTRY)


def _star(spark: SparkSession, sf_dir: str) -> dict:
    return star_from_fixtures(spark, sf_dir, P)


# ------------------------------------------------------------ analytics X1-X9
@register("x1_monthly")
def _x1(spark, sf_dir):
    return X.x1_monthly_trend(_star(spark, sf_dir))


@register("x2_yoy")
def _x2(spark, sf_dir):
    return X.x2_year_over_year(_star(spark, sf_dir), years=P.yoy_years)


@register("x3_rfm")
def _x3(spark, sf_dir):
    return X.x3_rfm_segments(_star(spark, sf_dir), as_of=P.rfm_as_of)


@register("x3_rfm_customers")
def _x3c(spark, sf_dir):
    return X.x3_rfm_customers(_star(spark, sf_dir), as_of=P.rfm_as_of)


@register("x4_product_ranking")
def _x4(spark, sf_dir):
    return X.x4_product_ranking(_star(spark, sf_dir))


@register("x5_seller_performance")
def _x5(spark, sf_dir):
    return X.x5_seller_performance(_star(spark, sf_dir))


@register("x6_cohort_retention")
def _x6(spark, sf_dir):
    return X.x6_cohort_retention(_star(spark, sf_dir))


@register("x7_delivery")
def _x7(spark, sf_dir):
    return X.x7_delivery_performance(_star(spark, sf_dir), buckets=P.delivery_buckets)


@register("x8_pareto")
def _x8(spark, sf_dir):
    return X.x8_pareto(_star(spark, sf_dir))


@register("x9_quarterly")
def _x9(spark, sf_dir):
    return X.x9_quarterly_kpis(_star(spark, sf_dir))


@register("x3_rfm_high_is_best")
def _x3h(spark, sf_dir):
    return X.x3_rfm_segments(_star(spark, sf_dir), as_of=P.rfm_as_of, score_direction="high_is_best")


@register("x3_rfm_by_person")
def _x3u(spark, sf_dir):
    return X.x3_rfm_customers(_star(spark, sf_dir), as_of=P.rfm_as_of, customer_col="customer_unique_id")


@register("x6_cohort_retention_by_person")
def _x6u(spark, sf_dir):
    return X.x6_cohort_retention(_star(spark, sf_dir), customer_col="customer_unique_id")


@register("x8_pareto_by_person")
def _x8u(spark, sf_dir):
    return X.x8_pareto(_star(spark, sf_dir), customer_col="customer_unique_id")
