"""S1: the raw extract as seven CSV tables with header lines.

Columns are found by name: a file may hold them in any order and others beside them; a
missing one ends the read with its name. Everything is read as text, so that one bad number is a NULL
(P21) and one bad timestamp is left to staging; a line with too few or too many fields is kept
whole for the reject log. Customers and payments carry ``row_order`` / ``payment_seq``, the line's place in
the extract by Spark's file metadata (file, block, line in the block), which "keep first" and "first seen" need.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .io import CORRUPT

# The columns of the source system's extract that the warehouse uses, by table.
RAW = {
    "orders": (
        "order_id string, customer_id string, order_status string, order_purchase_timestamp string, order_approved_at string, "
        "order_delivered_carrier_date string, order_delivered_customer_date string, order_estimated_delivery_date string"
    ),
    "items": "order_id string, order_item_id int, product_id string, seller_id string, shipping_limit_date string, price decimal(12,2), freight_value decimal(12,2)",
    "payments": "order_id string, payment_type string, payment_installments int, payment_value decimal(12,2)",
    "customers": "customer_id string, customer_unique_id string, customer_city string, customer_state string, customer_zip_code_prefix string",
    "products": "product_id string, product_category_name string, product_weight_g string, product_length_cm string, product_height_cm string, product_width_cm string",
    "sellers": "seller_id string, seller_city string, seller_state string, seller_zip_code_prefix string",
    "category_translation": "product_category_name string, product_category_name_english string",
}
ORDERED = {"customers": "row_order", "payments": "payment_seq"}


@dataclass
class RawExtract:
    sources: dict[str, DataFrame]
    malformed: DataFrame  # table_name, file, record, reject_reason


class MissingColumns(ValueError):
    pass


def columns_of(ddl: str) -> dict[str, str]:
    """Name -> type of a DDL string."""
    from pyspark.sql.types import StructType

    return {f.name: f.dataType.simpleString() for f in StructType.fromDDL(ddl).fields}


def read_table(spark: SparkSession, path: str, ddl: str, order: str | None = None, **options) -> tuple[DataFrame, DataFrame]:
    """(rows, malformed lines) of a CSV file or a folder of them."""
    options = {"header": True, "escape": '"', **options}
    header = spark.read.options(inferSchema=False, **options).csv(path).columns  # reads one line
    wanted = columns_of(ddl)
    lacking = [c for c in wanted if c not in header]
    if lacking:
        raise MissingColumns(f"{path} lacks the columns {', '.join(lacking)}")
    schema = ", ".join(f"`{c}` string" for c in header) + f", {CORRUPT} string"
    # each file's own header is held against the first; whole lines are parsed, or a line's fault would depend on the columns asked for
    lines = spark.read.schema(schema).options(mode="PERMISSIVE", columnNameOfCorruptRecord=CORRUPT, enforceSchema=False, columnPruning=False, **options).csv(path)
    place = F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("line"))
    lines = lines.withColumn("_place", place)
    # Spark parses nothing but the fault column for queries that need no other one, and refuses those: name a second column
    fault = F.coalesce(F.col(CORRUPT), F.when(F.length(F.col(f"`{header[0]}`")) < 0, F.lit("")))
    good = fault.isNull()
    rows = lines.where(good).select(*[F.col(f"`{c}`").try_cast(t).alias(c) for c, t in wanted.items()], *([F.col("_place").alias(order)] if order else []))
    bad = lines.where(~good).select(F.col("_place.file").alias("file"), fault.alias("record"))
    return rows, bad


def read_extract(spark: SparkSession, folder: str, files: dict[str, str] | None = None, **options) -> RawExtract:
    """The seven tables of ``folder``: ``<table>.csv`` each, or as ``files`` names them."""
    sources, malformed = {}, None
    for table, ddl in RAW.items():
        rows, bad = read_table(spark, f"{folder.rstrip('/')}/{(files or {}).get(table, table + '.csv')}", ddl, ORDERED.get(table), **options)
        sources[table] = rows
        bad = bad.select(F.lit(table).alias("table_name"), "file", "record", F.lit("Malformed line").alias("reject_reason"))
        malformed = bad if malformed is None else malformed.unionByName(bad)
    return RawExtract(sources, malformed)
