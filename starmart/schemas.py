"""Warehouse table schemas (S11) and the raw-extract schemas (S1), as DDL strings
(accepted by ``createDataFrame`` and ``DataFrameReader.schema``)."""

from __future__ import annotations

from pyspark.sql import SparkSession

DIM_DATE = (
    "date_key int, full_date date, year int, quarter int, quarter_name string, month_num int, month_name string, "
    "month_short string, week_of_year int, day_of_month int, day_of_week int, day_name string, is_weekend boolean, "
    "is_month_start boolean, is_month_end boolean, year_month string"
)
DIM_CUSTOMER = (
    "customer_key long, customer_id long, customer_unique_id string, customer_city string, customer_state string, "
    "customer_zip_prefix string, effective_start_date date, effective_end_date date, is_current boolean, "
    "record_version int, etl_load_date date"
)
DIM_PRODUCT = (
    "product_key long, product_id long, product_category string, price_band string, weight_category string, "
    "product_weight_g decimal(10,2), product_length_cm decimal(10,2), product_height_cm decimal(10,2), "
    "product_width_cm decimal(10,2), etl_load_date date"
)
DIM_SELLER = (
    "seller_key long, seller_id long, seller_city string, seller_state string, seller_zip_prefix string, etl_load_date date"
)
FACT_SALES = (
    "date_key int, customer_key long, product_key long, seller_key long, order_id long, order_item_seq int, "
    "unit_price decimal(12,2), freight_value decimal(12,2), gross_revenue decimal(12,2), total_cost decimal(13,2), "
    "delivery_days int, delivery_delay_days int, is_on_time int, primary_payment_type string, "
    "payment_installments int, total_payment_value decimal(14,2), order_status string, status_category string, "
    "etl_load_date date"
)
ETL_CONTROL_LOG = (
    "log_id long, target_table string, run_start_ts timestamp_ntz, run_end_ts timestamp_ntz, records_loaded long, "
    "records_rejected long, last_loaded_ts timestamp_ntz, status string, error_message string, run_by string"
)

WAREHOUSE = {
    "dim_date": DIM_DATE,
    "dim_customer": DIM_CUSTOMER,
    "dim_product": DIM_PRODUCT,
    "dim_seller": DIM_SELLER,
    "fact_sales": FACT_SALES,
    "etl_control_log": ETL_CONTROL_LOG,
}

# Raw extract as text (CSV): timestamps stay strings so that the staging
# coercion (try_to_timestamp) decides what is unparseable.
RAW_ORDERS_CSV = (
    "order_id string, customer_id string, order_status string, order_purchase_timestamp string, "
    "order_approved_at string, order_delivered_carrier_date string, order_delivered_customer_date string, "
    "order_estimated_delivery_date string"
)
RAW_ITEMS_CSV = (
    "order_id string, order_item_id int, product_id string, seller_id string, shipping_limit_date string, "
    "price decimal(10,2), freight_value decimal(10,2)"
)


def create_warehouse(spark: SparkSession, base: str) -> dict[str, str]:
    """Create the empty star schema as parquet tables under ``base``."""
    out = {}
    for name, schema in WAREHOUSE.items():
        path = f"{base.rstrip('/')}/{name}"
        spark.createDataFrame([], schema).write.mode("ignore").parquet(path)
        out[name] = path
    return out
