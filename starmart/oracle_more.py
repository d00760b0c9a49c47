"""Oracle SQL beyond X1-X9 (profiling, staging, dimensions, fact, marts)."""

from __future__ import annotations

from .oracle import _ORACLES, _cents, _floor_days, _rha, B, D, P, with_base

SRC_COLS = {
    "orders": ["order_id", "customer_id", "order_status", "order_purchase_timestamp", "order_approved_at",
               "order_delivered_carrier_date", "order_delivered_customer_date", "order_estimated_delivery_date"],
    "items": ["order_id", "order_item_id", "product_id", "seller_id", "shipping_limit_date", "price", "freight_value"],
    "payments": ["order_id", "payment_type", "payment_installments", "payment_value"],
    "customers": ["customer_id", "customer_unique_id", "customer_city", "customer_state", "customer_zip_code_prefix"],
    "products": ["product_id", "product_category_name", "product_weight_g"],
    "sellers": ["seller_id", "seller_city", "seller_state", "seller_zip_code_prefix"],
}
# Column counts of the Spark source frames (payments carries one struct
# sequence column; products carries three always-NULL dimension columns).
SRC_NCOLS = {"orders": 8, "items": 7, "payments": 5, "customers": 5, "products": 6, "sellers": 4, "category_translation": 2}
SRC_VIEW = {"orders": "src_orders", "items": "src_items", "payments": "src_payments", "customers": "src_customers",
            "products": "src_products", "sellers": "src_sellers", "category_translation": "src_cat"}


def oracle(name):
    def deco(fn):
        _ORACLES[name] = fn
        return fn
    return deco


@oracle("q_shape")
def _q_shape():
    parts = [f"SELECT '{t}' AS table_name, CAST(count(*) AS BIGINT) AS row_count, CAST({n} AS BIGINT) AS column_count FROM {SRC_VIEW[t]}"
             for t, n in SRC_NCOLS.items()]
    return with_base("q AS (" + " UNION ALL ".join(parts) + ") SELECT * FROM q")


@oracle("q_null_audit")
def _q_null():
    parts = []
    for t, cols in SRC_COLS.items():
        for c in cols:
            parts.append(f"SELECT '{t}' AS table_name, '{c}' AS column_name, count(*) - count({c}) AS n, count(*) AS total FROM {SRC_VIEW[t]}")
    # products also carries three always-NULL measure columns
    for c in ("product_length_cm", "product_height_cm", "product_width_cm"):
        parts.append(f"SELECT 'products', '{c}', count(*), count(*) FROM src_products")
    body = " UNION ALL ".join(parts)
    return with_base(f"a AS ({body}) SELECT table_name, column_name, CAST(n AS BIGINT) AS null_count, {_rha('n * 100', 'total', 2)} AS null_pct FROM a WHERE n > 0")


@oracle("q_duplicate_keys")
def _q_dupes():
    parts = [f"SELECT '{t}' AS table_name, '{k}' AS key_columns, CAST(count(*) - count(DISTINCT {k}) - (CASE WHEN count(*) > count({k}) THEN 1 ELSE 0 END) AS BIGINT) AS duplicate_rows FROM {SRC_VIEW[t]}"
             for t, k in (("orders", "order_id"), ("customers", "customer_id"), ("products", "product_id"), ("sellers", "seller_id"))]
    return with_base("q AS (" + " UNION ALL ".join(parts) + ") SELECT * FROM q")


@oracle("q_referential_integrity")
def _q_ri():
    checks = (("items_without_order", "src_items", "order_id", "src_orders", "order_id"),
              ("orders_without_customer", "src_orders", "customer_id", "src_customers", "customer_id"),
              ("items_without_product", "src_items", "product_id", "src_products", "product_id"),
              ("items_without_seller", "src_items", "seller_id", "src_sellers", "seller_id"))
    parts = [f"SELECT '{n}' AS check_name, CAST(count(*) AS BIGINT) AS orphan_rows FROM {c} x WHERE NOT EXISTS (SELECT 1 FROM {p} y WHERE y.{pk} = x.{ck})"
             for n, c, ck, p, pk in checks]
    return with_base("q AS (" + " UNION ALL ".join(parts) + ") SELECT * FROM q")


def _date_logic_select():
    return f"""SELECT
  CAST(count(*) FILTER (WHERE order_delivered_customer_date IS NOT NULL AND order_delivered_customer_date < order_purchase_timestamp) AS BIGINT) AS invalid_delivery_dates,
  CAST(count(*) FILTER (WHERE order_purchase_timestamp > TIMESTAMP '{P.as_of_ts}') AS BIGINT) AS future_orders,
  CAST(count(*) FILTER (WHERE order_purchase_timestamp IS NULL) AS BIGINT) AS unparseable_purchase_dates,
  CAST(count(*) FILTER (WHERE order_approved_at IS NOT NULL AND order_approved_at < order_purchase_timestamp) AS BIGINT) AS approval_before_purchase
FROM src_orders"""


@oracle("q_date_logic")
def _q_dates():
    return with_base(f"q AS ({_date_logic_select()}) SELECT * FROM q")


@oracle("q_value_distribution")
def _q_values():
    parts = []
    for t, c in (("orders", "order_status"), ("payments", "payment_type")):
        v = SRC_VIEW[t]
        parts.append(f"""SELECT '{t}' AS table_name, '{c}' AS column_name, CAST({c} AS VARCHAR) AS value, CAST(count(*) AS BIGINT) AS value_count,
            {_rha('count(*) * 100', f'(SELECT count(*) FROM {v})', 2)} AS value_pct
            FROM {v} WHERE {c} IS NOT NULL GROUP BY {c}""")
    return with_base("q AS (" + " UNION ALL ".join(parts) + ") SELECT * FROM q")


@oracle("q_describe")
def _q_describe():
    quarts = []
    for q in (1, 2, 3):
        lo = f"(CAST(floor((n - 1) * {q} / 4) AS BIGINT) + 1)"
        m = f"(((n - 1) * {q}) % 4)"
        l_ = f"max(CASE WHEN rn = {lo} THEN c END)"
        h_ = f"coalesce(max(CASE WHEN rn = {lo} + 1 THEN c END), {l_})"
        quarts.append(f"{_rha(f'{l_} * 4 + max({m}) * ({h_} - {l_})', '400', 2)} AS p{25 * q}")
    return with_base(f"""
x AS (SELECT {_cents('price')} AS c FROM src_items WHERE price IS NOT NULL),
r AS (SELECT c, row_number() OVER (ORDER BY c) AS rn, count(*) OVER () AS n FROM x),
a AS (SELECT count(*) AS cnt, sum(c) AS s1, sum(c * c) AS s2, min(c) AS mn, max(c) AS mx FROM x)
SELECT 'price' AS column_name, CAST((SELECT cnt FROM a) AS BIGINT) AS count,
       (SELECT {_rha('s1', 'cnt * 100', 2)} FROM a) AS mean,
       (SELECT CASE WHEN cnt > 1 THEN floor(sqrt(CAST(cnt * s2 - s1 * s1 AS DOUBLE) / CAST(cnt * (cnt - 1) AS DOUBLE)) + 0.5) / 100.0 END FROM a) AS std,
       (SELECT CAST(mn AS DOUBLE) / 100.0 FROM a) AS min,
       {', '.join(quarts)},
       (SELECT CAST(mx AS DOUBLE) / 100.0 FROM a) AS max
FROM r
""")


def _stats_cte():
    return "st AS (SELECT avg(CAST(price AS DOUBLE)) AS mean, stddev_samp(CAST(price AS DOUBLE)) AS sd FROM src_items)"


@oracle("q_price_checks")
def _q_price():
    return with_base(f"""{_stats_cte()}
SELECT CAST(count(*) FILTER (WHERE price <= 0) AS BIGINT) AS zero_or_negative_price,
       CAST(count(*) FILTER (WHERE freight_value = 0) AS BIGINT) AS zero_freight,
       CAST(count(*) FILTER (WHERE CAST(price AS DOUBLE) > st.mean + 3.0 * st.sd) AS BIGINT) AS price_outliers,
       CAST(max(price) AS DOUBLE) AS max_price,
       {_rha(_cents('sum(price)'), 'count(price) * 100', 2)} AS avg_price
FROM src_items, st""")


@oracle("q_outliers")
def _q_outliers():
    return with_base(f"""{_stats_cte()}
SELECT CAST(order_id AS BIGINT) AS order_id, CAST(order_item_id AS BIGINT) AS order_item_id, CAST(product_id AS BIGINT) AS product_id, CAST(price AS DOUBLE) AS price
FROM src_items, st WHERE CAST(price AS DOUBLE) > st.mean + 3.0 * st.sd""")


@oracle("q_date_range")
def _q_range():
    return with_base(f"""
a AS (SELECT min(order_purchase_timestamp) AS e, max(order_purchase_timestamp) AS l FROM src_orders)
SELECT strftime(e, '%Y-%m-%d %H:%M:%S') AS earliest, strftime(l, '%Y-%m-%d %H:%M:%S') AS latest,
       CAST({_floor_days('e', 'l')} AS BIGINT) AS span_days FROM a""")


@oracle("q_profile_summary")
def _q_summary():
    dl = _date_logic_select()
    return with_base(f"""{_stats_cte()}, dl AS ({dl})
SELECT '{P.as_of_ts}' AS profiled_at,
  (SELECT CAST(count(*) AS BIGINT) FROM src_orders) AS orders_rows,
  (SELECT CAST(count(*) AS BIGINT) FROM src_items) AS items_rows,
  (SELECT CAST(count(*) AS BIGINT) FROM src_customers) AS customers_rows,
  (SELECT CAST(count(*) AS BIGINT) FROM src_products) AS products_rows,
  (SELECT CAST(count(*) AS BIGINT) FROM src_sellers) AS sellers_rows,
  (SELECT invalid_delivery_dates FROM dl) AS invalid_delivery_dates,
  (SELECT future_orders FROM dl) AS future_orders,
  (SELECT CAST(count(*) AS BIGINT) FROM src_items x WHERE NOT EXISTS (SELECT 1 FROM src_orders y WHERE y.order_id = x.order_id)) AS orphan_items,
  (SELECT CAST(count(*) AS BIGINT) FROM src_items WHERE price <= 0) AS zero_price_items,
  (SELECT CAST(count(*) AS BIGINT) FROM src_items, st WHERE CAST(price AS DOUBLE) > st.mean + 3.0 * st.sd) AS price_outliers,
  (SELECT CAST(count(*) AS BIGINT) FROM src_orders x WHERE NOT EXISTS (SELECT 1 FROM src_customers y WHERE y.customer_id = x.customer_id)) AS orders_no_customer
""")


# ---------------------------------------------------------------- helpers
def _cast(expr: str, kind: str) -> str:
    return {
        "i": f"CAST({expr} AS BIGINT)",
        "d": f"CAST({expr} AS DOUBLE)",
        "s": f"CAST({expr} AS VARCHAR)",
        "t": f"strftime({expr}, '%Y-%m-%d %H:%M:%S')",
        "dt": f"strftime({expr}, '%Y-%m-%d')",
        "b": f"CAST({expr} AS BOOLEAN)",
        "x": expr,
    }[kind]


def sel(spec: str, src: str, tail: str = "") -> str:
    """``spec``: 'name:kind, ...' (kind i/d/s/t/dt/b/x); name may be 'alias=expr'."""
    cols = []
    for item in [s.strip() for s in spec.split(",") if s.strip()]:
        name, kind = item.rsplit(":", 1)
        alias, _, expr = name.partition("=")
        cols.append(f"{_cast(expr or alias, kind)} AS {alias}")
    return f"SELECT {', '.join(cols)} FROM {src} {tail}"


ORDERS_SPEC = ("order_id:i, customer_id:i, order_status:s, order_purchase_timestamp:t, order_approved_at:t, "
               "order_delivered_carrier_date:t, order_delivered_customer_date:t, order_estimated_delivery_date:t")
STG_ORDERS_SPEC = ORDERS_SPEC + (", date_key:i, order_year:i, order_month:i, order_quarter:i, delivery_days:i, is_on_time:i, "
                                 "delivery_delay_days:i, status_category:s")
ITEMS_SPEC = "order_id:i, order_item_id:i, product_id:i, seller_id:i, shipping_limit_date:t, price:d, freight_value:d"
STG_ITEMS_SPEC = ITEMS_SPEC + (", date_key:i, order_year:i, order_month:i, order_quarter:i, is_on_time:i, delivery_days:i, "
                               "status_category:s, gross_revenue:d, total_cost:d")
FACT_SPEC = ("date_key:i, customer_key:i, product_key:i, seller_key:i, order_id:i, order_item_seq:i, unit_price:d, freight_value:d, "
             "gross_revenue:d, total_cost:d, delivery_days:i, delivery_delay_days:i, is_on_time:i, primary_payment_type:s, "
             "payment_installments:i, total_payment_value:d, order_status:s, status_category:s, etl_load_date:dt")
DIM_CUSTOMER_SPEC = ("customer_key:i, customer_id:i, customer_unique_id:s, customer_city:s, customer_state:s, customer_zip_prefix:s, "
                     "effective_start_date:dt, effective_end_date:dt, is_current:b, record_version:i, etl_load_date:dt")


def simple(name, spec, src, tail=""):
    _ORACLES[name] = lambda: with_base(f"q AS ({sel(spec, src, tail)}) SELECT * FROM q")


# ---------------------------------------------------------------- staging
simple("stg_orders", STG_ORDERS_SPEC, "stg_orders")
simple("stg_items", STG_ITEMS_SPEC, "stg_items")
simple("stg_customers", "customer_id:i, customer_unique_id:s, customer_city:s, customer_state:s, customer_zip_code_prefix:s, etl_load_date:dt",
       "stg_customers")
simple("stg_products",
       "product_id:i, product_category_name:s, product_weight_g:s, product_length_cm=NULL:s, product_height_cm=NULL:s, product_width_cm=NULL:s, "
       "product_category_name_english:s, price_band:s, weight_category:s, "
       f"avg_price={_rha(_cents('p.sp'), 'p.np * 100', 6)}:x",
       "stg_products s LEFT JOIN (SELECT product_id AS pid, sum(price) AS sp, count(price) AS np FROM src_items WHERE product_id IS NOT NULL GROUP BY 1) p ON p.pid = s.product_id")
simple("stg_payments", "order_id:i, total_payment_value:d, payment_installments:i, payment_types_used:i, primary_payment_type:s", "stg_payments")


@oracle("stg_rejects")
def _stg_rejects():
    o_cols = ORDERS_SPEC + ", order_item_id=NULL:i, product_id=NULL:i, seller_id=NULL:i, shipping_limit_date=NULL:t, price=NULL:d, freight_value=NULL:d"
    i_cols = ("order_id:i, customer_id=NULL:i, order_status=NULL:s, order_purchase_timestamp=NULL:t, order_approved_at=NULL:t, "
              "order_delivered_carrier_date=NULL:t, order_delivered_customer_date=NULL:t, order_estimated_delivery_date=NULL:t, "
              "order_item_id:i, product_id:i, seller_id:i, shipping_limit_date:t, price:d, freight_value:d")
    parts = [
        sel(o_cols + ", reject_reason='NULL purchase timestamp':s", "src_orders", "WHERE order_purchase_timestamp IS NULL"),
        sel(o_cols + ", reject_reason='Delivery date before purchase date':s", "o_bad"),
        sel(i_cols + ", reject_reason='Zero or negative price':s", "src_items", "WHERE price <= 0"),
        sel(i_cols + ", reject_reason='No matching order in orders table':s", "i_priced i",
            "WHERE NOT EXISTS (SELECT 1 FROM stg_orders o WHERE o.order_id = i.order_id)"),
    ]
    return with_base("q AS (" + " UNION ALL ".join(parts) + ") SELECT * FROM q")


simple("stg_null_price", ITEMS_SPEC + ", reject_reason='NULL price':s", "src_items", "WHERE price IS NULL")


def _faults(sql: str) -> str:
    """``sql`` over sources with the faults that ``fixtures.faulty_sources`` describes."""
    faulty = """src_orders AS (
  SELECT order_id, if(m = 4, -customer_id - 1, customer_id) AS customer_id, order_status,
         CASE m WHEN 1 THEN NULL WHEN 2 THEN t + INTERVAL 10 YEAR ELSE t END AS order_purchase_timestamp,
         if(m = 3, t - INTERVAL 1 DAY, order_approved_at) AS order_approved_at,
         order_delivered_carrier_date, order_delivered_customer_date, order_estimated_delivery_date
  FROM (SELECT *, order_purchase_timestamp AS t, if(order_status = 'processing', month(order_purchase_timestamp), 0) AS m
        FROM given_orders) o, range(1, if(m = 5, 3, 2)) copies
),
src_items AS (
  SELECT if(m = 4, -order_id - 1, order_id) AS order_id, order_item_id, product_id, seller_id, shipping_limit_date,
         CASE m WHEN 1 THEN CAST(0 AS DECIMAL(12,2)) WHEN 2 THEN NULL WHEN 5 THEN CAST(price * 100 AS DECIMAL(12,2)) ELSE price END AS price,
         if(m = 3, NULL, freight_value) AS freight_value
  FROM (SELECT *, if(order_item_id = 1, month(shipping_limit_date), 0) AS m FROM given_items)
),
src_payments AS ("""
    customers = """src_customers AS (
  SELECT * FROM given_customers UNION ALL SELECT * REPLACE (' a town ' AS customer_city) FROM given_customers WHERE customer_city = 'MACHINERY'
),
src_products AS ("""
    for old, new in (("src_orders AS (", "given_orders AS ("), ("src_items AS (", "given_items AS ("), ("src_payments AS (", faulty),
                     ("src_customers AS (", "given_customers AS ("), ("src_products AS (", customers)):
        sql = sql.replace(old, new, 1)
    return sql


for _q in ("stg_orders", "stg_items", "stg_rejects", "stg_null_price", "q_duplicate_keys", "q_referential_integrity",
           "q_date_logic", "q_price_checks", "q_outliers", "stg_customers"):
    _ORACLES[f"{_q}_faults"] = lambda _q=_q: _faults(_ORACLES[_q]())


@oracle("stg_summary")
def _stg_summary():
    rej = ("(SELECT count(*) FROM src_orders WHERE order_purchase_timestamp IS NULL) + (SELECT count(*) FROM o_bad) + "
           "(SELECT count(*) FROM src_items WHERE price <= 0) + "
           "(SELECT count(*) FROM i_priced i WHERE NOT EXISTS (SELECT 1 FROM stg_orders o WHERE o.order_id = i.order_id))")
    cnt = lambda t: f"(SELECT CAST(count(*) AS BIGINT) FROM {t})"
    return with_base(f"""q AS (SELECT '{P.as_of_ts}' AS run_timestamp, {cnt('stg_orders')} AS stg_orders_rows, {cnt('stg_items')} AS stg_items_rows,
       {cnt('stg_customers')} AS stg_customers_rows, {cnt('stg_products')} AS stg_products_rows, {cnt('stg_payments')} AS stg_payments_rows,
       CAST({rej} AS BIGINT) AS total_records_rejected) SELECT * FROM q""")


# ---------------------------------------------------------------- dimensions
simple("dim_date", "date_key:i, full_date:dt, year:i, quarter:i, quarter_name:s, month_num:i, month_name:s, month_short:s, week_of_year:i, "
       "day_of_month:i, day_of_week:i, day_name:s, is_weekend:b, is_month_start:b, is_month_end:b, year_month:s", "dim_date",
       "WHERE year BETWEEN (SELECT min(year(o_orderdate)) FROM orders) AND (SELECT max(year(o_orderdate)) FROM orders)")
simple("dim_seller", "seller_key:i, seller_id:i, seller_city:s, seller_state:s, seller_zip_prefix:s, etl_load_date:dt", "dim_seller")
simple("dim_product", "product_key:i, product_id:i, product_category:s, price_band:s, weight_category:s, product_weight_g:d, "
       "product_length_cm:d, product_height_cm:d, product_width_cm:d, etl_load_date:dt", "dim_product")
simple("dim_customer", DIM_CUSTOMER_SPEC, "dim_customer")

SCD2_RUNS = (
    ("1997-01-01", "1997-01-01"), ("1999-01-01", "1999-01-01"), ("1999-01-01", "1999-06-01"), ("2100-01-01", "2002-01-01"),
)


def _feed(i, as_of, run):
    from .oracle import _strip, _title
    return f"""feed{i} AS (
  SELECT c.customer_id, CAST(c.customer_unique_id AS VARCHAR) AS customer_unique_id,
         {_title(_strip('l.pri'))} AS customer_city, upper({_strip('c.customer_state')}) AS customer_state,
         CAST(c.customer_zip_code_prefix AS VARCHAR) AS customer_zip_prefix
  FROM src_customers c
  JOIN (SELECT o_custkey, arg_max(o_orderpriority, (o_orderdate, o_orderkey)) AS pri FROM orders
        WHERE o_orderdate < TIMESTAMP '{as_of} 00:00:00' GROUP BY o_custkey) l ON l.o_custkey = c.customer_id
)"""


def _merge(i, prev, run):
    """dim{i} = SCD2 merge of feed{i} into {prev} on run date ``run``."""
    return f"""cur{i} AS (SELECT * FROM {prev} WHERE is_current),
cmp{i} AS (
  SELECT f.*, c.customer_key AS ckey, c.record_version AS cver,
         CASE WHEN c.customer_key IS NULL THEN 'new'
              WHEN f.customer_city IS DISTINCT FROM c.customer_city OR f.customer_state IS DISTINCT FROM c.customer_state THEN 'updated'
              ELSE 'unchanged' END AS action
  FROM feed{i} f LEFT JOIN cur{i} c ON c.customer_id = f.customer_id
),
ins{i} AS (
  SELECT (SELECT COALESCE(max(customer_key), 0) FROM {prev}) + row_number() OVER (ORDER BY customer_id) AS customer_key,
         customer_id, customer_unique_id, customer_city, customer_state, customer_zip_prefix,
         DATE '{run}' AS effective_start_date, CAST(NULL AS DATE) AS effective_end_date, TRUE AS is_current,
         COALESCE(cver + 1, 1) AS record_version, DATE '{run}' AS etl_load_date
  FROM cmp{i} WHERE action <> 'unchanged'
),
dim{i} AS (
  SELECT d.customer_key, d.customer_id, d.customer_unique_id, d.customer_city, d.customer_state, d.customer_zip_prefix,
         d.effective_start_date,
         CASE WHEN x.ckey IS NOT NULL THEN DATE '{run}' ELSE d.effective_end_date END AS effective_end_date,
         CASE WHEN x.ckey IS NOT NULL THEN FALSE ELSE d.is_current END AS is_current,
         d.record_version, d.etl_load_date
  FROM {prev} d LEFT JOIN (SELECT ckey FROM cmp{i} WHERE action = 'updated') x ON x.ckey = d.customer_key
  UNION ALL SELECT * FROM ins{i}
)"""


def _scd2_ctes():
    parts = ["dim0 AS (SELECT CAST(NULL AS BIGINT) AS customer_key, CAST(NULL AS BIGINT) AS customer_id, CAST(NULL AS VARCHAR) AS customer_unique_id, "
             "CAST(NULL AS VARCHAR) AS customer_city, CAST(NULL AS VARCHAR) AS customer_state, CAST(NULL AS VARCHAR) AS customer_zip_prefix, "
             "CAST(NULL AS DATE) AS effective_start_date, CAST(NULL AS DATE) AS effective_end_date, CAST(NULL AS BOOLEAN) AS is_current, "
             "CAST(NULL AS INTEGER) AS record_version, CAST(NULL AS DATE) AS etl_load_date WHERE FALSE)"]
    for i, (as_of, run) in enumerate(SCD2_RUNS, start=1):
        parts.append(_feed(i, as_of, run))
        parts.append(_merge(i, f"dim{i - 1}", run))
    return ",\n".join(parts)


@oracle("dim_customer_scd2")
def _scd2():
    return with_base(f"{_scd2_ctes()}\n{sel(DIM_CUSTOMER_SPEC, f'dim{len(SCD2_RUNS)}')}")


@oracle("scd2_actions")
def _scd2_actions():
    parts = [f"SELECT action, CAST(count(*) AS BIGINT) AS customers, CAST({i} AS BIGINT) AS run FROM cmp{i} GROUP BY action"
             for i in range(1, len(SCD2_RUNS) + 1)]
    return with_base(f"{_scd2_ctes()},\nq AS ({' UNION ALL '.join(parts)}) SELECT * FROM q")


@oracle("dim_verify_counts")
def _dim_verify():
    return with_base("""q AS (SELECT CAST((SELECT count(*) FROM dim_date) AS BIGINT) AS dim_date_rows,
  (SELECT strftime(min(full_date), '%Y-%m-%d') FROM dim_date) AS date_min, (SELECT strftime(max(full_date), '%Y-%m-%d') FROM dim_date) AS date_max,
  CAST((SELECT count(*) FROM dim_seller) AS BIGINT) AS dim_seller_rows, CAST((SELECT count(*) FROM dim_product) AS BIGINT) AS dim_product_rows,
  CAST((SELECT count(*) FROM dim_customer WHERE is_current) AS BIGINT) AS dim_customer_current_rows) SELECT * FROM q""")


simple("dim_price_bands", "price_band:s, product_count=count(*):i", "dim_product", "GROUP BY price_band")

# ---------------------------------------------------------------- fact
simple("fact_full", FACT_SPEC, "fact_sales")
simple("fact_incremental", FACT_SPEC, "fact_sales")
simple("fact_streaming", FACT_SPEC, "fact_sales")
simple("fact_stream_feeds", FACT_SPEC, "fact_sales")
_INCR_CUT = "2000-01-01 00:00:00"


@oracle("fact_incremental_batch2")
def _fact_incr2():
    return with_base(f"""
fo AS (SELECT f.*, o.order_purchase_timestamp AS pts FROM fact_sales f JOIN stg_orders o ON o.order_id = f.order_id),
wm AS (SELECT max(pts) AS w FROM fo WHERE pts < TIMESTAMP '{_INCR_CUT}'),
q AS ({sel(FACT_SPEC, 'fo', 'WHERE pts > (SELECT w FROM wm)')}) SELECT * FROM q""")


SELLER_FEEDS = ("1995-01-04", "1995-01-06", "1995-01-08")


def _sellers_in(start, end):
    after = f"o_orderdate >= TIMESTAMP '{start} 00:00:00' AND " if start else ""
    return f"SELECT l_suppkey FROM lineitem JOIN orders ON o_orderkey = l_orderkey WHERE {after}o_orderdate < TIMESTAMP '{end} 00:00:00'"


@oracle("dim_seller_three_feeds")
def _seller_feeds():
    # a seller's key: place of the first feed that holds it, then its id; the date: the last feed that holds it
    feeds = " UNION ALL ".join(f"SELECT {n} AS feed, id FROM (SELECT DISTINCT l_suppkey AS id FROM ({_sellers_in(a, b)}))"
                               for n, (a, b) in enumerate(zip((None, *SELLER_FEEDS), SELLER_FEEDS), start=1))
    return with_base(f"""
seen AS (SELECT id, min(feed) AS first_feed, max(feed) AS last_feed FROM ({feeds}) GROUP BY id)
SELECT CAST(row_number() OVER (ORDER BY first_feed, id) AS BIGINT) AS seller_key, CAST(seller_id AS BIGINT) AS seller_id,
       seller_city, seller_state, seller_zip_prefix, '2000-0' || last_feed || '-01' AS etl_load_date
FROM seen JOIN dim_seller ON seller_id = id""")


simple("fact_load_two_runs", FACT_SPEC, "fact_sales")
simple("fact_after_dimension_fix", FACT_SPEC.replace("seller_key:i", "seller_id:i"),
       "(SELECT f.*, d.seller_id FROM fact_sales f JOIN dim_seller d ON d.seller_key = f.seller_key)")
simple("fact_duplicate_product", FACT_SPEC.replace("product_key:i", "product_key=product_key + (SELECT max(product_key) FROM dim_product):i"), "fact_sales")


@oracle("fact_key_audit")
def _key_audit():
    short = {"dim_date": f"(SELECT date_key FROM dim_date WHERE full_date < DATE '{_INCR_CUT[:10]}')",
             "dim_seller": f"(SELECT seller_key FROM dim_seller WHERE seller_id IN ({_sellers_in(None, SELLER_FEEDS[0])}))"}
    parts = []
    for dim in ("dim_date", "dim_customer", "dim_product", "dim_seller"):
        key = dim.removeprefix("dim_") + "_key"
        src = short.get(dim, f"(SELECT {key} FROM {dim})")
        parts.append(f"SELECT '{key} not in {dim}' AS check_name, count(*) AS \"rows\" FROM fact_sales WHERE {key} NOT IN {src}")
        parts.append(f"SELECT '{key} is null' AS check_name, count(*) - count({key}) AS \"rows\" FROM fact_sales")
    return with_base(f"q AS ({' UNION ALL '.join(parts)}) SELECT * FROM q")


@oracle("fact_lookup_failures")
def _fact_fail():
    from .oracle import _strip, _title
    return with_base(f"""
dim_seller_active AS (
  SELECT row_number() OVER (ORDER BY s.seller_id) AS seller_key, s.seller_id
  FROM src_sellers s WHERE s.seller_id IN ({_sellers_in(None, SELLER_FEEDS[0])})
),
fa AS (
  SELECT i.order_id, i.order_item_id, o.customer_id, i.product_id, i.seller_id, c.customer_key, pr.product_key, s.seller_key
  FROM stg_items i JOIN stg_orders o ON i.order_id = o.order_id
  LEFT JOIN dim_customer c ON c.customer_id = o.customer_id AND c.is_current
  LEFT JOIN dim_product pr ON pr.product_id = i.product_id
  LEFT JOIN dim_seller_active s ON s.seller_id = i.seller_id
),
q AS (SELECT CAST(order_id AS BIGINT) AS order_id, CAST(order_item_id AS BIGINT) AS order_item_id, CAST(customer_id AS BIGINT) AS customer_id,
  CAST(product_id AS BIGINT) AS product_id, CAST(seller_id AS BIGINT) AS seller_id,
  concat_ws(',', CASE WHEN customer_key IS NULL THEN 'customer' END, CASE WHEN product_key IS NULL THEN 'product' END,
            CASE WHEN seller_key IS NULL THEN 'seller' END) AS failed_dims
  FROM fa WHERE customer_key IS NULL OR product_key IS NULL OR seller_key IS NULL)
SELECT * FROM q""")


@oracle("fact_failure_queue")
def _failure_queue():
    # lines of sellers that the first feed lacks fail twice; the second feed's load at the third run, the rest at the fourth
    return with_base(f"""
fa AS (
  SELECT i.order_id, i.order_item_id, i.product_id, i.seller_id, o.order_purchase_timestamp AS ts, i.seller_id IN ({_sellers_in(None, SELLER_FEEDS[1])}) AS third
  FROM stg_items i JOIN stg_orders o ON i.order_id = o.order_id
  WHERE i.seller_id NOT IN ({_sellers_in(None, SELLER_FEEDS[0])})
)
SELECT CAST(order_id AS BIGINT) AS order_id, CAST(order_item_id AS BIGINT) AS order_item_id, CAST(product_id AS BIGINT) AS product_id,
  CAST(seller_id AS BIGINT) AS seller_id, 'loaded' AS state, 'seller' AS failed_dims, CAST(count(*) AS BIGINT) AS lines,
  CAST(CASE WHEN third THEN 3 ELSE 4 END AS BIGINT) AS attempts, CAST(10 AS BIGINT) AS first_run,
  CAST(CASE WHEN third THEN 30 ELSE 40 END AS BIGINT) AS last_run, CAST(max(year(ts) * 100 + month(ts)) AS BIGINT) AS fail_month
FROM fa GROUP BY order_id, order_item_id, product_id, seller_id, third""")


@oracle("fact_reconciliation")
def _reconciliation():
    # per line: 1 in the source; 0, 1 or 2 in the fact. A day differs unless each of its lines is there once.
    return with_base(f"""
held AS (
  SELECT date_key, price, CASE WHEN seller_id NOT IN ({_sellers_in(None, SELLER_FEEDS[0])}) THEN 0 WHEN status_category = 'Completed' THEN 2 ELSE 1 END AS n
  FROM stg_items
)
SELECT CAST(date_key AS BIGINT) AS date_key, CAST(count(*) AS BIGINT) AS source_lines, CAST(sum(n) AS BIGINT) AS fact_lines,
       CAST(sum(price * (1 - n)) AS DOUBLE) AS missing_revenue
FROM held GROUP BY date_key HAVING count(*) FILTER (WHERE n <> 1) > 0""")


simple("fact_full_reload", FACT_SPEC, "fact_sales")
simple("fact_late_orders", FACT_SPEC, "fact_sales")


@oracle("control_log_jobs")
def _control_log_jobs():
    def row(log_id, target, loaded, last="NULL", status="SUCCESS", error="NULL"):
        return (f"SELECT CAST({log_id} AS BIGINT) AS log_id, '{target}' AS target_table, CAST({loaded} AS BIGINT) AS records_loaded, CAST(0 AS BIGINT) AS records_rejected, "
                f"CAST({last} AS VARCHAR) AS last_loaded_ts, '{status}' AS status, CAST({error} AS VARCHAR) AS error_message, TRUE AS timed")

    placed = "(SELECT strftime(max(o.order_purchase_timestamp), '%Y-%m-%d %H:%M:%S') FROM fact_sales f JOIN stg_orders o ON o.order_id = f.order_id{})"
    early = f" WHERE o.order_purchase_timestamp < TIMESTAMP '{_INCR_CUT}'"
    lines = "(SELECT count(*) FROM fact_sales f JOIN stg_orders o ON o.order_id = f.order_id WHERE o.order_purchase_timestamp {} TIMESTAMP '" + _INCR_CUT + "')"
    parts = [row(n, t, f"(SELECT count(*) FROM {t})") for n, t in enumerate(("dim_date", "dim_seller", "dim_product", "dim_customer"), start=1)]
    parts.append(row(5, "fact_sales", lines.format("<"), placed.format(early)))
    parts.append(row(6, "fact_sales", "0", status="FAILED", error="'the staged input lacks fact columns: gross_revenue'"))
    parts.append(row(7, "fact_sales", lines.format(">="), placed.format("")))
    return with_base("q AS (" + " UNION ALL ".join(parts) + ") SELECT * FROM q")


@oracle("dim_seller_duplicate_feed")
def _seller_duplicates():
    return with_base("""q AS (SELECT * FROM dim_seller)
SELECT CAST(row_number() OVER (ORDER BY seller_id) AS BIGINT) AS seller_key, CAST(seller_id AS BIGINT) AS seller_id,
  CASE WHEN 'A ' || seller_city < seller_city THEN 'A ' || seller_city ELSE seller_city END AS seller_city,
  seller_state, seller_zip_prefix, '2000-03-01' AS etl_load_date FROM q""")


@oracle("fact_required_audit")
def _fact_audit():
    cols = ("date_key", "customer_id", "product_id", "seller_id", "gross_revenue", "delivery_delay_days")
    parts = [f"SELECT '{c}' AS column_name, TRUE AS present, CAST(count(*) - count({c}) AS BIGINT) AS nulls FROM fact_all" for c in cols]
    return with_base("q AS (" + " UNION ALL ".join(parts) + ") SELECT * FROM q")


simple("fact_verify_totals", "total_rows=count(*):i, total_revenue=sum(gross_revenue):d", "fact_sales")
simple("fact_rev_by_year", "year=d.year:i, orders=count(DISTINCT f.order_id):i, revenue=sum(f.gross_revenue):d",
       "fact_sales f JOIN dim_date d ON f.date_key = d.date_key", "GROUP BY d.year")
simple("fact_rev_by_status", "status_category:s, records=count(*):i, revenue=sum(gross_revenue):d", "fact_sales", "GROUP BY status_category")
simple("fact_top_categories", "product_category=p.product_category:s, revenue=sum(f.gross_revenue):d, orders=count(DISTINCT f.order_id):i",
       "fact_sales f JOIN dim_product p ON f.product_key = p.product_key",
       "GROUP BY p.product_category ORDER BY sum(f.gross_revenue) DESC, p.product_category LIMIT 5")
simple("fact_rev_by_payment", "primary_payment_type:s, transactions=count(*):i, revenue=sum(gross_revenue):d", "fact_sales",
       "GROUP BY primary_payment_type")


# ---------------------------------------------------------------- marts
def _m1(where: str = "TRUE"):
    return with_base(f"""
a AS (SELECT sum(gross_revenue) AS rev, count(DISTINCT order_id) AS orders, count(DISTINCT customer_key) AS customers,
             count(DISTINCT CASE WHEN status_category = 'Completed' THEN order_id END) AS done_orders,
             sum(CASE WHEN status_category = 'Completed' THEN is_on_time END) AS ot,
             count(*) FILTER (WHERE status_category = 'Completed') AS done_rows
      FROM fact_sales WHERE {where})
SELECT CAST(rev AS DOUBLE) AS total_revenue, CAST(orders AS BIGINT) AS total_orders, CAST(customers AS BIGINT) AS total_customers,
       {_rha(_cents('rev'), 'orders * 100', 2)} AS revenue_per_order, {_rha('ot * 100', 'done_rows', 2)} AS on_time_pct,
       {_rha('done_orders * 100', 'orders', 2)} AS completed_order_pct
FROM a""")


_ORACLES["m1_kpis"] = _m1
_ORACLES["m11_kpis_1998"] = lambda: _m1("date_key BETWEEN 19980101 AND 19981231")
simple("m2_monthly", "year_month=d.year_month:s, revenue=sum(f.gross_revenue):d, orders=count(DISTINCT f.order_id):i",
       "fact_sales f JOIN dim_date d ON f.date_key = d.date_key", "GROUP BY d.year_month")
simple("m11_monthly_1999_03", "year_month=d.year_month:s, revenue=sum(f.gross_revenue):d, orders=count(DISTINCT f.order_id):i",
       "fact_sales f JOIN dim_date d ON f.date_key = d.date_key", "WHERE f.date_key BETWEEN 19990301 AND 19990331 GROUP BY d.year_month")
simple("m3_top_categories", "product_category=p.product_category:s, revenue=sum(f.gross_revenue):d, orders=count(DISTINCT f.order_id):i",
       "fact_sales f JOIN dim_product p ON f.product_key = p.product_key",
       "GROUP BY p.product_category ORDER BY sum(f.gross_revenue) DESC, p.product_category LIMIT 10")
simple("m8_category_revenue", "product_category=p.product_category:s, revenue=sum(f.gross_revenue):d, orders=count(DISTINCT f.order_id):i",
       "fact_sales f JOIN dim_product p ON f.product_key = p.product_key", "GROUP BY p.product_category")
simple("m8_price_band_by_year", "year=d.year:i, price_band=p.price_band:s, revenue=sum(f.gross_revenue):d, orders=count(DISTINCT f.order_id):i",
       "fact_sales f JOIN dim_product p ON f.product_key = p.product_key JOIN dim_date d ON f.date_key = d.date_key",
       "GROUP BY d.year, p.price_band")


def _share_sql(name, key, src, extra=""):
    _ORACLES[name] = lambda: with_base(f"""
g AS (SELECT {key}, sum(gross_revenue) AS revenue {extra} FROM {src} GROUP BY {key})
SELECT {key}, CAST(revenue AS DOUBLE) AS revenue {', CAST(orders AS BIGINT) AS orders' if extra else ''},
       {_rha(_cents('revenue') + ' * 100', _cents('sum(revenue) OVER ()'), 2)} AS revenue_pct FROM g""")


_share_sql("m4_payment_types", "primary_payment_type", "fact_sales", ", count(DISTINCT order_id) AS orders")
_share_sql("m5_states", "customer_state", "fact_sales f JOIN dim_customer c ON f.customer_key = c.customer_key")
simple("m5_cities", "customer_state=c.customer_state:s, customer_city=c.customer_city:s, revenue=sum(f.gross_revenue):d, orders=count(DISTINCT f.order_id):i",
       "fact_sales f JOIN dim_customer c ON f.customer_key = c.customer_key", "GROUP BY c.customer_state, c.customer_city")


@oracle("m6_order_status")
def _m6():
    return with_base(f"""g AS (SELECT order_status, count(DISTINCT order_id) AS orders FROM fact_sales GROUP BY order_status)
SELECT order_status, CAST(orders AS BIGINT) AS orders, {_rha('orders * 100', 'sum(orders) OVER ()', 2)} AS orders_pct FROM g""")


@oracle("m7_state_metrics")
def _m7():
    return with_base(f"""g AS (
  SELECT c.customer_state, count(DISTINCT f.order_id) AS orders, count(DISTINCT f.customer_key) AS customers, sum(f.gross_revenue) AS rev,
         sum(f.delivery_days) AS sd, count(f.delivery_days) AS nd, sum(f.is_on_time) AS ot, count(*) AS nrows
  FROM fact_sales f JOIN dim_customer c ON f.customer_key = c.customer_key GROUP BY c.customer_state)
SELECT customer_state, CAST(orders AS BIGINT) AS orders, CAST(customers AS BIGINT) AS customers, CAST(rev AS DOUBLE) AS revenue,
       {_rha(_cents('rev'), 'orders * 100', 2)} AS revenue_per_order, {_rha('sd', 'nd', 1)} AS avg_delivery_days,
       {_rha('ot * 100', 'nrows', 2)} AS on_time_pct FROM g""")


# Every slice of a mart: sets of (year, month), (year) and () over the fact itself.
_CUTS = """cut AS (SELECT f.*, c.customer_state, c.customer_city, p.product_category, f.date_key // 10000 AS y, f.date_key // 100 % 100 AS m
  FROM fact_sales f LEFT JOIN dim_customer c ON c.customer_key = f.customer_key LEFT JOIN dim_product p ON p.product_key = f.product_key)"""
_SLICE = "CAST(y AS BIGINT) AS slice_year, CAST(m AS BIGINT) AS slice_month"


def _sets(*keys: str) -> str:
    more = "".join(f", {k}" for k in keys)
    return f"GROUP BY GROUPING SETS ((y, m{more}), (y{more}), ({', '.join(keys)}))"


def _m1_slices():
    return with_base(f"""{_CUTS},
a AS (SELECT y, m, sum(gross_revenue) AS rev, count(DISTINCT order_id) AS orders, count(DISTINCT customer_key) AS customers,
             count(DISTINCT CASE WHEN status_category = 'Completed' THEN order_id END) AS done_orders,
             sum(CASE WHEN status_category = 'Completed' THEN is_on_time END) AS ot,
             count(*) FILTER (WHERE status_category = 'Completed') AS done_rows
      FROM cut {_sets()})
SELECT {_SLICE}, CAST(rev AS DOUBLE) AS total_revenue, CAST(orders AS BIGINT) AS total_orders, CAST(customers AS BIGINT) AS total_customers,
       {_rha(_cents('rev'), 'orders * 100', 2)} AS revenue_per_order, {_rha('ot * 100', 'done_rows', 2)} AS on_time_pct,
       {_rha('done_orders * 100', 'orders', 2)} AS completed_order_pct
FROM a""")


_ORACLES["m11_cube_kpis"] = _ORACLES["m11_cube_refreshed"] = _m1_slices


def _slices(name: str, keys: tuple[str, ...], cols: str, tail: str = "") -> None:
    named = ", ".join(keys)
    _ORACLES[name] = lambda: with_base(f"""{_CUTS},
g AS (SELECT y, m, {named}, sum(gross_revenue) AS rev, count(DISTINCT order_id) AS orders, count(DISTINCT customer_key) AS customers,
             sum(delivery_days) AS sd, count(delivery_days) AS nd, sum(is_on_time) AS ot, count(*) AS nrows
      FROM cut {_sets(*keys)})
SELECT {_SLICE}, {named}, {cols} FROM g {tail}""")


_REV, _ORD = "CAST(rev AS DOUBLE) AS revenue", "CAST(orders AS BIGINT) AS orders"
_PCT = _rha(_cents("rev") + " * 100", _cents("sum(rev) OVER (PARTITION BY y, m)"), 2) + " AS revenue_pct"
_slices("m11_cube_top_categories", ("product_category",), f"{_REV}, {_ORD}",
        "QUALIFY row_number() OVER (PARTITION BY y, m ORDER BY rev DESC, product_category) <= 10")
_slices("m11_cube_categories", ("product_category",), f"{_REV}, {_ORD}")
_slices("m11_cube_payment_types", ("primary_payment_type",), f"{_REV}, {_ORD}, {_PCT}")
_slices("m11_cube_states", ("customer_state",), f"{_REV}, {_PCT}")
_slices("m11_cube_cities", ("customer_state", "customer_city"), f"{_REV}, {_ORD}")
_slices("m11_cube_order_status", ("order_status",), f"{_ORD}, {_rha('orders * 100', 'sum(orders) OVER (PARTITION BY y, m)', 2)} AS orders_pct")
_slices("m11_cube_state_metrics", ("customer_state",),
        f"{_ORD}, CAST(customers AS BIGINT) AS customers, {_REV}, {_rha(_cents('rev'), 'orders * 100', 2)} AS revenue_per_order, "
        f"{_rha('sd', 'nd', 1)} AS avg_delivery_days, {_rha('ot * 100', 'nrows', 2)} AS on_time_pct")
_ORACLES["m11_cube_monthly"] = lambda: _ORACLES["m2_monthly"]()
_ORACLES["m11_cube_price_bands"] = lambda: _ORACLES["m8_price_band_by_year"]()


@oracle("control_log")
def _control_log():
    rows = [(1, "dim_date", "dim_date", None), (2, "dim_seller", "dim_seller", None), (3, "dim_product", "dim_product", None),
            (4, "dim_customer", "dim_customer", None), (5, "fact_sales", "fact_sales", "fact_all WHERE customer_key IS NULL OR product_key IS NULL OR seller_key IS NULL")]
    parts = []
    for i, tgt, tbl, rej in rows:
        rej_sql = f"(SELECT count(*) FROM {rej})" if rej else "0"
        parts.append(
            f"SELECT CAST({i} AS BIGINT) AS log_id, '{tgt}' AS target_table, '2002-01-01 00:00:0{i - 1}' AS run_start_ts, "
            f"'2002-01-01 00:00:0{i}' AS run_end_ts, CAST((SELECT count(*) FROM {tbl}) AS BIGINT) AS records_loaded, "
            f"CAST({rej_sql} AS BIGINT) AS records_rejected, CAST(NULL AS VARCHAR) AS last_loaded_ts, 'SUCCESS' AS status, "
            f"CAST(NULL AS VARCHAR) AS error_message, 'starmart' AS run_by")
    return with_base("q AS (" + " UNION ALL ".join(parts) + ") SELECT * FROM q")


@oracle("m8_price_band_pivot")
def _m8_pivot():
    bands = ("Budget", "Mid-Range", "Premium", "Luxury", "Unknown")
    cols = ", ".join(f'CAST(sum(CASE WHEN p.price_band = \'{b}\' THEN f.gross_revenue END) AS DOUBLE) AS "{b}"' for b in bands)
    return with_base(f"""q AS (SELECT CAST(d.year AS BIGINT) AS year, {cols}
FROM fact_sales f JOIN dim_product p ON f.product_key = p.product_key JOIN dim_date d ON f.date_key = d.date_key
GROUP BY d.year) SELECT * FROM q""")


@oracle("q_types")
def _q_types():
    # DuckDB's own types for the derived orders extract, in Spark's names.
    from .oracle import BASE_CTES
    cols = [c.split(":")[0].strip() for c in ORDERS_SPEC.split(",")]
    held = " UNION ALL ".join(f"SELECT '{c}' AS column_name, count({c}) AS held FROM src_orders" for c in cols)
    return f"""SELECT 'orders' AS table_name, column_name,
  CASE column_type WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int' WHEN 'VARCHAR' THEN 'string'
       WHEN 'TIMESTAMP' THEN 'timestamp_ntz' WHEN 'DOUBLE' THEN 'double' WHEN 'DATE' THEN 'date'
       ELSE lower(column_type) END AS data_type, held
FROM (DESCRIBE WITH {BASE_CTES.strip()} SELECT * FROM src_orders)
JOIN (WITH {BASE_CTES.strip()} {held}) USING (column_name)"""


@oracle("m9_delivery_by_state")
def _m9():
    from .oracle import _x7
    return f"SELECT seller_state, total_deliveries, avg_delivery_days, avg_delay_days, on_time_pct FROM ({_x7()})"


@oracle("m10_freight_trend")
def _m10():
    from .oracle import _x9
    return f"SELECT period, gross_revenue, total_freight, freight_pct_of_revenue FROM ({_x9()})"


_CR = "cr AS (SELECT customer_key, sum(gross_revenue) AS revenue FROM fact_sales GROUP BY customer_key)"


@oracle("g1_rank")
def _g1_rank():
    return with_base(f"""{_CR}
SELECT CAST(customer_key AS BIGINT) AS customer_key, CAST(revenue AS DOUBLE) AS revenue,
       CAST(row_number() OVER (ORDER BY revenue DESC, customer_key) AS BIGINT) AS row_num,
       CAST(rank() OVER (ORDER BY revenue DESC) AS BIGINT) AS revenue_rank,
       CAST(dense_rank() OVER (ORDER BY revenue DESC) AS BIGINT) AS revenue_dense_rank
FROM cr""")


@oracle("g1_ntile")
def _g1_ntile():
    return with_base(f"""{_CR}
SELECT CAST(customer_key AS BIGINT) AS customer_key, CAST(revenue AS DOUBLE) AS revenue,
       CAST(ntile(10) OVER (ORDER BY revenue DESC, customer_key) AS BIGINT) AS revenue_decile
FROM cr""")


@oracle("g1_running_sum")
def _g1_running():
    return with_base(f"""{_CR}
SELECT CAST(customer_key AS BIGINT) AS customer_key, CAST(revenue AS DOUBLE) AS revenue,
       CAST(sum(revenue) OVER (ORDER BY revenue DESC, customer_key ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) AS cumulative_revenue,
       CAST(sum(revenue) OVER () AS DOUBLE) AS total_revenue,
       CAST(count(*) OVER () AS BIGINT) AS customers
FROM cr""")
