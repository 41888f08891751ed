"""Registered queries: one per operator ID of the inventory.

Every query reads the testdata tables of one scale factor through the raw
mapping, runs the operator over the whole tables and returns its DataFrame;
``ORACLES`` holds the DuckDB SQL for the same result where SQL can express it.
Report edges turn DECIMAL money into DOUBLE (both sides).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderlake.operators import clean as C
from orderlake.operators import metrics as A
from orderlake.functions.dates import ntz_lit
from orderlake.plans.oracle import D, MONTH, R, with_layers
from orderlake.schemas import RAW_SCHEMAS
from orderlake.sources import testdata

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

# Parameters scaled to the testdata (the warehouse defaults are noted beside).
MIN_MONTH_ORDERS = 50          # A2 floor; warehouse default 100


def report_edge(df: DataFrame) -> DataFrame:
    """Cast DECIMAL columns to DOUBLE for the report/oracle boundary."""
    return df.select(*[F.col(f.name).cast("double").alias(f.name)
                       if isinstance(f.dataType, T.DecimalType) else F.col(f.name)
                       for f in df.schema.fields])


def register(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = lambda spark, sf_dir: report_edge(fn(spark, sf_dir))
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


def raw(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return testdata.raw_tables(spark, sf_dir)


def clean(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return C.clean_layer(raw(spark, sf_dir))


_REFRESHED: dict[tuple[str, str, str], str] = {}


def _once(spark, d, what: str, build: Callable[[str], None]) -> str:
    """The folder that ``build`` fills, once per session and scale factor."""
    key = (spark.sparkContext.applicationId, d, what)
    if key not in _REFRESHED:
        root = scratch(spark)
        build(root)
        _REFRESHED[key] = root
    return _REFRESHED[key]


# ------------------------------------------------------------------ clean layer

@register("c1_clean_orders", with_layers("SELECT * FROM clean_orders"))
def _c1(spark, d):
    return clean(spark, d)["orders"]


@register("c2_clean_order_items", with_layers(
    "SELECT * REPLACE (CAST(price AS DOUBLE) AS price, CAST(freight_value AS DOUBLE) AS freight_value,"
    " CAST(total_item_value AS DOUBLE) AS total_item_value) FROM clean_order_items"))
def _c2(spark, d):
    return clean(spark, d)["order_items"]


@register("c3_clean_customers", with_layers("SELECT * FROM clean_customers"))
def _c3(spark, d):
    return clean(spark, d)["customers"]


@register("c4_clean_payments", with_layers(
    "SELECT * REPLACE (CAST(total_payment AS DOUBLE) AS total_payment) FROM clean_payments"))
def _c4(spark, d):
    return clean(spark, d)["payments"]


@register("c5_clean_reviews", with_layers("SELECT * FROM clean_reviews"))
def _c5(spark, d):
    return clean(spark, d)["reviews"]


@register("c6_clean_products", with_layers("SELECT * FROM clean_products"))
def _c6(spark, d):
    return clean(spark, d)["products"]


@register("c7_clean_sellers", with_layers("SELECT * FROM clean_sellers"))
def _c7(spark, d):
    return clean(spark, d)["sellers"]


# ------------------------------------------------------------------ metrics layer

_DELIVERED_OP = """FROM clean_orders o JOIN clean_payments p ON o.order_id = p.order_id
        WHERE o.order_status = 'delivered'"""


A1_SQL = f"""
        SELECT CAST(o.purchased_at AS DATE) AS order_date,
               count(DISTINCT o.order_id) AS total_orders,
               {D('sum(p.total_payment)')} AS revenue,
               {R('avg(p.total_payment)', 2)} AS avg_order_value
        {_DELIVERED_OP}
        GROUP BY CAST(o.purchased_at AS DATE)"""


@register("a1_daily_revenue", with_layers(A1_SQL))
def _a1(spark, d):
    c = clean(spark, d)
    return A.daily_revenue(c["orders"], c["payments"])


A2_SQL = f"""
        SELECT this.month, this.total_orders, {D('this.paid')} AS revenue, this.avg_order_value,
               {R('(this.paid - former.paid) * 100 / nullif(former.paid, 0)', 2)} AS revenue_growth_pct
        FROM kept_months AS this
        LEFT JOIN (SELECT late.month, max(early.month) AS former_month
                   FROM kept_months AS late JOIN kept_months AS early ON early.month < late.month GROUP BY late.month) AS step
               ON step.month = this.month
        LEFT JOIN kept_months AS former ON former.month = step.former_month"""
A2_BASE = f"""
        SELECT *, {R('paid / payments', 2)} AS avg_order_value
        FROM (SELECT {MONTH('purchased_at')} AS month, count(DISTINCT order_id) AS total_orders,
                     sum(total_payment) AS paid, count(total_payment) AS payments
              FROM clean_orders JOIN clean_payments USING (order_id)
              WHERE order_status = 'delivered' GROUP BY ALL) AS months
        WHERE total_orders >= {MIN_MONTH_ORDERS}"""


@register("a2_monthly_revenue", with_layers(A2_SQL, kept_months=A2_BASE))
def _a2(spark, d):
    c = clean(spark, d)
    return A.monthly_revenue(c["orders"], c["payments"], min_orders=MIN_MONTH_ORDERS)


A3_SQL = f"""
        SELECT product_id, category_english AS category, orders_n AS total_orders, {D('sold')} AS total_revenue,
               {R('price_mean', 2)} AS avg_price, {R('score_mean', 2)} AS avg_review_score, sellers_n AS seller_count,
               1 + (SELECT count(*) FROM product_sales AS other
                    WHERE other.sold > mine.sold
                      AND other.category_english IS NOT DISTINCT FROM mine.category_english) AS rank_in_category
        FROM product_sales AS mine"""


@register("a3_top_products", with_layers(A3_SQL))
def _a3(spark, d):
    c = clean(spark, d)
    return A.top_products(c["order_items"], c["orders"], c["reviews"])


A4_SQL = f"""
        SELECT category_english AS category,
               count(DISTINCT order_id) AS total_orders,
               {D('sum(price)')} AS total_revenue,
               {R('avg(price)', 2)} AS avg_price,
               count(DISTINCT product_id) AS unique_products
        FROM clean_order_items
        GROUP BY category_english"""


@register("a4_top_categories", with_layers(A4_SQL))
def _a4(spark, d):
    return A.top_categories(clean(spark, d)["order_items"])


# Every person's orders in a row; the last one's running totals are the person's.
A5_SQL = f"""
        SELECT customer_unique_id, state, city, nth AS total_orders, {D('so_far')} AS total_spent, since AS first_order_date,
               until AS last_order_date, {R('so_far / nth', 2)} AS avg_order_value,
               trunc((epoch(until) - epoch(since)) / 86400)::INTEGER AS customer_lifespan_days,
               (['low_value', 'mid_value', 'high_value'])[1 + (so_far >= 200)::INTEGER + (so_far >= 500)::INTEGER] AS customer_segment,
               (nth > 1)::INTEGER AS is_repeat_customer
        FROM (SELECT customer_unique_id, state, city, row_number() OVER upto AS nth, sum(total_payment) OVER upto AS so_far,
                     min(purchased_at) OVER upto AS since, max(purchased_at) OVER upto AS until,
                     row_number() OVER (PARTITION BY customer_unique_id, state, city ORDER BY order_id DESC) AS from_end
              FROM clean_payments
              SEMI JOIN (SELECT order_id FROM clean_orders WHERE order_status = 'delivered') USING (order_id)
              JOIN clean_orders USING (order_id) JOIN clean_customers USING (customer_id)
              WINDOW upto AS (PARTITION BY customer_unique_id, state, city ORDER BY order_id ROWS UNBOUNDED PRECEDING)) walked
        WHERE from_end = 1"""


@register("a5_customer_lifetime_value", with_layers(A5_SQL))
def _a5(spark, d):
    c = clean(spark, d)
    return A.customer_lifetime_value(c["customers"], c["orders"], c["payments"])


# An order stands for as many joined rows as it has reviews, or one.
A6_SQL = f"""
        SELECT month, {R('sum(w * total_payment) / sum(w)', 2)} AS avg_basket, count(*) AS total_orders,
               {R('100.0 * sum(w * delivered_on_time) / sum(w)', 2)} AS on_time_delivery_rate_pct,
               {R('sum(w * delivery_days) / nullif(sum(w * (delivery_days IS NOT NULL)::INTEGER), 0)', 1)} AS avg_delivery_days,
               {R('sum(stars) / nullif(sum(starred), 0)', 2)} AS avg_review_score,
               {R('100.0 * sum(notes) / nullif(sum(k), 0)', 2)} AS review_comment_rate_pct,
               {R("100.0 * sum(w * (order_status = 'canceled')::INTEGER) / sum(w)", 2)} AS cancellation_rate_pct
        FROM (SELECT {MONTH('purchased_at')} AS month, order_status, delivered_on_time, delivery_days, total_payment,
                     k, greatest(coalesce(k, 0), 1) AS w, stars, starred, notes
              FROM clean_payments JOIN clean_orders USING (order_id)
              LEFT JOIN (SELECT order_id, count(*) AS k, sum(review_score) AS stars, count(review_score) AS starred, sum(has_comment) AS notes
                         FROM clean_reviews GROUP BY order_id) per_order USING (order_id)) weighted
        GROUP BY month"""


@register("a6_kpi_summary", with_layers(A6_SQL))
def _a6(spark, d):
    c = clean(spark, d)
    return A.kpi_summary(c["orders"], c["payments"], c["reviews"])


A7_SQL = f"""
        SELECT seller_id, city AS seller_city, state AS seller_state, orders_n AS total_orders, {D('sold')} AS total_revenue,
               {R('price_mean', 2)} AS avg_product_price, products_n AS unique_products,
               {R('score_mean', 2)} AS avg_review_score, {R('days_mean', 1)} AS avg_delivery_days,
               {R('100 * on_time_mean', 2)} AS on_time_rate_pct,
               1 + (SELECT count(*) FROM seller_sales AS other WHERE other.sold > mine.sold) AS revenue_rank
        FROM seller_sales AS mine"""


@register("a7_seller_performance", with_layers(A7_SQL))
def _a7(spark, d):
    c = clean(spark, d)
    return A.seller_performance(c["order_items"], c["orders"], c["sellers"], c["reviews"])


A8_SQL = f"""
        SELECT state, people AS unique_customers, orders_n AS total_orders, {D('paid')} AS total_revenue,
               {R('paid / payments', 2)} AS avg_order_value, {R('days_mean', 1)} AS avg_delivery_days,
               {R('100 * on_time_mean', 2)} AS on_time_rate_pct, {R('score_mean', 2)} AS avg_review_score,
               {R('paid / nullif(people, 0)', 2)} AS revenue_per_customer
        FROM (SELECT state, count(DISTINCT customer_unique_id) AS people, count(DISTINCT order_id) AS orders_n,
                     sum(total_payment) AS paid, count(total_payment) AS payments, avg(delivery_days) AS days_mean,
                     avg(delivered_on_time) AS on_time_mean, avg(review_score) AS score_mean
              FROM paid_orders LEFT JOIN clean_reviews USING (order_id) GROUP BY ALL) AS by_state"""


@register("a8_geo_analysis", with_layers(A8_SQL))
def _a8(spark, d):
    c = clean(spark, d)
    return A.geo_analysis(c["customers"], c["orders"], c["payments"], c["reviews"])


A9_SQL = f"""
        SELECT {MONTH('o.purchased_at')} AS month, p.payment_types,
               count(DISTINCT o.order_id) AS total_orders,
               {D('sum(p.total_payment)')} AS total_revenue,
               {R('avg(p.total_payment)', 2)} AS avg_payment,
               {R('avg(p.payment_installments_count)', 1)} AS avg_installments
        {_DELIVERED_OP}
        GROUP BY 1, 2"""


@register("a9_payment_analysis", with_layers(A9_SQL))
def _a9(spark, d):
    c = clean(spark, d)
    return A.payment_analysis(c["orders"], c["payments"])


A10_SQL = """
        SELECT cohort_month, date_diff('month', cohort_month, month)::INTEGER AS months_since_first_order,
               count(*) AS active_customers
        FROM active_months GROUP BY ALL"""
A10_CTES = dict(active_months=f"""
        SELECT month, min(month) OVER (PARTITION BY customer_unique_id) AS cohort_month
        FROM (SELECT DISTINCT customer_unique_id, {MONTH('purchased_at')} AS month
              FROM clean_orders JOIN clean_customers USING (customer_id)
              WHERE order_status = 'delivered' AND customer_unique_id IS NOT NULL) AS seen""")


@register("a10_cohort_retention", with_layers(A10_SQL, **A10_CTES))
def _a10(spark, d):
    c = clean(spark, d)
    return A.cohort_retention(c["customers"], c["orders"])


# ------------------------------------------------------------------ load-time ETL

from orderlake.operators import etl as E  # noqa: E402
from orderlake.operators import lifecycle as L  # noqa: E402
from orderlake.operators import quality as Q  # noqa: E402
from orderlake.operators import reports as RP  # noqa: E402


def dirty(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return testdata.dirty_tables(spark, sf_dir)


_E1_SQL = """
        SELECT order_id, customer_id, order_status, order_purchase_timestamp FROM (
            SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY order_purchase_timestamp NULLS FIRST,
                                         customer_id NULLS FIRST, order_status NULLS FIRST) AS rn
            FROM raw_orders_dirty)
        WHERE rn = 1 AND order_id IS NOT NULL"""
_E2_SQL = """
        SELECT customer_id, customer_unique_id, customer_zip_code_prefix, customer_city, customer_state FROM (
            SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY customer_unique_id NULLS FIRST,
                                         customer_zip_code_prefix NULLS FIRST, customer_city NULLS FIRST,
                                         customer_state NULLS FIRST) AS rn
            FROM raw_customers_dirty)
        WHERE rn = 1 AND customer_unique_id IS NOT NULL"""


@register("e1_dedup_orders", with_layers(_E1_SQL))
def _e1(spark, d):
    return E.dedup_orders(dirty(spark, d)["raw_orders"])


@register("e2_dedup_customers", with_layers(_E2_SQL))
def _e2(spark, d):
    return E.dedup_customers(dirty(spark, d)["raw_customers"])


@register("e3_positive_payments", with_layers(
    "SELECT * REPLACE (CAST(payment_value AS DOUBLE) AS payment_value) FROM raw_order_payments"
    " WHERE payment_value > 0"))
def _e3(spark, d):
    return E.positive_payments(raw(spark, d)["raw_order_payments"])


@register("e4_payment_totals", with_layers(f"""
        SELECT order_id, {D('sum(payment_value)')} AS total_payment
        FROM raw_order_payments WHERE payment_value > 0 GROUP BY order_id"""))
def _e4(spark, d):
    return E.payment_totals(raw(spark, d)["raw_order_payments"])


@register("e5_item_totals", with_layers(f"""
        SELECT order_id, count(order_item_id) AS item_count, {D('sum(price)')} AS total_price
        FROM raw_order_items GROUP BY order_id"""))
def _e5(spark, d):
    return E.item_totals(raw(spark, d)["raw_order_items"])


@register("e6_load_profile", with_layers(f"""
        SELECT 'orders' AS table_name, (SELECT count(*) FROM raw_orders_dirty) AS rows_in,
               (SELECT count(*) FROM ({_E1_SQL})) AS rows_kept
        UNION ALL SELECT 'customers', (SELECT count(*) FROM raw_customers_dirty), (SELECT count(*) FROM ({_E2_SQL}))
        UNION ALL SELECT 'payments', (SELECT count(*) FROM raw_order_payments),
                         (SELECT count(*) FROM raw_order_payments WHERE payment_value > 0)
        UNION ALL SELECT 'items', (SELECT count(*) FROM raw_order_items), (SELECT count(*) FROM raw_order_items)"""))
def _e6(spark, d):
    r, x = raw(spark, d), dirty(spark, d)
    return E.load_profile(x["raw_orders"], x["raw_customers"], r["raw_order_payments"], r["raw_order_items"])


_E6_SQL = ORACLES["e6_load_profile"]


def _write_profiled(spark, d) -> dict[str, DataFrame]:
    r, x = raw(spark, d), dirty(spark, d)
    return E.write_profiled({"orders": x["raw_orders"], "customers": x["raw_customers"], "payments": r["raw_order_payments"],
                             "items": r["raw_order_items"]}, scratch(spark))


@register("e6_profile_while_writing", _E6_SQL)
def _e6_written(spark, d):
    return _write_profiled(spark, d)["profile"]


# ------------------------------------------------------------------ data quality

def _check(name: str, count_sql: str) -> str:
    return f"SELECT '{name}' AS check_name, n_rows, n_rows = 0 AS passed FROM (SELECT count(*) AS n_rows {count_sql})"


_Q1 = _check("orders_without_customer", "FROM raw_orders_dirty WHERE customer_id IS NULL")
_Q2 = _check("payments_not_positive", "FROM raw_order_payments WHERE payment_value <= 0")


def _q3(orders: str) -> str:
    return _check("delivered_without_payment", f"""FROM {orders} o
        LEFT JOIN raw_order_payments p ON o.order_id = p.order_id
        WHERE p.order_id IS NULL AND o.order_status = 'delivered'""")


@register("q1_orders_without_customer", with_layers(_Q1))
def _q1(spark, d):
    return Q.orders_missing_customer(dirty(spark, d)["raw_orders"])


@register("q2_payments_not_positive", with_layers(_Q2))
def _q2(spark, d):
    return Q.nonpositive_payments(raw(spark, d)["raw_order_payments"])


@register("q1_q2_while_writing", with_layers(f"{_Q1} UNION ALL {_Q2}"))
def _q12_written(spark, d):
    return _write_profiled(spark, d)["checks"]


@register("q3_delivered_without_payment", with_layers(_q3("raw_orders")))
def _q3q(spark, d):
    r = raw(spark, d)
    return Q.delivered_without_payment(r["raw_orders"], r["raw_order_payments"])


@register("q4_data_quality", with_layers(f"{_Q1} UNION ALL {_Q2} UNION ALL {_q3('raw_orders_dirty')}"))
def _q4(spark, d):
    return Q.data_quality(dirty(spark, d)["raw_orders"], raw(spark, d)["raw_order_payments"])


def order_headers(r: dict[str, DataFrame]) -> DataFrame:
    """Order-document header fields from the raw tables (first payment row)."""
    o, c, p = r["raw_orders"], r["raw_customers"], r["raw_order_payments"]
    first_pay = p.filter(F.col("payment_sequential") == 1).select(
        F.col("order_id").alias("_pid"), "payment_type", F.col("payment_value").cast("double").alias("payment_value"))
    h = o.join(c, "customer_id").join(first_pay, F.col("order_id") == F.col("_pid"), "left")
    return h.select("order_id", "customer_id", "customer_unique_id", "customer_city", "customer_state",
                    "order_status", F.col("order_purchase_timestamp").alias("purchased_at"),
                    F.col("order_estimated_delivery_date").alias("estimated_delivery_at"),
                    "payment_type", "payment_value")


_REQ = ["order_id", "customer_id", "customer_unique_id", "customer_city", "customer_state",
        "purchased_at", "payment_type", "payment_value"]
_Q5_REASONS = ",\n".join(
    [f"CASE WHEN h.{c} IS NULL THEN 'missing_{c}' END" for c in _REQ]
    + [f"CASE WHEN coalesce(i.m_{c}, false) THEN 'item_missing_{c}' END"
       for c in ["product_id", "seller_id", "price", "freight_value"]]
    + ["CASE WHEN coalesce(i.price_bad, false) THEN 'item_price_not_positive' END",
       "CASE WHEN coalesce(i.freight_bad, false) THEN 'item_freight_negative' END",
       "CASE WHEN h.payment_value <= 0 THEN 'payment_value_not_positive' END"])


_Q5_HDR = """
        SELECT o.order_id, o.customer_id, c.customer_unique_id, c.customer_city, c.customer_state,
               o.order_status, o.order_purchase_timestamp AS purchased_at, p.payment_type,
               CAST(p.payment_value AS DOUBLE) AS payment_value
        FROM raw_orders o JOIN raw_customers c ON o.customer_id = c.customer_id
        LEFT JOIN raw_order_payments p ON p.order_id = o.order_id AND p.payment_sequential = 1"""
_Q5_ITM = """
        SELECT order_id, bool_or(product_id IS NULL) AS m_product_id, bool_or(seller_id IS NULL) AS m_seller_id,
               bool_or(price IS NULL) AS m_price, bool_or(freight_value IS NULL) AS m_freight_value,
               bool_or(price <= 0) AS price_bad, bool_or(freight_value < 0) AS freight_bad
        FROM raw_order_items GROUP BY order_id"""


@register("q5_validate_orders", with_layers(f"""
        SELECT h.order_id, coalesce(h.order_status, 'processing') AS order_status,
               concat_ws(',', {_Q5_REASONS}) AS reasons
        FROM hdr h LEFT JOIN itm i ON h.order_id = i.order_id""", hdr=_Q5_HDR, itm=_Q5_ITM))
def _q5(spark, d):
    r = raw(spark, d)
    items = r["raw_order_items"].select("order_id", "product_id", "seller_id",
                                        F.col("price").cast("double").alias("price"),
                                        F.col("freight_value").cast("double").alias("freight_value"))
    v = Q.validate_order_rows(order_headers(r), items)
    return v.select("order_id", "order_status", F.array_join("reasons", ",").alias("reasons"))


# ------------------------------------------------------------------ order life cycle

import datetime as _dt  # noqa: E402

AS_OF = _dt.datetime(1998, 6, 1, 12, 0, 0)       # testdata era; warehouse uses the run time
LIFECYCLE_FLOOR = _dt.datetime(1996, 1, 1)       # warehouse default 2026-01-01


def _u(i: int) -> str:
    return f"CAST(CAST(('0x' || substr(md5(order_id), {8 * i + 1}, 8)) AS BIGINT) AS DOUBLE) / 4294967296.0"


_NOW = "TIMESTAMP '1998-06-01 12:00:00'"
_FLOOR = "TIMESTAMP '1996-01-01 00:00:00'"
_LIFECYCLE_CTES = dict(
    s1=f"""
        SELECT *, coalesce(order_status = 'processing' AND order_purchase_timestamp >= {_FLOOR}
                           AND order_purchase_timestamp <= {_NOW} - INTERVAL 15 MINUTE, false) AS shipped_now
        FROM raw_orders""",
    s2=f"""
        SELECT order_id, order_purchase_timestamp, order_estimated_delivery_date, shipped_now,
               order_delivered_customer_date,
               CASE WHEN shipped_now THEN 'shipped' ELSE order_status END AS order_status,
               CASE WHEN shipped_now THEN {_NOW} ELSE order_delivered_carrier_date END
                   AS order_delivered_carrier_date,
               CASE WHEN {_u(0)} < 0.90 THEN 0.65 + {_u(1)} * 0.30 ELSE 1.01 + {_u(2)} * 0.15 END AS f
        FROM s1""",
    s3=f"""
        SELECT *, coalesce(order_status = 'shipped' AND order_purchase_timestamp >= {_FLOOR}
                           AND order_purchase_timestamp <= {_NOW} - INTERVAL 45 MINUTE, false) AS delivered_now
        FROM s2""",
    advanced="""
        SELECT order_id, CASE WHEN delivered_now THEN 'delivered' ELSE order_status END AS order_status,
               order_delivered_carrier_date,
               CASE WHEN delivered_now THEN make_timestamp(epoch_us(order_purchase_timestamp) + CAST(round(
                   (epoch_us(order_estimated_delivery_date) - epoch_us(order_purchase_timestamp)) * f) AS BIGINT))
                    ELSE order_delivered_customer_date END AS order_delivered_customer_date,
               shipped_now, delivered_now
        FROM s3""")


def _advanced(spark, d):
    return L.advance_status(raw(spark, d)["raw_orders"], AS_OF, LIFECYCLE_FLOOR)


@register("l1_l2_advance_status", with_layers("SELECT * FROM advanced", **_LIFECYCLE_CTES))
def _l12(spark, d):
    return _advanced(spark, d).select("order_id", "order_status", "order_delivered_carrier_date",
                                      "order_delivered_customer_date", "shipped_now", "delivered_now")


@register("l3_status_summary", with_layers("""
        SELECT count(*) FILTER (WHERE shipped_now) AS shipped, count(*) FILTER (WHERE delivered_now) AS delivered
        FROM advanced""", **_LIFECYCLE_CTES))
def _l3(spark, d):
    return L.status_summary(_advanced(spark, d))


# ------------------------------------------------------------------ reports

D4_SINCE = _dt.datetime(2000, 1, 1)      # warehouse default 2026-01-01
D6_HIST, D6_SIM = 1998, 2000             # warehouse defaults 2018 / 2026
D7_LIMIT = 20.0                          # warehouse default 500
D8_MIN_ORDERS, D8_TOP, D9_TOP = 100, 20, 10
D17_TOP = 20

_MR = dict(kept_months=A2_BASE, mr=A2_SQL)


@register("d1_total_revenue", with_layers(f"SELECT {R('sum(revenue)', 2)} AS total_revenue FROM mr", **_MR))
def _d1(spark, d):
    c = clean(spark, d)
    m = A.monthly_revenue(c["orders"], c["payments"], min_orders=MIN_MONTH_ORDERS)
    return RP.total_revenue(m).select(F.round(F.col("total_revenue").cast("decimal(38,10)"), 2)
                                      .cast("double").alias("total_revenue"))


@register("d2_delivered_kpis", with_layers(f"""
        SELECT count(DISTINCT order_id) AS total_orders, {R('avg(total_payment)', 2)} AS avg_basket,
               {R('avg(delivery_days)', 1)} AS avg_delivery_days
        FROM clean_orders o JOIN clean_payments p USING (order_id)
        WHERE order_status = 'delivered' AND delivery_days IS NOT NULL AND delivery_days > 0"""))
def _d2(spark, d):
    c = clean(spark, d)
    return RP.delivered_kpis(c["orders"], c["payments"])


@register("d3_recent_orders", with_layers("""
        SELECT order_id, customer_id, order_status, order_purchase_timestamp FROM raw_orders
        ORDER BY order_purchase_timestamp DESC NULLS FIRST, order_id ASC NULLS LAST LIMIT 20"""))
def _d3(spark, d):
    return RP.recent_orders(raw(spark, d)["raw_orders"], 20)


@register("d4_status_counts", with_layers("""
        SELECT order_status, count(*) AS nb_commandes FROM raw_orders
        WHERE order_purchase_timestamp >= TIMESTAMP '2000-01-01 00:00:00' GROUP BY order_status"""))
def _d4(spark, d):
    return RP.status_counts(raw(spark, d)["raw_orders"], D4_SINCE)


@register("d6_revenue_eras", with_layers(f"""
        SELECT 'monthly' AS series, month AS period, revenue, revenue_growth_pct,
               CASE WHEN year(month) <= {D6_HIST} THEN 'historical' ELSE 'simulated' END AS era
        FROM mr WHERE year(month) <= {D6_HIST} OR year(month) >= {D6_SIM}
        UNION ALL
        SELECT 'daily', order_date, revenue, CAST(NULL AS DOUBLE),
               CASE WHEN year(order_date) <= {D6_HIST} THEN 'historical' ELSE 'simulated' END
        FROM dr WHERE year(order_date) <= {D6_HIST} OR year(order_date) >= {D6_SIM}""", dr=A1_SQL, **_MR))
def _d6(spark, d):
    c = clean(spark, d)
    m = A.monthly_revenue(c["orders"], c["payments"], min_orders=MIN_MONTH_ORDERS)
    return RP.revenue_eras(m, A.daily_revenue(c["orders"], c["payments"]), D6_HIST, D6_SIM)


@register("d7_growth_without_outliers", with_layers(
    f"SELECT * FROM mr WHERE revenue_growth_pct IS NOT NULL AND abs(revenue_growth_pct) < {D7_LIMIT}", **_MR))
def _d7(spark, d):
    c = clean(spark, d)
    m = A.monthly_revenue(c["orders"], c["payments"], min_orders=MIN_MONTH_ORDERS)
    return RP.growth_without_outliers(m, D7_LIMIT)


_D8_SQL = f"""
        SELECT category, total_orders, total_revenue, avg_price,
               (SELECT count(*) FROM tc WHERE total_orders >= {D8_MIN_ORDERS}) AS n_shown,
               (SELECT count(*) FROM tc) AS n_total
        FROM tc WHERE total_orders >= {D8_MIN_ORDERS}
        ORDER BY total_revenue DESC NULLS LAST, category ASC NULLS LAST LIMIT {D8_TOP}"""


def _d8_df(spark, d):
    return RP.top_categories_report(A.top_categories(clean(spark, d)["order_items"]), D8_MIN_ORDERS, D8_TOP)


@register("d8_top_categories", with_layers(_D8_SQL, tc=A4_SQL))
def _d8(spark, d):
    return _d8_df(spark, d)


@register("d9_top_categories_by_price", with_layers(f"""
        SELECT * FROM d8 ORDER BY total_revenue DESC NULLS LAST, category ASC NULLS LAST LIMIT {D9_TOP}""",
    tc=A4_SQL, d8=_D8_SQL))
def _d9(spark, d):
    return RP.top_categories_by_price(_d8_df(spark, d), D9_TOP)


@register("d10_state_table", with_layers("""
        SELECT state, total_orders, total_revenue, avg_delivery_days, on_time_rate_pct, avg_review_score,
               CAST(row_number() OVER (ORDER BY total_revenue DESC NULLS LAST, state ASC NULLS LAST) AS INTEGER)
                   AS revenue_order,
               CAST(row_number() OVER (ORDER BY on_time_rate_pct DESC NULLS LAST, state ASC NULLS LAST) AS INTEGER)
                   AS on_time_order
        FROM geo""", geo=A8_SQL))
def _d10(spark, d):
    c = clean(spark, d)
    return RP.state_table(A.geo_analysis(c["customers"], c["orders"], c["payments"], c["reviews"]))


@register("d11_client_kpis", with_layers(f"""
        SELECT count(DISTINCT c.customer_unique_id) AS total_clients, {R('avg(p.total_payment)', 2)} AS avg_basket
        FROM clean_customers c JOIN clean_orders o ON c.customer_id = o.customer_id
        JOIN clean_payments p ON o.order_id = p.order_id WHERE o.order_status = 'delivered'"""))
def _d11(spark, d):
    c = clean(spark, d)
    return RP.client_kpis(c["customers"], c["orders"], c["payments"])


def _clv(spark, d):
    c = clean(spark, d)
    return A.customer_lifetime_value(c["customers"], c["orders"], c["payments"])


@register("d12_repeat_rate", with_layers(f"""
        SELECT coalesce({R('count(*) FILTER (WHERE total_orders >= 2) * 100.0 / nullif(count(*), 0)', 4)}, 0.0)
            AS repeat_rate_pct FROM clv""", clv=A5_SQL))
def _d12(spark, d):
    return RP.repeat_rate(_clv(spark, d))


@register("d13_spending_bands", with_layers("""
        SELECT b.band_order, b.spending_range, coalesce(n, 0) AS count
        FROM (VALUES (1, '0-100 R$'), (2, '100-200 R$'), (3, '200-500 R$'), (4, '500-1000 R$'), (5, '1000+ R$'))
             AS b(band_order, spending_range)
        LEFT JOIN (
            SELECT CASE WHEN total_spent > 0 AND total_spent <= 100 THEN 1
                        WHEN total_spent > 100 AND total_spent <= 200 THEN 2
                        WHEN total_spent > 200 AND total_spent <= 500 THEN 3
                        WHEN total_spent > 500 AND total_spent <= 1000 THEN 4
                        WHEN total_spent > 1000 THEN 5 END AS band, count(*) AS n
            FROM clv GROUP BY 1) c ON b.band_order = c.band""", clv=A5_SQL))
def _d13(spark, d):
    return RP.spending_bands(_clv(spark, d))


@register("d14_orders_histogram", with_layers(
    "SELECT total_orders, count(*) AS n_customers FROM clv WHERE total_orders <= 10 GROUP BY 1", clv=A5_SQL))
def _d14(spark, d):
    return RP.orders_histogram(_clv(spark, d))


def _sp(spark, d):
    c = clean(spark, d)
    return A.seller_facts(c["order_items"], c["orders"], c["sellers"], c["reviews"])


@register("d15_seller_list", with_layers("""
        SELECT row_number() OVER (ORDER BY total_revenue DESC NULLS FIRST, seller_id ASC NULLS LAST) AS rank,
               seller_id, total_revenue, avg_review_score, on_time_rate_pct, total_orders, avg_delivery_days
        FROM sp""", sp=A7_SQL))
def _d15(spark, d):
    return RP.seller_list(_sp(spark, d))


@register("d16_seller_overview", with_layers(f"""
        SELECT count(*) AS n_sellers, {R('avg(avg_review_score)', 6)} AS mean_review_score,
               {R('avg(on_time_rate_pct)', 6)} AS mean_on_time_rate_pct FROM sp""", sp=A7_SQL))
def _d16(spark, d):
    return RP.seller_overview(_sp(spark, d))


@register("d17_top_sellers", with_layers(f"""
        SELECT seller_id, total_revenue, avg_review_score, on_time_rate_pct FROM sp
        ORDER BY total_revenue DESC NULLS FIRST, seller_id ASC LIMIT {D17_TOP}""", sp=A7_SQL))
def _d17(spark, d):
    return RP.top_sellers(_sp(spark, d), D17_TOP)


# ------------------------------------------------------------------ segmentation

from orderlake.operators import segments as M  # noqa: E402
from orderlake.functions.numeric import round_double  # noqa: E402

M11_SAMPLE = 5000
_FITS: dict[tuple[str, str], M.SegmentationFit] = {}


def _rfm(spark, d) -> DataFrame:
    r = raw(spark, d)
    return M.rfm_features(r["raw_customers"], r["raw_orders"], r["raw_order_payments"])


def _fit(spark, d) -> M.SegmentationFit:
    """K-Means fit for one session and scale factor, fitted once and reused by the reports."""
    key = (spark.sparkContext.applicationId, d)
    if key not in _FITS:
        _FITS[key] = M.fit_kmeans(_rfm(spark, d))
    return _FITS[key]


_SEGMENTS: dict[tuple[str, str], DataFrame] = {}


def _segments(spark, d) -> DataFrame:
    """The customer_segments table (M9), written once per session and scale factor."""
    key = (spark.sparkContext.applicationId, d)
    if key not in _SEGMENTS:
        fit = _fit(spark, d)
        _SEGMENTS[key] = M.assign_segments(fit.assigned, M.label_clusters(fit.assigned)).checkpoint(eager=True)
    return _SEGMENTS[key]


_M1_SQL = """
        SELECT customer_unique_id,
               CAST(date_diff('day', CAST(last_ts AS DATE), CAST((SELECT max(ts) FROM rfm_j) AS DATE)) AS INTEGER)
                   AS recency,
               frequency, CAST(monetary AS DOUBLE) AS monetary
        FROM (SELECT customer_unique_id, max(ts) AS last_ts, count(DISTINCT order_id) AS frequency,
                     sum(total_payment) AS monetary
              FROM rfm_j GROUP BY customer_unique_id)
        WHERE customer_unique_id IS NOT NULL AND last_ts IS NOT NULL AND monetary IS NOT NULL"""
_RFM_J = """
        SELECT c.customer_unique_id, o.order_id, o.order_purchase_timestamp AS ts, p.total_payment
        FROM raw_customers c JOIN raw_orders o ON c.customer_id = o.customer_id
        JOIN (SELECT order_id, sum(payment_value) AS total_payment FROM raw_order_payments GROUP BY order_id) p
          ON o.order_id = p.order_id
        WHERE o.order_status = 'delivered'"""


@register("m1_rfm_features", with_layers(_M1_SQL, rfm_j=_RFM_J))
def _m1(spark, d):
    return _rfm(spark, d)


def _z(c: str) -> str:
    return R(f"CASE WHEN (SELECT stddev_pop({c}) FROM rfm) = 0 THEN 0 ELSE ({c} - (SELECT avg({c}) FROM rfm))"
             f" / (SELECT stddev_pop({c}) FROM rfm) END", 6)


@register("m2_standardize", with_layers(f"""
        SELECT customer_unique_id, recency, frequency, monetary,
               {_z('recency')} AS recency_z, {_z('frequency')} AS frequency_z, {_z('monetary')} AS monetary_z
        FROM rfm""", rfm_j=_RFM_J, rfm=_M1_SQL))
def _m2(spark, d):
    z = M.standardize(_rfm(spark, d))
    return z.select("customer_unique_id", "recency", "frequency", "monetary",
                    *[round_double(f"{c}_z", 6).alias(f"{c}_z") for c in M.FEATURES])


@register("m3_kmeans_clusters")
def _m3(spark, d):
    return _fit(spark, d).assigned.select("customer_unique_id", *M.FEATURES, "cluster")


@register("m4_silhouette")
def _m4(spark, d):
    return M.silhouette(_fit(spark, d).assigned)


@register("m5_inertia")
def _m5(spark, d):
    return M.inertia(_fit(spark, d))


@register("m6_cluster_labels")
def _m6(spark, d):
    return M.label_clusters(_fit(spark, d).assigned)


@register("m7_segment_sizes")
def _m7(spark, d):
    return M.segment_sizes(_segments(spark, d))


@register("m8_run_metrics")
def _m8(spark, d):
    fit = _fit(spark, d)
    return M.run_metrics(fit, _segments(spark, d))


@register("m9_customer_segments")
def _m9(spark, d):
    return _segments(spark, d)


@register("m7_m9_saved_run", with_layers("""
        SELECT 'customers' AS what, CAST(count(*) AS DOUBLE) AS value, CAST(sum(recency) AS DOUBLE) AS detail FROM rfm
        UNION ALL SELECT 'segments', 4, (SELECT count(*) FROM rfm)
        UNION ALL SELECT 'n_clusters', 4, NULL UNION ALL SELECT 'n_customers', (SELECT count(*) FROM rfm), NULL
        UNION ALL SELECT 'other metrics: inertia, n_ of each segment, silhouette', 6, 1
        UNION ALL SELECT 'model clusters', 4, NULL""", rfm_j=_RFM_J, rfm=_M1_SQL))
def _m7_m9(spark, d):
    """A run written and read back: the segments, their sizes (M7), the metrics (M8) and the model (M9)."""
    root = _once(spark, d, "run", lambda root: M.save_run(_fit(spark, d), _segments(spark, d), root))
    segments, metrics, model = M.read_run(spark, root)
    sizes = M.segment_sizes(segments)
    none = F.lit(None).cast("double")
    named = F.col("metric").isin("n_clusters", "n_customers")
    per_segment = segments.select(F.concat(F.lit("n_"), F.regexp_replace("segment", " ", "_")).alias("metric")).distinct()
    others = metrics.filter(~named)
    known = per_segment.unionByName(spark.createDataFrame([("inertia",), ("silhouette_squared_euclidean",)], "metric string"))
    agree = others.join(sizes.select(F.concat(F.lit("n_"), F.regexp_replace("segment", " ", "_")).alias("metric"), "n_customers"), "metric", "left")
    return (segments.agg(F.lit("customers").alias("what"), F.count(F.lit(1)).cast("double").alias("value"), F.sum("recency").cast("double").alias("detail"))
            .unionByName(sizes.agg(F.lit("segments").alias("what"), F.count(F.lit(1)).cast("double").alias("value"), F.sum("n_customers").cast("double").alias("detail")))
            .unionByName(metrics.filter(named).select(F.col("metric").alias("what"), "value", none.alias("detail")))
            .unionByName(agree.join(known, "metric", "left_semi").agg(
                F.lit("other metrics: inertia, n_ of each segment, silhouette").alias("what"), F.count(F.lit(1)).cast("double").alias("value"),
                F.min((F.coalesce("n_customers", "value") == F.col("value")).cast("double")).alias("detail")))
            .unionByName(spark.range(1).select(F.lit("model clusters").alias("what"), F.lit(float(len(model.clusterCenters()))).alias("value"), none.alias("detail"))))


@register("m10_segment_profile")
def _m10(spark, d):
    return M.segment_profile(_segments(spark, d))


@register("d5_segment_bars")
def _d5(spark, d):
    return RP.segment_bars(M.segment_profile(_segments(spark, d)))


_M11_SQL = f"""
        SELECT * FROM rfm ORDER BY md5('42:' || customer_unique_id), customer_unique_id LIMIT {M11_SAMPLE}"""


@register("m11_sample_customers", with_layers(_M11_SQL, rfm_j=_RFM_J, rfm=_M1_SQL))
def _m11(spark, d):
    return M.sample_customers(_rfm(spark, d), M11_SAMPLE, 42)


def _cap(c: str) -> str:
    return f"least(CAST({c} AS DOUBLE), (SELECT quantile_cont(CAST({c} AS DOUBLE), 0.99) FROM smp)) AS {c}"


@register("m12_cap_outliers", with_layers(f"""
        SELECT customer_unique_id, {_cap('recency')}, {_cap('frequency')}, {_cap('monetary')} FROM smp""",
    rfm_j=_RFM_J, rfm=_M1_SQL, smp=_M11_SQL))
def _m12(spark, d):
    return M.cap_outliers(M.sample_customers(_rfm(spark, d), M11_SAMPLE, 42))


@register("m12_sketch_ranks", with_layers("""
        SELECT c AS column_name, CAST(q AS DOUBLE) AS q, (SELECT count(*) FROM rfm) AS n_values, true AS within_bound
        FROM (VALUES ('recency'), ('frequency'), ('monetary')) a(c), (VALUES (0.5), (0.99)) b(q)""", rfm_j=_RFM_J, rfm=_M1_SQL))
def _m12_ranks(spark, d):
    """The sketch's quantiles of all customers' features, held against their exact ranks."""
    rfm = _rfm(spark, d).withColumn("part", F.pmod(F.xxhash64("customer_unique_id"), F.lit(7)))
    states = M.quantile_states(rfm, ["part"])            # seven states, merged into one
    return M.sketch_rank_check(rfm, M.merge_states(states), (0.5, 0.99))


@register("m13_pca_projection")
def _m13(spark, d):
    segs = _segments(spark, d)
    return M.pca_projection(M.cap_outliers(M.sample_customers(segs, M11_SAMPLE, 42)))


# The clusters are arbitrary, so no SQL can refit them; these queries check what holds for any fit.

@register("m3_m5_fit_checks", with_layers("""
        SELECT count(*) AS n_people, 4 AS n_clusters, 0 AS not_at_nearest, true AS inertia_is_cost FROM rfm""",
    rfm_j=_RFM_J, rfm=_M1_SQL))
def _m3_m5(spark, d):
    fit = _fit(spark, d)
    return M.squared_distances(fit).agg(
        F.count(F.lit(1)).alias("n_people"), F.count_distinct("cluster").cast("int").alias("n_clusters"),
        F.count_if(F.col("own") > F.col("nearest") + 1e-9).cast("int").alias("not_at_nearest"),
        (F.abs(F.sum("own") - fit.cost) <= 1e-6 * fit.cost).alias("inertia_is_cost"))


@register("m6_m10_segment_checks", with_layers("""
        SELECT count(*) AS n_people, 4 AS n_segments, 0 AS other_medians, 0 AS other_bars FROM rfm""",
    rfm_j=_RFM_J, rfm=_M1_SQL))
def _m6_m10(spark, d):
    """Sizes, medians and bars of the segments against Spark's own exact percentiles of the written segments."""
    segments = _segments(spark, d)
    plain = segments.groupBy("segment").agg(F.count(F.lit(1)).alias("n"), *[F.percentile(c, 0.5).alias(f"{c}_p") for c in M.FEATURES])
    profile = M.segment_profile(segments)
    bars = RP.segment_bars(profile).select("segment", F.col("nb_clients").alias("n_bar"))
    both = plain.join(profile, "segment", "left").join(bars, "segment", "left")
    same = F.lit(True)
    for c in M.FEATURES:
        same = same & (F.abs(F.col(f"{c}_p") - F.col(f"{c}_med")) < 1e-5)
    return both.agg(F.sum("nb_clients").alias("n_people"), F.count(F.lit(1)).cast("int").alias("n_segments"),
                    F.count_if(~F.coalesce(same, F.lit(False))).cast("int").alias("other_medians"),
                    F.count_if(~F.coalesce(F.col("n_bar") == F.col("n"), F.lit(False))).cast("int").alias("other_bars"))


@register("m13_pca_checks", with_layers(f"""
        SELECT least(count(*), {M11_SAMPLE}) AS n_rows, true AS variances_match, true AS uncorrelated FROM rfm""",
    rfm_j=_RFM_J, rfm=_M1_SQL))
def _m13_checks(spark, d):
    """The shares of variance that the model states are those of its projection; the components are uncorrelated."""
    p = _m13(spark, d)
    n = F.count(F.lit(1))
    total = F.lit(float(len(M.FEATURES))) * n / (n - 1)   # of features scaled by their population deviation
    return p.agg(n.alias("n_rows"),
                 ((F.abs(F.var_samp("pc1") / total * 100 - F.max("pc1_variance_pct")) < 1e-6)
                  & (F.abs(F.var_samp("pc2") / total * 100 - F.max("pc2_variance_pct")) < 1e-6)).alias("variances_match"),
                 (F.abs(F.corr("pc1", "pc2")) < 1e-6).alias("uncorrelated"))


# ------------------------------------------------------------------ sources, sinks, layer runs

import uuid  # noqa: E402
from concurrent.futures import ThreadPoolExecutor  # noqa: E402

from orderlake.operators import ingest as IG  # noqa: E402
from orderlake.plans import layers as LY  # noqa: E402
from orderlake.session import checkpoint_dir  # noqa: E402
from orderlake.sources import files as FS  # noqa: E402
from orderlake.streaming import jobs as ST  # noqa: E402
from orderlake.streaming import refresh as RF  # noqa: E402
from orderlake.streaming import status as SS  # noqa: E402


def scratch(spark: SparkSession) -> str:
    """A fresh folder under the session's (shared) checkpoint directory."""
    return f"{checkpoint_dir(spark).rstrip('/')}/orderlake-scratch/{uuid.uuid4().hex}"


@register("s1_read_raw_csv", with_layers("SELECT * FROM raw_order_reviews"))
def _s1(spark, d):
    root = scratch(spark)
    r = raw(spark, d)
    for name in ("raw_order_reviews", "raw_orders"):
        FS.write_csv_table(r[name], f"{root}/{name}.csv")
    got = FS.read_raw(spark, root)          # the six absent files are skipped
    return got["raw_order_reviews"]


@register("s1_load_imperfect_csv", with_layers("""
        SELECT 'raw_order_payments' AS table_name, order_id AS record_id, CAST(payment_value AS DOUBLE) AS amount, NULL AS problem
        FROM raw_order_payments WHERE CAST(substr(order_id, 2) AS BIGINT) % 13 > 1
        UNION ALL SELECT 'raw_order_payments', NULL, NULL, 'payment_sequential one not a int; payment_value n/a not a decimal(18,2)'
        FROM raw_order_payments WHERE CAST(substr(order_id, 2) AS BIGINT) % 13 = 0
        UNION ALL SELECT 'raw_order_payments', NULL, NULL, 'payment_value n/a not a decimal(18,2)'
        FROM raw_order_payments WHERE CAST(substr(order_id, 2) AS BIGINT) % 13 = 1
        UNION ALL SELECT 'raw_order_reviews', review_id, review_score, NULL
        FROM raw_order_reviews WHERE CAST(substr(review_id, 2) AS BIGINT) % 11 > 0
        UNION ALL SELECT 'raw_order_reviews', NULL, NULL, 'review_creation_date soon not a timestamp_ntz'
        FROM raw_order_reviews WHERE CAST(substr(review_id, 2) AS BIGINT) % 11 = 0"""))
def _s1_load(spark, d):
    """Payments and reviews written as CSV with wrong numbers and dates in some rows; good rows and rejects together."""
    root, r = scratch(spark), raw(spark, d)
    number = F.substring("order_id", 2, 20).cast("bigint") % 13
    payments = r["raw_order_payments"]
    FS.write_csv_table(payments.withColumn("payment_value", F.when(number < 2, F.lit("n/a")).otherwise(F.col("payment_value").cast("string")))
                       .withColumn("payment_sequential", F.when(number == 0, F.lit("one")).otherwise(F.col("payment_sequential").cast("string"))),
                       f"{root}/raw_order_payments.csv")
    late = F.substring("review_id", 2, 20).cast("bigint") % 11 == 0
    FS.write_csv_table(r["raw_order_reviews"].withColumn("review_creation_date", F.when(late, F.lit("soon")).otherwise(F.col("review_creation_date").cast("string"))),
                       f"{root}/raw_order_reviews.csv")
    tables, rejects = FS.load_raw(spark, root, f"{root}/loaded")
    none = F.lit(None).cast("string")
    out = rejects.select("table_name", none.alias("record_id"), F.lit(None).cast("double").alias("amount"), F.array_join(
        F.transform("problems", lambda p: F.concat_ws(" ", p["column"], p["value"], p["reason"])), "; ").alias("problem"))
    for name, key, amount in (("raw_order_payments", "order_id", "payment_value"), ("raw_order_reviews", "review_id", "review_score")):
        out = out.unionByName(tables[name].select(F.lit(name).alias("table_name"), F.col(key).alias("record_id"), F.col(amount).cast("double").alias("amount"), none.alias("problem")))
    return out


_COUNT_TABLES = {
    "clean": ["orders", "order_items", "customers", "payments", "reviews", "products", "sellers"],
    "analytics": ["daily_revenue", "monthly_revenue", "top_products", "top_categories",
                  "customer_lifetime_value", "kpi_summary", "seller_performance", "geo_analysis",
                  "payment_analysis", "cohort_retention"],
}
_ANALYTICS_SQL = {"daily_revenue": A1_SQL, "monthly_revenue": A2_SQL, "top_products": A3_SQL,
                  "top_categories": A4_SQL, "customer_lifetime_value": A5_SQL, "kpi_summary": A6_SQL,
                  "seller_performance": A7_SQL, "geo_analysis": A8_SQL, "payment_analysis": A9_SQL}


def _s7_oracle() -> str:
    parts = [f"SELECT 'clean' AS layer, '{t}' AS table_name, count(*) AS n_rows FROM clean_{t}"
             for t in _COUNT_TABLES["clean"]]
    parts += [f"SELECT 'analytics', '{t}', count(*) FROM an_{t}" for t in _COUNT_TABLES["analytics"]]
    parts.append("SELECT 'quality', 'checks', 3")
    ctes = {f"an_{t}": sql for t, sql in _ANALYTICS_SQL.items()}
    ctes["an_cohort_retention"] = A10_SQL
    return with_layers("\nUNION ALL ".join(parts), kept_months=A2_BASE, **A10_CTES, **ctes)


@register("s7_run_layers", _s7_oracle())
def _s7(spark, d):
    return LY.run_full_refresh(spark, raw(spark, d), scratch(spark), min_month_orders=MIN_MONTH_ORDERS)


def _docs(spark, d) -> DataFrame:
    return IG.orders_as_documents(raw(spark, d))


@register("s8_fan_out_items", with_layers("""
        SELECT order_id,
               CAST(row_number() OVER (PARTITION BY order_id ORDER BY order_item_id, product_id, seller_id,
                                       price, freight_value) AS INTEGER) AS order_item_id,
               product_id, seller_id, CAST(price AS DOUBLE) AS price, CAST(freight_value AS DOUBLE) AS freight_value
        FROM raw_order_items"""))
def _s8(spark, d):
    return IG.fan_out_orders(_docs(spark, d))["raw_order_items"]


@register("s9_order_summary", with_layers("""
        SELECT o.order_id, o.customer_id, o.order_status, o.order_purchase_timestamp AS purchased_at,
               coalesce(i.n, 0) AS total_items, CAST(p.payment_value AS DOUBLE) AS total_value
        FROM raw_orders o JOIN raw_customers c ON o.customer_id = c.customer_id
        LEFT JOIN raw_order_payments p ON p.order_id = o.order_id AND p.payment_sequential = 1
        LEFT JOIN (SELECT order_id, count(*) AS n FROM raw_order_items GROUP BY order_id) i
          ON i.order_id = o.order_id"""))
def _s9(spark, d):
    s = IG.order_summary(_docs(spark, d))
    return s.select("order_id", "customer_id", "order_status",
                    F.col("purchased_at").cast("timestamp_ntz").alias("purchased_at"),
                    F.col("total_items").cast("bigint").alias("total_items"), "total_value")


# ------------------------------------------------------------------ streaming

_VALID_CTES = dict(hdr=_Q5_HDR, itm=_Q5_ITM)
_VALID_CTES["v"] = f"""
        SELECT h.order_id, concat_ws(',', {_Q5_REASONS}) AS reasons
        FROM hdr h LEFT JOIN itm i ON h.order_id = i.order_id"""


_SINKS: dict[tuple[str, str], str] = {}


def _ingest(spark, d) -> str:
    """Run the ingest stream once per session and scale factor; returns its sink folder."""
    key = (spark.sparkContext.applicationId, d)
    if key not in _SINKS:
        root = scratch(spark)
        _docs(spark, d).write.option("compression", "gzip").json(f"{root}/source")
        q = ST.start_order_ingest(spark, f"{root}/source", f"{root}/sink", f"{root}/checkpoint")
        q.awaitTermination()
        _SINKS[key] = f"{root}/sink"
    return _SINKS[key]


@register("st1_ingest_orders", with_layers("""
        SELECT 'raw_orders' AS table_name, order_id, customer_id AS detail, CAST(NULL AS DOUBLE) AS amount FROM hdr
        WHERE order_id IN (SELECT order_id FROM v WHERE reasons = '')
        UNION ALL SELECT 'raw_customers', customer_id, customer_unique_id, NULL FROM hdr
        WHERE order_id IN (SELECT order_id FROM v WHERE reasons = '')
        UNION ALL SELECT 'raw_order_payments', order_id, payment_type, payment_value FROM hdr
        WHERE order_id IN (SELECT order_id FROM v WHERE reasons = '')
        UNION ALL SELECT 'raw_order_items', order_id, product_id, CAST(price AS DOUBLE) FROM raw_order_items
        WHERE order_id IN (SELECT order_id FROM v WHERE reasons = '')
        UNION ALL SELECT 'rejects', order_id, NULL, NULL FROM v WHERE reasons <> ''""", **_VALID_CTES))
def _st1(spark, d):
    """The ingested rows after a second run with a new checkpoint that reads all documents again."""
    sink = _ingest(spark, d)
    root = sink.rsplit("/", 1)[0]
    ST.start_order_ingest(spark, f"{root}/source", sink, f"{root}/checkpoint-{uuid.uuid4().hex}").awaitTermination()
    none = F.lit(None)
    shown = {"raw_orders": ("order_id", F.col("customer_id"), none), "raw_customers": ("customer_id", F.col("customer_unique_id"), none),
             "raw_order_payments": ("order_id", F.col("payment_type"), F.col("payment_value")),
             "raw_order_items": ("order_id", F.col("product_id"), F.col("price")), "rejects": ("order_id", none, none)}
    out = None
    for name, (key, detail, amount) in shown.items():
        rows = ST.read_ingested(spark, sink, name).select(F.lit(name).alias("table_name"), F.col(key).alias("order_id"),
                                                          detail.cast("string").alias("detail"), amount.cast("double").alias("amount"))
        out = rows if out is None else out.unionByName(rows)
    return out


@register("st1_rejects_and_repeats", with_layers("""
        SELECT 'raw_orders' AS table_name, order_id, CAST(1 AS BIGINT) AS n_rows FROM v WHERE reasons = ''
        UNION ALL SELECT 'rejects', CASE WHEN c = 1 THEN NULL ELSE order_id END,
               sum(CASE WHEN c > 0 OR reasons <> '' THEN 1 ELSE 0 END)::BIGINT
        FROM v CROSS JOIN (VALUES (0), (1), (2), (3)) k(c)
        WHERE c = 0 OR (CAST(substr(order_id, 2) AS BIGINT) % 4 = c AND (c < 3 OR reasons <> ''))
        GROUP BY 2 HAVING sum(CASE WHEN c > 0 OR reasons <> '' THEN 1 ELSE 0 END) > 0""", **_VALID_CTES))
def _st1_rejects(spark, d):
    """All documents, and second copies of three quarters of them: without an id, with a negative payment, unchanged."""
    def build(root: str) -> None:
        docs = _docs(spark, d)
        turn = F.substring("order_id", 2, 20).cast("bigint") % 4
        copied = docs.withColumn("_turn", turn).withColumn("_copy", F.explode(F.when(turn > 0, F.array(F.lit(0), F.col("_turn"))).otherwise(F.array(F.lit(0))))) \
            .withColumn("payment_value", F.when(F.col("_copy") == 2, F.lit(-1.0)).otherwise(F.col("payment_value"))) \
            .withColumn("order_id", F.when(F.col("_copy") != 1, F.col("order_id")))
        copied.drop("_turn", "_copy").write.option("compression", "gzip").json(f"{root}/source")
        ST.start_order_ingest(spark, f"{root}/source", f"{root}/sink", f"{root}/checkpoint").awaitTermination()

    sink = f"{_once(spark, d, 'rejects', build)}/sink"
    out = None
    for name in ("raw_orders", "rejects"):
        rows = ST.read_ingested(spark, sink, name).groupBy("order_id").agg(F.count(F.lit(1)).alias("n_rows"))
        rows = rows.select(F.lit(name).alias("table_name"), "order_id", "n_rows")
        out = rows if out is None else out.unionByName(rows)
    return out


@register("st4_advance_ingested", with_layers("""
        SELECT order_id, order_status, CASE WHEN shipped_now THEN order_delivered_carrier_date END AS order_delivered_carrier_date
        FROM advanced WHERE order_id IN (SELECT order_id FROM v WHERE reasons = '')""", **_LIFECYCLE_CTES, **_VALID_CTES))
def _st4(spark, d):
    """Two cycles, the second a second later: what shipped in the first keeps its date (documents carry none themselves)."""
    sink = _ingest(spark, d)
    status = f"{sink.rsplit('/', 1)[0]}/status-{uuid.uuid4().hex}"
    SS.advance_ingested(spark, sink, status, AS_OF, LIFECYCLE_FLOOR)
    SS.advance_ingested(spark, sink, status, AS_OF + _dt.timedelta(seconds=1), LIFECYCLE_FLOOR)
    return SS.read_status(spark, status, sink).select("order_id", "order_status", "order_delivered_carrier_date")


def _event_files(spark, d) -> str:
    root = scratch(spark)
    testdata.load(spark, d, "events").write.parquet(f"{root}/events")
    return root


@register("st2_stream_dedup_events", with_layers(
    "SELECT event_id, ts, user_id, event_type, value, props FROM events"))
def _st2(spark, d):
    root = _event_files(spark, d)
    # the same events arrive a second time: a replayed file
    testdata.load(spark, d, "events").write.parquet(f"{root}/events_replay")
    schema = testdata.load(spark, d, "events").schema
    src = spark.readStream.schema(schema).parquet(f"{root}/events")
    src2 = spark.readStream.schema(schema).parquet(f"{root}/events_replay")
    deduped = ST.dedup_stream(src.unionByName(src2), "event_id", "ts")
    ST.run_to_parquet(deduped, f"{root}/out", f"{root}/checkpoint")
    out = spark.read.parquet(f"{root}/out")
    return out.select("event_id", F.col("ts").cast("timestamp_ntz").alias("ts"), "user_id", "event_type",
                      "value", "props")


@register("st3_stream_daily_revenue", with_layers(f"""
        SELECT CAST(date_trunc('day', ts) AS TIMESTAMP) AS window_start,
               CAST(date_trunc('day', ts) AS TIMESTAMP) + INTERVAL 1 DAY AS window_end,
               {R('sum(value)', 6)} AS revenue, count(*) AS n_rows
        FROM events GROUP BY 1, 2"""))
def _st3(spark, d):
    root = _event_files(spark, d)
    src = spark.readStream.schema(testdata.load(spark, d, "events").schema).parquet(f"{root}/events")
    ST.run_to_parquet(ST.daily_revenue_stream(src, "ts", "value"), f"{root}/out", f"{root}/checkpoint",
                      output_mode="update")
    final = ST.latest_per_key(spark.read.parquet(f"{root}/out"), ["window_start", "window_end"])
    return final.select(F.col("window_start").cast("timestamp_ntz").alias("window_start"),
                        F.col("window_end").cast("timestamp_ntz").alias("window_end"),
                        round_double("revenue", 6).alias("revenue"), "n_rows")


ST5_BATCH_FROM = _dt.datetime(1998, 1, 1)   # orders from here on arrive as the new batch


def _order_facts(spark, d) -> DataFrame:
    c = clean(spark, d)
    return RF.order_facts(c["orders"], c["payments"], c["reviews"])


def _refreshed(spark, d) -> dict[str, DataFrame]:
    """The ST5 reports after two batches: the orders before a day, then the rest."""
    def build(root: str) -> None:
        facts, cut = _order_facts(spark, d), ntz_lit(ST5_BATCH_FROM)
        late = F.coalesce(F.col("purchased_at") >= cut, F.lit(True))
        for part in (~late, late):
            RF.refresh_reports(spark, root, RF.store_batch(spark, root, facts.filter(part)))

    return RF.read_reports(spark, _once(spark, d, "months", build), MIN_MONTH_ORDERS)


def _added(spark, d) -> dict[str, DataFrame]:
    """The ST5 reports from the states that five batches left; each batch brings again a part of the orders of the one before."""
    def build(root: str) -> None:
        _order_facts(spark, d).write.parquet(f"{root}-facts")   # the batches' source, built once
        facts = spark.read.parquet(f"{root}-facts")
        part = F.pmod(F.xxhash64("order_id"), F.lit(5))
        again = F.pmod(F.xxhash64("order_id", F.lit("again")), F.lit(3)) == 0
        for i in range(5):
            RF.add_batch(spark, root, facts.filter((part == i) | ((part == i - 1) & again)), i)

    return RF.state_reports(spark, _once(spark, d, "states", build), MIN_MONTH_ORDERS)


@register("st5_refresh_months", with_layers(A1_SQL))
def _st5(spark, d):
    return _refreshed(spark, d)["daily_revenue"]


@register("st5_refresh_monthly_revenue", with_layers(A2_SQL, kept_months=A2_BASE))
def _st5_a2(spark, d):
    return _refreshed(spark, d)["monthly_revenue"]


@register("st5_refresh_kpi_summary", with_layers(A6_SQL))
def _st5_a6(spark, d):
    return _refreshed(spark, d)["kpi_summary"]


@register("st5_refresh_payment_analysis", with_layers(A9_SQL))
def _st5_a9(spark, d):
    return _refreshed(spark, d)["payment_analysis"]


@register("st5_state_daily_revenue", with_layers(A1_SQL))
def _st5_state(spark, d):
    return _added(spark, d)["daily_revenue"]


@register("st5_state_monthly_revenue", with_layers(A2_SQL, kept_months=A2_BASE))
def _st5_state_a2(spark, d):
    return _added(spark, d)["monthly_revenue"]


@register("st5_state_kpi_summary", with_layers(A6_SQL))
def _st5_state_a6(spark, d):
    return _added(spark, d)["kpi_summary"]


@register("st5_state_payment_analysis", with_layers(A9_SQL))
def _st5_state_a9(spark, d):
    return _added(spark, d)["payment_analysis"]


# The label and profile logic (exact medians, average ranks on ties, score
# order, label map) checked against SQL on a deterministic grouping of the RFM
# features: the frequency tier (1, 2, 3, 4+ delivered orders) as the cluster id.

_TIER_TABLES: dict[tuple[str, str], tuple[DataFrame, DataFrame, DataFrame]] = {}


def _tier_tables(spark, d) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(tiers, labels, segments) on frequency tiers, computed once per session and scale factor."""
    key = (spark.sparkContext.applicationId, d)
    if key not in _TIER_TABLES:
        checkpoint_dir(spark)
        tiers = _rfm(spark, d).withColumn("cluster", (F.least(F.col("frequency"), F.lit(4)) - 1).cast("int")) \
            .checkpoint(eager=True)
        labels = M.label_clusters(tiers)
        _TIER_TABLES[key] = (tiers, labels, M.assign_segments(tiers, labels).checkpoint(eager=True))
    return _TIER_TABLES[key]


_TIER_CTES = dict(rfm_j=_RFM_J, rfm=_M1_SQL, tiers="""
        SELECT *, CAST(least(frequency, 4) - 1 AS INTEGER) AS cluster FROM rfm""", meds=f"""
        SELECT cluster, median(recency) AS recency_med, median(frequency) AS frequency_med,
               median(monetary) AS monetary_med FROM tiers GROUP BY cluster""", scored="""
        SELECT *, - (rank() OVER (ORDER BY recency_med) + (count(*) OVER (PARTITION BY recency_med) - 1) / 2.0)
                  + (rank() OVER (ORDER BY frequency_med) + (count(*) OVER (PARTITION BY frequency_med) - 1) / 2.0)
                  + (rank() OVER (ORDER BY monetary_med) + (count(*) OVER (PARTITION BY monetary_med) - 1) / 2.0)
                  AS score
        FROM meds""", labelled="""
        SELECT *, CAST(row_number() OVER (ORDER BY score DESC, cluster ASC) AS INTEGER) AS position FROM scored""",
    segs="""
        SELECT t.customer_unique_id, t.recency, t.frequency, t.monetary,
               CASE l.position WHEN 1 THEN 'Champions' WHEN 2 THEN 'Clients fidèles' WHEN 3 THEN 'A risque'
                               WHEN 4 THEN 'Inactifs' END AS segment
        FROM tiers t JOIN labelled l ON t.cluster = l.cluster""")


M4_SAMPLE = 400


@register("m4_euclidean_silhouette", with_layers(f"""
        SELECT {R('avg(CASE WHEN own_n = 1 THEN 0 ELSE (b - a) / nullif(greatest(a, b), 0) END)', 6)} AS silhouette, count(*) AS n_sample
        FROM (SELECT s.customer_unique_id, max(CASE WHEN s.cluster = g.cluster THEN g.n END) AS own_n,
                     max(CASE WHEN s.cluster = g.cluster THEN g.total / nullif(g.n - 1, 0) END) AS a,
                     min(CASE WHEN s.cluster <> g.cluster THEN g.total / g.n END) AS b
              FROM picked s JOIN (
                  SELECT p.customer_unique_id, t.cluster, count(*) AS n,
                         sum(sqrt((p.recency - t.recency) ** 2 + (p.frequency - t.frequency) ** 2 + (p.monetary - t.monetary) ** 2)) AS total
                  FROM picked p, tiers t GROUP BY 1, 2) g USING (customer_unique_id)
              GROUP BY 1) scored""", **_TIER_CTES, picked=f"""
        SELECT * FROM tiers ORDER BY md5('42:' || customer_unique_id), customer_unique_id LIMIT {M4_SAMPLE}"""))
def _m4_euclidean(spark, d):
    tiers = _tier_tables(spark, d)[0]
    return M.euclidean_silhouette(tiers, list(M.FEATURES), sample=M4_SAMPLE).select(round_double("silhouette", 6).alias("silhouette"), "n_sample")


@register("m6_labels_on_frequency_tiers", with_layers(f"""
        SELECT cluster, {R('recency_med', 6)} AS recency_med, {R('frequency_med', 6)} AS frequency_med,
               {R('monetary_med', 6)} AS monetary_med, score, position,
               CASE position WHEN 1 THEN 'Champions' WHEN 2 THEN 'Clients fidèles' WHEN 3 THEN 'A risque'
                             WHEN 4 THEN 'Inactifs' END AS segment
        FROM labelled""", **_TIER_CTES))
def _m6_tiers(spark, d):
    lab = _tier_tables(spark, d)[1]
    return lab.select("cluster", *[round_double(f"{c}_med", 6).alias(f"{c}_med") for c in M.FEATURES],
                      "score", F.col("position").cast("int").alias("position"), "segment")


@register("m10_profile_on_frequency_tiers", with_layers(f"""
        SELECT segment, count(*) AS nb_clients, {R('median(recency)', 6)} AS recency_med,
               {R('median(frequency)', 6)} AS frequency_med, {R('median(monetary)', 6)} AS monetary_med
        FROM segs GROUP BY segment""", **_TIER_CTES))
def _m10_tiers(spark, d):
    return M.segment_profile(_tier_tables(spark, d)[2])


# ------------------------------------------------------------------ S2 – S6 over the testdata

_RAW_NAMES = ["raw_orders", "raw_order_items", "raw_order_payments", "raw_order_reviews", "raw_customers",
              "raw_products", "raw_sellers", "raw_product_category_translation"]


def _column_checks_sql() -> str:
    """One row per raw table and column: rows, nulls, distinct values, and a sum over lengths, numbers or seconds."""
    def total(c: str, kind: T.DataType) -> str:
        if isinstance(kind, T.StringType):
            return f"sum(length({c}))"
        return f"sum(epoch({c})::BIGINT)" if isinstance(kind, T.TimestampNTZType) else f"sum({c})"

    return "\nUNION ALL ".join(
        f"SELECT '{t}' AS table_name, '{f.name}' AS column_name, count(*) AS n_rows, count(*) - count({f.name}) AS n_null,"
        f" count(DISTINCT {f.name}) AS n_distinct, CAST({total(f.name, f.dataType)} AS DOUBLE) AS total FROM {t}"
        for t in _RAW_NAMES for f in RAW_SCHEMAS[t].fields)


@register("s2_read_all_raw_csv", with_layers(_column_checks_sql()))
def _s2(spark, d):
    """All eight tables written as CSV and read back, compared column by column."""
    root = scratch(spark)
    r = raw(spark, d)
    tables = {name: r[name] for name in _RAW_NAMES}      # build plans on this thread
    with ThreadPoolExecutor(max_workers=4) as pool:      # independent writes as concurrent jobs
        list(pool.map(lambda n: FS.write_csv_table(tables[n], f"{root}/{n}.csv"), _RAW_NAMES))
    got = FS.read_raw(spark, root)

    def text(f: T.StructField):
        return (F.col(f.name) + 0.0 if isinstance(f.dataType, T.DoubleType) else F.col(f.name)).cast("string")   # -0.0 is 0.0

    def amount(kind: T.DataType):
        """What one value adds to its column's total."""
        if isinstance(kind, T.StringType):
            return F.length("value")
        return F.expr("timestampdiff(SECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', CAST(value AS TIMESTAMP_NTZ))") if isinstance(kind, T.TimestampNTZType) \
            else F.col("value").cast(kind)

    out = None
    for name in _RAW_NAMES:
        # All cells as (column, value) rows, counted: one short key a distinct value, whatever the table's width.
        fields = list(enumerate(RAW_SCHEMAS[name].fields))
        cells = got[name].select(F.explode(F.array(*[F.struct(F.lit(i).alias("at"), text(f).alias("value")) for i, f in fields])).alias("cell")).select("cell.*")
        counted = cells.groupBy("at", "value").agg(F.count(F.lit(1)).alias("n"))
        kinds = {str(f.dataType): [i for i, g in fields if g.dataType == f.dataType] for _, f in fields}
        types = {str(f.dataType): f.dataType for _, f in fields}
        adds = F.coalesce(*[F.sum(F.when(F.col("at").isin(kinds[k]), amount(types[k]) * F.col("n"))).cast("double") for k in kinds])
        each = counted.groupBy("at").agg(F.sum("n").alias("n_rows"), F.coalesce(F.sum(F.when(F.col("value").isNull(), F.col("n"))), F.lit(0)).alias("n_null"),
                                         F.count("value").alias("n_distinct"), adds.alias("total"))
        rows = each.agg(F.array(*[F.struct(   # a row a column, of an empty table too
            F.lit(f.name).alias("column_name"), *[F.coalesce(F.max(F.when(F.col("at") == i, F.col(c))), F.lit(0)).alias(c) for c in ("n_rows", "n_null", "n_distinct")],
            F.max(F.when(F.col("at") == i, F.col("total"))).alias("total")) for i, f in fields]).alias("checks")).select(F.lit(name).alias("table_name"), F.inline("checks"))
        out = rows if out is None else out.unionByName(rows)
    return out


@register("s3_s5_full_refresh", ORACLES["c4_clean_payments"])
def _s35(spark, d):
    root = scratch(spark)
    payments = clean(spark, d)["payments"]
    FS.write_table(payments, root, "payments")          # first load
    FS.write_table(payments, root, "payments")          # full refresh: a new complete version
    return FS.read_table(spark, root, "payments")


@register("s4_s6_catalog_sql", with_layers(f"""
        SELECT count(DISTINCT order_id) AS total_orders, {R('avg(total_payment)', 2)} AS avg_basket,
               {R('avg(delivery_days)', 1)} AS avg_delivery_days
        FROM clean_orders o JOIN clean_payments p USING (order_id)
        WHERE order_status = 'delivered' AND delivery_days IS NOT NULL AND delivery_days > 0"""))
def _s46(spark, d):
    root = scratch(spark)
    c = clean(spark, d)
    for name in ("orders", "payments"):
        FS.publish_table(spark, "orderlake_clean", name, FS.write_table(c[name], root, name))
    # the dashboard runs SQL text against the published tables
    return spark.sql("""
        SELECT count(DISTINCT order_id) AS total_orders,
               CAST(round(CAST(avg(total_payment) AS DECIMAL(38,10)), 2) AS DOUBLE) AS avg_basket,
               CAST(round(CAST(avg(delivery_days) AS DECIMAL(38,10)), 1) AS DOUBLE) AS avg_delivery_days
        FROM orderlake_clean.orders o JOIN orderlake_clean.payments p USING (order_id)
        WHERE order_status = 'delivered' AND delivery_days IS NOT NULL AND delivery_days > 0""")


@register("s5_kept_versions", with_layers("""
        SELECT 'newest' AS version, order_id, CAST(total_payment AS DOUBLE) AS total_payment FROM clean_payments
        UNION ALL SELECT 'leased', order_id, CAST(total_payment AS DOUBLE) FROM clean_payments WHERE total_payment > 100
        UNION ALL SELECT 'removed: 8', NULL, NULL"""))
def _s5_kept(spark, d):
    """Ten refreshes with a clean-up after each; a reader's lease on an early version keeps that one."""
    root, payments = scratch(spark), clean(spark, d)["payments"].select("order_id", "total_payment")
    FS.write_table(payments.filter("total_payment > 100"), root, "payments")
    leased, _ = FS.lease_version(spark, root, "payments")
    gone = 0
    for _ in range(9):
        FS.write_table(payments, root, "payments")
        gone += len(FS.remove_old_versions(spark, root, "payments", keep=1))
    told = {"newest": FS.read_table(spark, root, "payments"), "leased": spark.read.parquet(leased)}
    out = spark.createDataFrame([(f"removed: {gone}", None, None)], "version string, order_id string, total_payment double")
    for name, df in told.items():
        out = out.unionByName(df.select(F.lit(name).alias("version"), "order_id", F.col("total_payment").cast("double").alias("total_payment")))
    return out


_M10_TIERS_SQL = ORACLES["m10_profile_on_frequency_tiers"]


@register("d5_segment_bars_on_frequency_tiers", with_layers("""
        SELECT *,
               CAST(row_number() OVER (ORDER BY nb_clients DESC NULLS LAST, segment) AS INTEGER) AS order_by_size,
               CAST(row_number() OVER (ORDER BY monetary_med DESC NULLS LAST, segment) AS INTEGER)
                   AS order_by_monetary,
               CAST(row_number() OVER (ORDER BY recency_med ASC NULLS FIRST, segment) AS INTEGER)
                   AS order_by_recency,
               CAST(row_number() OVER (ORDER BY frequency_med DESC NULLS LAST, segment) AS INTEGER)
                   AS order_by_frequency
        FROM prof""", **_TIER_CTES, prof=f"""
        SELECT segment, count(*) AS nb_clients, {R('median(recency)', 6)} AS recency_med,
               {R('median(frequency)', 6)} AS frequency_med, {R('median(monetary)', 6)} AS monetary_med
        FROM segs GROUP BY segment"""))
def _d5_tiers(spark, d):
    return RP.segment_bars(M.segment_profile(_tier_tables(spark, d)[2]))
