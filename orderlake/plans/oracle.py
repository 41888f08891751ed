"""DuckDB SQL oracles for the registered queries.

Each oracle is written from the operator's specification in plain SQL, not
derived from the Spark code: it applies the same testdata → raw mapping
(FIXTURES.md §2), rebuilds the clean layer as SQL views, and computes the
report the way the warehouse SQL does — including the row-multiplying LEFT
JOIN of reviews that the Spark side reproduces with weights. Money leaves as
DOUBLE, averages are rounded through DECIMAL(38,10) (round half away from
zero), months are DATEs, NULL order is always spelled out.
"""

from __future__ import annotations


def R(expr: str, n: int) -> str:
    """ROUND(expr, n) of a number through DECIMAL(38,10), as DOUBLE."""
    return f"CAST(ROUND(CAST(({expr}) AS DECIMAL(38,10)), {n}) AS DOUBLE)"


def D(expr: str) -> str:
    return f"CAST(({expr}) AS DOUBLE)"


def MONTH(expr: str) -> str:
    return f"CAST(date_trunc('month', {expr}) AS DATE)"


def V(expr: str) -> str:
    return f"CAST({expr} AS VARCHAR)"


RAW = {
    "raw_orders": f"""
        SELECT concat('o', {V('o_orderkey')}) AS order_id,
               concat('c', {V('o_orderkey')}) AS customer_id,
               CASE WHEN o_orderstatus = 'F' THEN 'delivered'
                    WHEN o_orderstatus = 'O' THEN 'shipped'
                    WHEN o_orderstatus = 'P' AND o_orderpriority = '5-LOW' THEN 'canceled'
                    WHEN o_orderstatus = 'P' THEN 'processing' END AS order_status,
               o_orderdate + to_hours(CAST(o_orderkey % 24 AS INTEGER)) AS order_purchase_timestamp,
               o_orderdate + to_hours(CAST(o_orderkey % 24 + 1 AS INTEGER)) AS order_approved_at,
               CASE WHEN o_orderstatus IN ('F', 'O') THEN o_orderdate + to_days(2) END
                   AS order_delivered_carrier_date,
               CASE WHEN o_orderstatus = 'F' AND o_orderkey % 50 <> 0
                    THEN o_orderdate + to_days(CAST(5 + o_orderkey % 26 AS INTEGER)) + to_hours(6) END
                   AS order_delivered_customer_date,
               o_orderdate + to_days(20) AS order_estimated_delivery_date
        FROM orders""",
    "raw_orders_dirty": """
        SELECT CASE WHEN order_id = 'o0' THEN NULL ELSE order_id END AS order_id,
               CASE WHEN order_id IN ('o7', 'o11') THEN NULL ELSE customer_id END AS customer_id,
               order_status, order_purchase_timestamp
        FROM raw_orders
        UNION ALL
        SELECT order_id, customer_id, order_status, order_purchase_timestamp + to_hours(1)
        FROM raw_orders WHERE order_id LIKE 'o%5'""",
    "raw_customers": f"""
        SELECT concat('c', {V('o_orderkey')}) AS customer_id,
               concat('u', {V('o_custkey')}) AS customer_unique_id,
               lpad({V('1000 + o_custkey % 900')}, 5, '0') AS customer_zip_code_prefix,
               concat('city_', {V('c_nationkey')}, '_', CASE WHEN o_orderkey % 10 = 0 THEN '1' ELSE '0' END)
                   AS customer_city,
               n_name AS customer_state
        FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey""",
    "raw_customers_dirty": """
        SELECT customer_id,
               CASE WHEN customer_id IN ('c7', 'c11') THEN NULL ELSE customer_unique_id END AS customer_unique_id,
               customer_zip_code_prefix, customer_city, customer_state
        FROM raw_customers
        UNION ALL
        SELECT customer_id, customer_unique_id, customer_zip_code_prefix, customer_city || '_b', customer_state
        FROM raw_customers WHERE customer_id LIKE 'c%5'""",
    "raw_order_items": f"""
        SELECT concat('o', {V('l_orderkey')}) AS order_id,
               CAST(l_linenumber AS INTEGER) AS order_item_id,
               concat('p', {V('l_partkey')}) AS product_id,
               concat('s', {V('l_suppkey')}) AS seller_id,
               CAST(CASE WHEN l_discount >= 0.095 AND l_quantity <= 2 THEN 0 ELSE l_extendedprice END
                    AS DECIMAL(18,2)) AS price,
               CAST(l_quantity * 0.5 AS DECIMAL(18,2)) AS freight_value
        FROM lineitem""",
    "raw_order_payments": f"""
        SELECT concat('o', {V('k')}) AS order_id, CAST(seq AS INTEGER) AS payment_sequential,
               ptype AS payment_type,
               CAST(CAST(cents AS DECIMAL(18,2)) * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(18,2)) AS payment_value
        FROM (
            SELECT k, 1 AS seq,
                   CASE prio WHEN '1-URGENT' THEN 'voucher' WHEN '2-HIGH' THEN 'debit_card'
                             WHEN '5-LOW' THEN 'boleto' ELSE 'credit_card' END AS ptype,
                   CASE WHEN prio = '1-URGENT' THEN least(c, 2000) ELSE c END AS cents
            FROM pay_base
            UNION ALL SELECT k, 2, 'credit_card', greatest(c - 2000, 0) FROM pay_base WHERE prio = '1-URGENT'
            UNION ALL SELECT k, 2, 'voucher', 0 FROM pay_base WHERE prio = '2-HIGH'
        )""",
    "raw_order_reviews": f"""
        SELECT concat('r', {V('event_id')}) AS review_id,
               concat('o', {V('CASE WHEN event_id % 7 = 1 THEN event_id - 1 ELSE event_id END')}) AS order_id,
               CAST(1 + event_id % 6 AS INTEGER) AS review_score,
               CAST(NULL AS VARCHAR) AS review_comment_title,
               CASE WHEN event_type IN ('click', 'error') THEN NULL
                    WHEN event_type = 'view' THEN '   ' ELSE props END AS review_comment_message,
               ts AS review_creation_date,
               ts + to_days(1) AS review_answer_timestamp
        FROM events""",
    "raw_products": f"""
        SELECT concat('p', {V('p_partkey')}) AS product_id,
               CASE WHEN p_brand = 'Brand#1' THEN NULL ELSE p_type END AS product_category_name,
               CAST(p_size * 100 AS DOUBLE) AS product_weight_g,
               CAST(nullif(p_size % 10, 0) AS DOUBLE) AS product_length_cm,
               CAST(p_size AS DOUBLE) AS product_height_cm,
               CAST(p_size + 1 AS DOUBLE) AS product_width_cm,
               CAST(nullif(p_size % 5, 0) AS INTEGER) AS product_photos_qty
        FROM part""",
    "raw_sellers": f"""
        SELECT concat('s', {V('s_suppkey')}) AS seller_id,
               lpad({V('s_suppkey')}, 5, '0') AS seller_zip_code_prefix,
               concat('city_', {V('s_nationkey')}) AS seller_city,
               n_name AS seller_state
        FROM supplier JOIN nation ON s_nationkey = n_nationkey""",
    "raw_product_category_translation": """
        SELECT product_category_name, lower(product_category_name) AS product_category_name_english
        FROM (SELECT DISTINCT p_type AS product_category_name FROM part ORDER BY 1 LIMIT 4)""",
}

# Formulated from the inventory's column definitions: NULL-propagating arithmetic
# and comparisons, lookups and pre-aggregates instead of CASE ladders.
_DAY = 86400

CLEAN = {
    "clean_orders": f"""
        SELECT order_id, customer_id, order_status, bought AS purchased_at, approved AS approved_at,
               handed AS shipped_at, arrived AS delivered_at, due AS estimated_delivery_at,
               coalesce((arrived <= due)::INTEGER, 0) AS delivered_on_time,
               trunc((epoch(arrived) - epoch(bought)) / {_DAY})::INTEGER AS delivery_days
        FROM (SELECT order_id, customer_id, order_status,
                     order_purchase_timestamp::TIMESTAMP AS bought, order_approved_at::TIMESTAMP AS approved,
                     order_delivered_carrier_date::TIMESTAMP AS handed,
                     order_delivered_customer_date::TIMESTAMP AS arrived,
                     order_estimated_delivery_date::TIMESTAMP AS due
              FROM raw_orders) timed
        WHERE order_id IS NOT NULL""",
    "named_products": """
        SELECT raw_products.*, ifnull(english.product_category_name_english, raw_products.product_category_name) AS shown
        FROM raw_products LEFT JOIN raw_product_category_translation AS english USING (product_category_name)""",
    "clean_order_items": """
        SELECT line.*, line.price + line.freight_value AS total_item_value,
               named.product_category_name, named.shown AS category_english,
               named.product_weight_g, named.product_length_cm, named.product_height_cm, named.product_width_cm
        FROM (FROM raw_order_items SELECT order_id, order_item_id, product_id, seller_id, price, freight_value
              WHERE price > 0 AND order_id IS NOT NULL) AS line
        LEFT JOIN named_products AS named USING (product_id)""",
    "clean_customers": """
        SELECT customer_id, customer_unique_id, customer_zip_code_prefix AS zip_code,
               customer_city AS city, customer_state AS state
        FROM raw_customers WHERE customer_id IS NOT NULL""",
    "clean_payments": """
        SELECT order_id, sum(times)::BIGINT AS payment_installments_count, sum(paid) AS total_payment,
               array_to_string(list_sort(list(payment_type)), ', ') AS payment_types
        FROM (SELECT order_id, payment_type, count(*) AS times, sum(payment_value) AS paid
              FROM raw_order_payments WHERE payment_value > 0 GROUP BY ALL) AS by_type
        WHERE order_id IS NOT NULL GROUP BY order_id""",
    "clean_reviews": """
        SELECT review_id, order_id, review_score,
               ifnull(review_comment_title, '') AS review_title, ifnull(review_comment_message, '') AS review_message,
               (ifnull(trim(review_comment_message), '') <> '')::INTEGER AS has_comment,
               review_creation_date::TIMESTAMP AS created_at, review_answer_timestamp::TIMESTAMP AS answered_at,
               ['negative', 'negative', 'neutral', 'positive', 'positive'][review_score] AS sentiment
        FROM raw_order_reviews
        WHERE review_score IN (1, 2, 3, 4, 5) AND (review_id || order_id) IS NOT NULL""",
    "clean_products": """
        SELECT product_id, ifnull(shown, 'unknown') AS category, product_category_name AS category_pt,
               product_weight_g, product_length_cm, product_height_cm, product_width_cm,
               product_length_cm * product_height_cm * product_width_cm AS volume_cm3,
               ifnull(product_photos_qty, 0) AS photos_count
        FROM named_products WHERE product_id IS NOT NULL""",
    "clean_sellers": """
        SELECT seller_id, seller_zip_code_prefix AS zip_code, seller_city AS city, seller_state AS state
        FROM raw_sellers WHERE seller_id IS NOT NULL""",
    # Delivered order lines, once for each review row of their order (once where it has none).
    "sold_lines": """
        SELECT line.order_id, line.product_id, line.seller_id, line.price, line.category_english,
               done.delivery_days, done.delivered_on_time, said.review_score
        FROM clean_order_items AS line
        JOIN (FROM clean_orders WHERE order_status = 'delivered') AS done USING (order_id)
        LEFT JOIN clean_reviews AS said USING (order_id)""",
    "product_sales": """
        SELECT category_english, product_id, sum(price) AS sold, avg(price) AS price_mean, avg(review_score) AS score_mean,
               count(DISTINCT seller_id) AS sellers_n, count(DISTINCT order_id) AS orders_n
        FROM sold_lines GROUP BY ALL""",
    "seller_sales": """
        SELECT place.seller_id, place.city, place.state, sum(price) AS sold, avg(price) AS price_mean,
               avg(review_score) AS score_mean, avg(delivery_days) AS days_mean, avg(delivered_on_time) AS on_time_mean,
               count(DISTINCT product_id) AS products_n, count(DISTINCT order_id) AS orders_n
        FROM clean_sellers AS place JOIN sold_lines USING (seller_id) GROUP BY ALL""",
    # Paid and delivered orders with their buyer.
    "paid_orders": """
        SELECT done.*, paid.total_payment, buyer.customer_unique_id, buyer.state
        FROM (FROM clean_orders WHERE order_status = 'delivered') AS done
        JOIN clean_payments AS paid USING (order_id)
        JOIN clean_customers AS buyer USING (customer_id)""",
}

_PAY_BASE = """
        SELECT o_orderkey AS k, o_orderpriority AS prio, CAST(floor(o_totalprice) AS BIGINT) % 50000 AS c
        FROM orders WHERE o_orderkey % 97 <> 0"""


def with_layers(final: str, **extra: str) -> str:
    """Prefix a final SELECT with the raw and clean views (plus extra CTEs)."""
    ctes = {"pay_base": _PAY_BASE, **RAW, **CLEAN, **extra}
    body = ",\n".join(f"{name} AS ({sql}\n)" for name, sql in ctes.items())
    return f"WITH {body}\n{final}"
