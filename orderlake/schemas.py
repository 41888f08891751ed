"""Declared schemas of the raw input contract and the order document.

The raw tables are never inferred: zip prefixes stay strings (leading zeros),
timestamps are TIMESTAMP_NTZ, money is DECIMAL(18,2).
"""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = T.DecimalType(18, 2)
TS = T.TimestampNTZType()
S = T.StringType()


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


RAW_ORDERS = _struct(
    ("order_id", S), ("customer_id", S), ("order_status", S),
    ("order_purchase_timestamp", TS), ("order_approved_at", TS),
    ("order_delivered_carrier_date", TS), ("order_delivered_customer_date", TS),
    ("order_estimated_delivery_date", TS),
)

RAW_ORDER_ITEMS = _struct(
    ("order_id", S), ("order_item_id", T.IntegerType()), ("product_id", S),
    ("seller_id", S), ("price", MONEY), ("freight_value", MONEY),
)

RAW_ORDER_PAYMENTS = _struct(
    ("order_id", S), ("payment_sequential", T.IntegerType()), ("payment_type", S),
    ("payment_value", MONEY),
)

RAW_ORDER_REVIEWS = _struct(
    ("review_id", S), ("order_id", S), ("review_score", T.IntegerType()),
    ("review_comment_title", S), ("review_comment_message", S),
    ("review_creation_date", TS), ("review_answer_timestamp", TS),
)

RAW_CUSTOMERS = _struct(
    ("customer_id", S), ("customer_unique_id", S), ("customer_zip_code_prefix", S),
    ("customer_city", S), ("customer_state", S),
)

RAW_PRODUCTS = _struct(
    ("product_id", S), ("product_category_name", S), ("product_weight_g", T.DoubleType()),
    ("product_length_cm", T.DoubleType()), ("product_height_cm", T.DoubleType()),
    ("product_width_cm", T.DoubleType()), ("product_photos_qty", T.IntegerType()),
)

RAW_SELLERS = _struct(
    ("seller_id", S), ("seller_zip_code_prefix", S), ("seller_city", S), ("seller_state", S),
)

RAW_CATEGORY_TRANSLATION = _struct(
    ("product_category_name", S), ("product_category_name_english", S),
)

RAW_SCHEMAS: dict[str, T.StructType] = {
    "raw_orders": RAW_ORDERS,
    "raw_order_items": RAW_ORDER_ITEMS,
    "raw_order_payments": RAW_ORDER_PAYMENTS,
    "raw_order_reviews": RAW_ORDER_REVIEWS,
    "raw_customers": RAW_CUSTOMERS,
    "raw_products": RAW_PRODUCTS,
    "raw_sellers": RAW_SELLERS,
    "raw_product_category_translation": RAW_CATEGORY_TRANSLATION,
}

# One incoming order document (the nested form the ingest stream carries).
ORDER_ITEM = _struct(
    ("product_id", S), ("seller_id", S), ("price", T.DoubleType()), ("freight_value", T.DoubleType()),
)

ORDER_DOCUMENT = _struct(
    ("order_id", S), ("customer_id", S), ("customer_unique_id", S),
    ("customer_city", S), ("customer_state", S), ("order_status", S),
    ("purchased_at", T.TimestampType()), ("estimated_delivery_at", T.TimestampType()),
    ("items", T.ArrayType(ORDER_ITEM)), ("payment_type", S), ("payment_value", T.DoubleType()),
)
