"""Clean layer: seven tables derived from the raw contract.

Each function reads only raw tables. Orders, customers and sellers are
row-wise projections; payments are reduced to one row per order (map-side
partial aggregation, one shuffle on order_id); items and products join the
product and category dimensions. The clean layer deliberately keeps duplicate
raw rows (only the load-time ETL deduplicates).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlake.functions.dates import whole_days


def clean_orders(raw_orders: DataFrame) -> DataFrame:
    """Typed order timestamps, on-time flag and whole delivery days; all statuses kept."""
    purchased = F.col("order_purchase_timestamp").cast("timestamp_ntz")
    delivered = F.col("order_delivered_customer_date").cast("timestamp_ntz")
    estimated = F.col("order_estimated_delivery_date").cast("timestamp_ntz")
    on_time = F.when(delivered.isNotNull() & estimated.isNotNull() & (delivered <= estimated), 1).otherwise(0)
    return raw_orders.filter(F.col("order_id").isNotNull()).select(
        "order_id", "customer_id", "order_status",
        purchased.alias("purchased_at"),
        F.col("order_approved_at").cast("timestamp_ntz").alias("approved_at"),
        F.col("order_delivered_carrier_date").cast("timestamp_ntz").alias("shipped_at"),
        delivered.alias("delivered_at"),
        estimated.alias("estimated_delivery_at"),
        on_time.cast("int").alias("delivered_on_time"),
        whole_days(delivered, purchased).alias("delivery_days"),
    )


def _products_with_category(raw_products: DataFrame, translation: DataFrame) -> DataFrame:
    # No broadcast hint: the planner broadcasts the translation when its measured size allows.
    t = translation.select(F.col("product_category_name").alias("_t_name"), "product_category_name_english")
    return raw_products.join(t, F.col("product_category_name") == F.col("_t_name"), "left").drop("_t_name")


def clean_order_items(raw_order_items: DataFrame, raw_products: DataFrame,
                      translation: DataFrame) -> DataFrame:
    """Priced items with product dimensions and English category (may stay NULL)."""
    items = raw_order_items.filter(F.col("order_id").isNotNull() & (F.col("price") > 0))
    products = _products_with_category(raw_products, translation).select(
        F.col("product_id").alias("_p_id"), "product_category_name", "product_category_name_english",
        "product_weight_g", "product_length_cm", "product_height_cm", "product_width_cm")
    # Products grow with the catalogue: no forced broadcast; AQE converts the
    # join to a broadcast at run time when the measured side is small.
    j = items.join(products, F.col("product_id") == F.col("_p_id"), "left")
    return j.select(
        "order_id", "order_item_id", "product_id", "seller_id", "price", "freight_value",
        (F.col("price") + F.col("freight_value")).alias("total_item_value"),
        "product_category_name",
        F.coalesce("product_category_name_english", "product_category_name").alias("category_english"),
        "product_weight_g", "product_length_cm", "product_height_cm", "product_width_cm",
    )


def clean_customers(raw_customers: DataFrame) -> DataFrame:
    """Renamed customer records; no deduplication."""
    return raw_customers.filter(F.col("customer_id").isNotNull()).select(
        "customer_id", "customer_unique_id",
        F.col("customer_zip_code_prefix").alias("zip_code"),
        F.col("customer_city").alias("city"),
        F.col("customer_state").alias("state"),
    )


def clean_payments(raw_order_payments: DataFrame) -> DataFrame:
    """C4: one row per order: payment row count, total, sorted distinct types."""
    p = raw_order_payments.filter(F.col("order_id").isNotNull() & (F.col("payment_value") > 0))
    # collect_set is combined map-side and bounded by the payment-type
    # vocabulary, so a hot order_id never buffers its rows in one task.
    types = F.array_sort(F.collect_set("payment_type"))
    return p.groupBy("order_id").agg(
        F.count(F.lit(1)).alias("payment_installments_count"),
        F.sum("payment_value").alias("total_payment"),
        types.alias("_types"),
    ).select(
        "order_id", "payment_installments_count", "total_payment",
        # Only-NULL types give NULL (like STRING_AGG), not an empty string.
        F.when(F.size("_types") > 0, F.array_join("_types", ", ")).alias("payment_types"),
    )


def clean_reviews(raw_order_reviews: DataFrame) -> DataFrame:
    """Scored reviews (1..5) with comment flag and sentiment."""
    msg = F.col("review_comment_message")
    score = F.col("review_score")
    r = raw_order_reviews.filter(F.col("review_id").isNotNull() & F.col("order_id").isNotNull()
                                 & score.between(1, 5))
    return r.select(
        "review_id", "order_id", "review_score",
        F.coalesce(F.col("review_comment_title"), F.lit("")).alias("review_title"),
        F.coalesce(msg, F.lit("")).alias("review_message"),
        F.when(msg.isNotNull() & (F.length(F.trim(msg)) > 0), 1).otherwise(0).cast("int").alias("has_comment"),
        F.col("review_creation_date").cast("timestamp_ntz").alias("created_at"),
        F.col("review_answer_timestamp").cast("timestamp_ntz").alias("answered_at"),
        F.when(score >= 4, "positive").when(score == 3, "neutral").otherwise("negative").alias("sentiment"),
    )


def clean_products(raw_products: DataFrame, translation: DataFrame) -> DataFrame:
    """Catalogue with English category ('unknown' fallback), volume and photo count."""
    p = _products_with_category(raw_products.filter(F.col("product_id").isNotNull()), translation)
    return p.select(
        "product_id",
        F.coalesce("product_category_name_english", "product_category_name", F.lit("unknown")).alias("category"),
        F.col("product_category_name").alias("category_pt"),
        "product_weight_g", "product_length_cm", "product_height_cm", "product_width_cm",
        (F.col("product_length_cm") * F.col("product_height_cm") * F.col("product_width_cm")).alias("volume_cm3"),
        F.coalesce(F.col("product_photos_qty"), F.lit(0)).alias("photos_count"),
    )


def clean_sellers(raw_sellers: DataFrame) -> DataFrame:
    """Renamed seller records."""
    return raw_sellers.filter(F.col("seller_id").isNotNull()).select(
        "seller_id",
        F.col("seller_zip_code_prefix").alias("zip_code"),
        F.col("seller_city").alias("city"),
        F.col("seller_state").alias("state"),
    )


def clean_layer(raw: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """All seven clean tables from a dict of raw tables, each built on first use."""
    from orderlake.sources.testdata import LazyTables

    def tr():
        return raw["raw_product_category_translation"]

    return LazyTables({
        "orders": lambda: clean_orders(raw["raw_orders"]),
        "order_items": lambda: clean_order_items(raw["raw_order_items"], raw["raw_products"], tr()),
        "customers": lambda: clean_customers(raw["raw_customers"]),
        "payments": lambda: clean_payments(raw["raw_order_payments"]),
        "reviews": lambda: clean_reviews(raw["raw_order_reviews"]),
        "products": lambda: clean_products(raw["raw_products"], tr()),
        "sellers": lambda: clean_sellers(raw["raw_sellers"]),
    })
