"""Data-quality checks (Q1–Q4) and order-document validation (Q5).

Checks only report: a failing check is a row with ``passed = false``; nothing
raises. Every count is a global aggregate combined map-side.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _count(df: DataFrame, check: str) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n_rows")).select(
        F.lit(check).alias("check_name"), "n_rows", (F.col("n_rows") == 0).alias("passed"))


def orders_missing_customer(raw_orders: DataFrame) -> DataFrame:
    """Q1: orders whose customer_id is NULL."""
    return _count(raw_orders.filter(F.col("customer_id").isNull()), "orders_without_customer")


def nonpositive_payments(raw_order_payments: DataFrame) -> DataFrame:
    """Q2: payment rows with value <= 0 (NULL values are not counted)."""
    return _count(raw_order_payments.filter(F.col("payment_value") <= 0), "payments_not_positive")


def delivered_without_payment(raw_orders: DataFrame, raw_order_payments: DataFrame) -> DataFrame:
    """Q3: delivered order rows with no payment row (anti join; NULL ids never match)."""
    paid = raw_order_payments.select("order_id")
    d = raw_orders.filter(F.col("order_status") == "delivered").select("order_id")
    return _count(d.join(paid, "order_id", "left_anti"), "delivered_without_payment")


def data_quality(raw_orders: DataFrame, raw_order_payments: DataFrame) -> DataFrame:
    """Q4: the three checks as one report (check_name, n_rows, passed)."""
    return (orders_missing_customer(raw_orders)
            .unionByName(nonpositive_payments(raw_order_payments))
            .unionByName(delivered_without_payment(raw_orders, raw_order_payments)))


# ---------------------------------------------------------------- Q5

# Reason codes, in the order they are reported.
REQUIRED_FIELDS = ["order_id", "customer_id", "customer_unique_id", "customer_city",
                   "customer_state", "purchased_at", "payment_type", "payment_value"]
ITEM_REQUIRED_FIELDS = ["product_id", "seller_id", "price", "freight_value"]
DEFAULT_STATUS = "processing"


def _reasons(parts: list[tuple[Column, str]]) -> Column:
    arr = F.array(*[F.when(cond, F.lit(code)) for cond, code in parts])
    return F.filter(arr, lambda x: x.isNotNull())


def _order_rules(item_flags: dict[str, Column]) -> list[tuple[Column, str]]:
    rules = [(F.col(c).isNull(), f"missing_{c}") for c in REQUIRED_FIELDS]
    rules.append((F.col("items_missing"), "missing_items"))
    rules += [(item_flags[c], f"item_missing_{c}") for c in ITEM_REQUIRED_FIELDS]
    rules += [
        (item_flags["price_not_positive"], "item_price_not_positive"),
        (item_flags["freight_negative"], "item_freight_negative"),
        (F.col("payment_value") <= 0, "payment_value_not_positive"),
    ]
    return rules


def validate_orders(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Q5 on nested order documents → (valid, rejected).

    Valid documents get the default status when theirs is NULL; rejected ones
    carry ``reasons ARRAY<STRING>``. An empty item list is valid; unknown
    fields are dropped by reading with the declared document schema.
    """
    items = F.coalesce(F.col("items"), F.array())
    def missing(field: str):
        return lambda it: it[field].isNull()

    flags = {c: F.exists(items, missing(c)) for c in ITEM_REQUIRED_FIELDS}
    flags["price_not_positive"] = F.exists(items, lambda it: it["price"] <= 0)
    flags["freight_negative"] = F.exists(items, lambda it: it["freight_value"] < 0)
    checked = docs.withColumn("items_missing", F.col("items").isNull()) \
        .withColumn("reasons", _reasons(_order_rules(flags))).drop("items_missing")
    valid = checked.filter(F.size("reasons") == 0).drop("reasons") \
        .withColumn("order_status", F.coalesce(F.col("order_status"), F.lit(DEFAULT_STATUS)))
    rejected = checked.filter(F.size("reasons") > 0)
    return valid, rejected


def validate_order_rows(headers: DataFrame, items: DataFrame) -> DataFrame:
    """Q5 on the flat form: order headers plus item rows keyed by order_id.

    Item problems are reduced per order with ``max`` (combined map-side), so an
    order with very many items never gathers them in one place. Returns
    (order_id, order_status, reasons) with the same codes as ``validate_orders``.
    """
    agg = items.groupBy(F.col("order_id").alias("_oid")).agg(
        *[F.max(F.col(c).isNull()).alias(f"_miss_{c}") for c in ITEM_REQUIRED_FIELDS],
        F.max(F.col("price") <= 0).alias("_price_bad"),
        F.max(F.col("freight_value") < 0).alias("_freight_bad"),
    )
    j = headers.join(agg, headers["order_id"].eqNullSafe(agg["_oid"]), "left")
    flags = {c: F.coalesce(F.col(f"_miss_{c}"), F.lit(False)) for c in ITEM_REQUIRED_FIELDS}
    flags["price_not_positive"] = F.coalesce(F.col("_price_bad"), F.lit(False))
    flags["freight_negative"] = F.coalesce(F.col("_freight_bad"), F.lit(False))
    j = j.withColumn("items_missing", F.lit(False))
    return j.select(
        "order_id",
        F.coalesce(F.col("order_status"), F.lit(DEFAULT_STATUS)).alias("order_status"),
        _reasons(_order_rules(flags)).alias("reasons"),
    )
