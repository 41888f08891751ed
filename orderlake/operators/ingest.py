"""Nested order documents ↔ raw rows.

An order document carries the customer, the order header, its item list and
one payment. ``fan_out_orders`` turns a DataFrame of documents into rows of
the four raw tables with narrow operators only (``posexplode`` for items,
numbered from 1 in list order; one payment row with sequence 1).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

NTZ = "timestamp_ntz"


def fan_out_orders(docs: DataFrame) -> dict[str, DataFrame]:
    """Documents → raw_customers, raw_orders, raw_order_items, raw_order_payments rows.

    Fields the document does not carry stay NULL (zip code, approval,
    carrier and delivery dates). An empty item list gives no item rows.
    """
    customers = docs.select(
        "customer_id", "customer_unique_id",
        F.lit(None).cast("string").alias("customer_zip_code_prefix"),
        "customer_city", "customer_state")
    orders = docs.select(
        "order_id", "customer_id", "order_status",
        F.col("purchased_at").cast(NTZ).alias("order_purchase_timestamp"),
        F.lit(None).cast(NTZ).alias("order_approved_at"),
        F.lit(None).cast(NTZ).alias("order_delivered_carrier_date"),
        F.lit(None).cast(NTZ).alias("order_delivered_customer_date"),
        F.col("estimated_delivery_at").cast(NTZ).alias("order_estimated_delivery_date"))
    items = docs.select("order_id", F.posexplode("items").alias("pos", "item")).select(
        "order_id", (F.col("pos") + 1).cast("int").alias("order_item_id"),
        F.col("item.product_id").alias("product_id"), F.col("item.seller_id").alias("seller_id"),
        F.col("item.price").cast("decimal(18,2)").alias("price"),
        F.col("item.freight_value").cast("decimal(18,2)").alias("freight_value"))
    payments = docs.select(
        "order_id", F.lit(1).alias("payment_sequential"), "payment_type",
        F.col("payment_value").cast("decimal(18,2)").alias("payment_value"))
    return {"raw_customers": customers, "raw_orders": orders,
            "raw_order_items": items, "raw_order_payments": payments}


def order_summary(docs: DataFrame) -> DataFrame:
    """The per-document response summary."""
    return docs.select(
        "order_id", "customer_id", "order_status", "purchased_at",
        F.size(F.coalesce(F.col("items"), F.array())).alias("total_items"),
        F.col("payment_value").alias("total_value"))


def orders_as_documents(raw: dict[str, DataFrame]) -> DataFrame:
    """Build order documents from raw tables (fixtures for ingest and tests).

    One document is one order payload, so its item list is the order's own
    lines (a handful per order); items are sorted by item id, then fields.
    Lines are spread by order before they are gathered: no map task sorts its
    whole split for lists that other tasks complete.
    """
    o, c = raw["raw_orders"], raw["raw_customers"]
    p = raw["raw_order_payments"].filter(F.col("payment_sequential") == 1)
    items = raw["raw_order_items"].repartition("order_id").groupBy("order_id").agg(F.array_sort(F.collect_list(F.struct(
        "order_item_id", "product_id", "seller_id",
        F.col("price").cast("double").alias("price"),
        F.col("freight_value").cast("double").alias("freight_value")))).alias("_items"))
    doc_items = F.transform(F.coalesce(F.col("_items"), F.array()), lambda it: F.struct(
        it["product_id"].alias("product_id"), it["seller_id"].alias("seller_id"),
        it["price"].alias("price"), it["freight_value"].alias("freight_value")))
    j = o.join(c, "customer_id").join(p.select("order_id", "payment_type", "payment_value"), "order_id", "left") \
        .join(items, "order_id", "left")
    return j.select(
        "order_id", "customer_id", "customer_unique_id", "customer_city", "customer_state", "order_status",
        F.col("order_purchase_timestamp").cast("timestamp").alias("purchased_at"),
        F.col("order_estimated_delivery_date").cast("timestamp").alias("estimated_delivery_at"),
        doc_items.alias("items"), "payment_type",
        F.col("payment_value").cast("double").alias("payment_value"))
