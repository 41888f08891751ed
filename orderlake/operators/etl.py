"""Load-time cleaning (E1–E6): deduplication, payment filter, per-order totals.

Deduplication keeps one row per key deterministically: the survivor is the
smallest row in (ordering columns, then the remaining columns in schema
order), NULLs first. It is computed with a grouped ``min(struct)``: combined
map-side, so a key repeated a billion times never buffers its rows in one task
(a ``row_number`` window would).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F


def keep_first(df: DataFrame, key: str, order: Sequence[str] = ()) -> DataFrame:
    """One row per ``key`` value (NULL is one group), smallest by ``order`` then the rest."""
    rest = [c for c in df.columns if c != key and c not in order]
    fields = list(order) + rest
    picked = df.groupBy(key).agg(F.min(F.struct(*[F.col(c) for c in fields])).alias("_first"))
    return picked.select(key, *[F.col(f"_first.{c}").alias(c) for c in fields]).select(*df.columns)


def dedup_orders(raw_orders: DataFrame) -> DataFrame:
    """Drop repeated order_id (earliest purchase survives), then NULL order_id."""
    d = keep_first(raw_orders, "order_id", ["order_purchase_timestamp"])
    return d.filter(F.col("order_id").isNotNull())


def dedup_customers(raw_customers: DataFrame) -> DataFrame:
    """Drop repeated customer_id first, then rows whose customer_unique_id is NULL."""
    d = keep_first(raw_customers, "customer_id")
    return d.filter(F.col("customer_unique_id").isNotNull())


def positive_payments(raw_order_payments: DataFrame) -> DataFrame:
    """Payment rows with a value above zero."""
    return raw_order_payments.filter(F.col("payment_value") > 0)


def payment_totals(raw_order_payments: DataFrame) -> DataFrame:
    """Total positive payment per order."""
    return positive_payments(raw_order_payments).groupBy("order_id").agg(
        F.sum("payment_value").alias("total_payment"))


def item_totals(raw_order_items: DataFrame) -> DataFrame:
    """E5: item count (non-NULL item ids) and price total per order."""
    return raw_order_items.groupBy("order_id").agg(
        F.count("order_item_id").alias("item_count"),
        F.sum("price").alias("total_price"))


def load_profile(raw_orders: DataFrame, raw_customers: DataFrame,
                 raw_order_payments: DataFrame, raw_order_items: DataFrame) -> DataFrame:
    """Rows read and rows kept by the load-time cleaning, one row per input.

    Every input is read once. Where rows are deduplicated, the groups carry
    how many rows they stand for, so one grouping gives both counts.
    """
    def counts(name: str, df: DataFrame, rows_in, rows_kept) -> DataFrame:
        return df.agg(F.coalesce(rows_in, F.lit(0)).cast("bigint").alias("rows_in"), rows_kept.cast("bigint").alias("rows_kept")) \
            .select(F.lit(name).alias("table_name"), "rows_in", "rows_kept")

    order_groups = raw_orders.groupBy("order_id").agg(F.count(F.lit(1)).alias("n"))
    rest = [c for c in raw_customers.columns if c != "customer_id"]
    customer_groups = raw_customers.groupBy("customer_id").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct(*rest)).alias("first"))
    every = F.count(F.lit(1))
    return (counts("orders", order_groups, F.sum("n"), F.count("order_id"))
            .unionByName(counts("customers", customer_groups, F.sum("n"), F.count("first.customer_unique_id")))
            .unionByName(counts("payments", raw_order_payments, every, F.count_if(F.col("payment_value") > 0)))
            .unionByName(counts("items", raw_order_items, every, every)))


def write_profiled(raw: dict[str, DataFrame], root: str) -> dict[str, DataFrame]:
    """E1–E3, E5's input and E6 in the write pass: write the four cleaned tables under ``root`` and count on the way.

    ``raw`` holds orders, customers, payments and items. Each input is read
    once: what is read and what is kept is counted by ``DataFrame.observe``
    while the table is written, with Q1's and Q2's findings beside it. Returns
    ``profile`` (table_name, rows_in, rows_kept) and ``checks`` (check_name,
    n_rows, passed). Spark may count the rows of a task that it had to repeat
    twice, so after a run that lost executors ``load_profile`` tells the exact
    numbers.
    """
    one = F.count(F.lit(1))
    clean = {"orders": dedup_orders, "customers": dedup_customers, "payments": positive_payments, "items": lambda df: df}
    found = {"orders": F.count_if(F.col("customer_id").isNull()), "payments": F.count_if(F.col("payment_value") <= 0)}
    spark, seen = raw["orders"].sparkSession, {}
    for name, keep in clean.items():
        read, kept = Observation(f"{name} read"), Observation(f"{name} kept")
        counted = raw[name].observe(read, one.alias("n"), found.get(name, F.lit(0) * one).alias("bad"))
        keep(counted).observe(kept, one.alias("n")).write.mode("overwrite").parquet(f"{root.rstrip('/')}/{name}")
        seen[name] = (read.get, kept.get)
    profile = [(n, r["n"], k["n"]) for n, (r, k) in seen.items()]
    checks = [(c, seen[n][0]["bad"], seen[n][0]["bad"] == 0) for c, n in (("orders_without_customer", "orders"), ("payments_not_positive", "payments"))]
    return {"profile": spark.createDataFrame(profile, "table_name string, rows_in bigint, rows_kept bigint"),
            "checks": spark.createDataFrame(checks, "check_name string, n_rows bigint, passed boolean")}
