"""Report tables behind the dashboard pages.

Each report is a DataFrame over the clean / metrics tables; top-N reports use
``orderBy(...).limit(n)`` (a distributed take-ordered), with an explicit
tie-break so the chosen rows are deterministic. Global windows appear only
over tables bounded by a fixed vocabulary (states, segments, bands).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orderlake.functions.dates import ntz_lit
from orderlake.functions.numeric import avg_round, ratio_round, round_double
from orderlake.operators.metrics import delivered
from orderlake.operators.ranking import rank_over

# Spending bands (lower bound exclusive, upper inclusive) and labels.
SPENDING_BANDS = [
    (1, "0-100 R$", 0.0, 100.0),
    (2, "100-200 R$", 100.0, 200.0),
    (3, "200-500 R$", 200.0, 500.0),
    (4, "500-1000 R$", 500.0, 1000.0),
    (5, "1000+ R$", 1000.0, None),
]


def total_revenue(monthly: DataFrame) -> DataFrame:
    """Revenue summed over the kept months of the monthly report."""
    return monthly.agg(F.sum("revenue").alias("total_revenue"))


def delivered_kpis(orders: DataFrame, payments: DataFrame) -> DataFrame:
    """Delivered orders with a positive delivery time: count, basket, days."""
    j = orders.join(payments, "order_id").filter(
        (F.col("order_status") == "delivered") & F.col("delivery_days").isNotNull() & (F.col("delivery_days") > 0))
    return j.agg(
        F.count_distinct("order_id").alias("total_orders"),
        avg_round("total_payment", 2).alias("avg_basket"),
        avg_round("delivery_days", 1).alias("avg_delivery_days"),
    )


def recent_orders(raw_orders: DataFrame, n: int = 20) -> DataFrame:
    """D3: the ``n`` latest orders (NULL purchase times first, ties by order_id)."""
    return raw_orders.select("order_id", "customer_id", "order_status", "order_purchase_timestamp") \
        .orderBy(F.col("order_purchase_timestamp").desc_nulls_first(), F.col("order_id").asc_nulls_last()) \
        .limit(n)


def status_counts(raw_orders: DataFrame, since: dt.datetime = dt.datetime(2026, 1, 1)) -> DataFrame:
    """Orders per status among those purchased since ``since``."""
    return raw_orders.filter(F.col("order_purchase_timestamp") >= ntz_lit(since)) \
        .groupBy("order_status").agg(F.count(F.lit(1)).alias("nb_commandes"))


def segment_bars(profile: DataFrame) -> DataFrame:
    """The segment profile with its four bar orders (size, spend, recency, frequency).

    The profile has one row per segment (k rows), so these windows are tiny.
    """
    def pos(*order):
        return F.row_number().over(Window.orderBy(*order, F.col("segment").asc())).cast("int")

    return profile.select(
        "*",
        pos(F.col("nb_clients").desc()).alias("order_by_size"),
        pos(F.col("monetary_med").desc()).alias("order_by_monetary"),
        pos(F.col("recency_med").asc()).alias("order_by_recency"),
        pos(F.col("frequency_med").desc()).alias("order_by_frequency"),
    )


def revenue_eras(monthly: DataFrame, daily: DataFrame, historical_until: int = 2018,
                 simulated_from: int = 2026) -> DataFrame:
    """Monthly and daily revenue split into historical / simulated eras (years between dropped)."""
    def era(df: DataFrame, series: str, period: str, growth) -> DataFrame:
        y = F.year(period)
        e = F.when(y <= historical_until, "historical").when(y >= simulated_from, "simulated")
        return df.select(F.lit(series).alias("series"), F.col(period).alias("period"), "revenue",
                         growth.alias("revenue_growth_pct"), e.alias("era")).filter(F.col("era").isNotNull())

    return era(monthly, "monthly", "month", F.col("revenue_growth_pct")).unionByName(
        era(daily, "daily", "order_date", F.lit(None).cast("double")))


def growth_without_outliers(monthly: DataFrame, limit: float = 500.0) -> DataFrame:
    """Months whose growth is known and below ``limit`` percent in absolute value."""
    g = F.col("revenue_growth_pct")
    return monthly.filter(g.isNotNull() & (F.abs(g) < limit))


def top_categories_report(categories: DataFrame, min_orders: int = 100, top: int = 20) -> DataFrame:
    """Categories with at least ``min_orders`` orders, the ``top`` by revenue, with shown/total counts.

    ``categories`` has one row per category (bounded by the category
    vocabulary), so the whole-frame counts are plain windows over it.
    """
    everything = Window.partitionBy()
    counted = categories.select(
        "category", "total_orders", "total_revenue", "avg_price",
        F.count_if(F.col("total_orders") >= min_orders).over(everything).alias("n_shown"),
        F.count(F.lit(1)).over(everything).alias("n_total"))
    return counted.filter(F.col("total_orders") >= min_orders) \
        .orderBy(F.col("total_revenue").desc_nulls_last(), F.col("category").asc_nulls_last()).limit(top)


def top_categories_by_price(report: DataFrame, top: int = 10) -> DataFrame:
    """The first ``top`` of D8 by revenue, re-sorted by average price."""
    return report.orderBy(F.col("total_revenue").desc_nulls_last(), F.col("category").asc_nulls_last()) \
        .limit(top).orderBy(F.col("avg_price").desc_nulls_last())


def state_table(geo: DataFrame) -> DataFrame:
    """State columns shown, with revenue and on-time orders (one row per state: bounded)."""
    by_rev = Window.orderBy(F.col("total_revenue").desc_nulls_last(), F.col("state").asc_nulls_last())
    by_ontime = Window.orderBy(F.col("on_time_rate_pct").desc_nulls_last(), F.col("state").asc_nulls_last())
    return geo.select("state", "total_orders", "total_revenue", "avg_delivery_days", "on_time_rate_pct",
                      "avg_review_score",
                      F.row_number().over(by_rev).cast("int").alias("revenue_order"),
                      F.row_number().over(by_ontime).cast("int").alias("on_time_order"))


def client_kpis(customers: DataFrame, orders: DataFrame, payments: DataFrame) -> DataFrame:
    """Distinct people and average basket over delivered orders."""
    j = delivered(orders).select("order_id", "customer_id").join(
        payments.select("order_id", "total_payment"), "order_id").join(
        customers.select("customer_id", "customer_unique_id"), "customer_id")
    return j.agg(F.count_distinct("customer_unique_id").alias("total_clients"),
                 avg_round("total_payment", 2).alias("avg_basket"))


def repeat_rate(clv: DataFrame) -> DataFrame:
    """Percent of lifetime-value rows with two or more orders (0 when empty)."""
    return clv.agg(F.coalesce(ratio_round(F.count_if(F.col("total_orders") >= 2) * 100, F.count(F.lit(1)), 4),
                              F.lit(0.0)).alias("repeat_rate_pct"))


def spending_bands(clv: DataFrame) -> DataFrame:
    """Lifetime-value rows per right-closed spending band; empty bands give 0."""
    spent = F.col("total_spent")
    band = None
    for order, _, lo, hi in SPENDING_BANDS:
        cond = (spent > lo) if hi is None else ((spent > lo) & (spent <= hi))
        band = F.when(cond, order) if band is None else band.when(cond, order)
    counts = clv.select(band.alias("band_order")).filter(F.col("band_order").isNotNull()) \
        .groupBy("band_order").agg(F.count(F.lit(1)).alias("n"))
    spark = clv.sparkSession
    bands = spark.createDataFrame([(o, label) for o, label, _, _ in SPENDING_BANDS],
                                  "band_order int, spending_range string")
    return bands.join(counts, "band_order", "left").select(
        "band_order", "spending_range", F.coalesce(F.col("n"), F.lit(0)).cast("bigint").alias("count"))


def orders_histogram(clv: DataFrame, max_orders: int = 10) -> DataFrame:
    """Lifetime-value rows per order count, up to ``max_orders``."""
    return clv.filter(F.col("total_orders") <= max_orders).groupBy("total_orders") \
        .agg(F.count(F.lit(1)).alias("n_customers"))


def seller_list(sellers: DataFrame) -> DataFrame:
    """Sellers numbered by revenue (ties by seller_id), distributed row numbering."""
    cols = ["seller_id", "total_revenue", "avg_review_score", "on_time_rate_pct", "total_orders",
            "avg_delivery_days"]
    ranked = rank_over(sellers.select(*cols), "total_revenue", method="row_number",
                       tie_break=["seller_id"], out="rank")
    return ranked.select("rank", *cols)


def seller_overview(sellers: DataFrame) -> DataFrame:
    """Seller count and unweighted means of their scores and on-time rates (NULLs skipped)."""
    return sellers.agg(
        F.count(F.lit(1)).alias("n_sellers"),
        round_double(F.avg("avg_review_score"), 6).alias("mean_review_score"),
        round_double(F.avg("on_time_rate_pct"), 6).alias("mean_on_time_rate_pct"),
    )


def top_sellers(sellers: DataFrame, n: int = 20) -> DataFrame:
    """The ``n`` highest-revenue sellers, shown by review average."""
    return sellers.orderBy(F.col("total_revenue").desc_nulls_first(), F.col("seller_id").asc()).limit(n) \
        .select("seller_id", "total_revenue", "avg_review_score", "on_time_rate_pct") \
        .orderBy(F.col("avg_review_score").desc_nulls_last())
