"""Metrics layer: ten report tables over the clean layer.

Shared shape: fact rows are joined on ``order_id`` (both sides are hash
partitioned by it once; the per-order payment and review aggregates arrive
already partitioned, so later joins on order_id add no exchange), then grouped.

Review fan-out (faithful by default): several reports LEFT JOIN the review
rows, so an order with two reviews counts its payment, price and delivery
days twice. Instead of multiplying rows, reviews are first reduced to one row
per order (n, score sum, comment sum) and every fact row carries the weight
w = coalesce(n, 1); SUM(x) becomes SUM(x * w) and AVG(x) becomes
SUM(x * w) / SUM(w where x is not NULL). The result equals the row-multiplying
join exactly. ``review_weight="per_order"`` counts each order once instead.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderlake.functions.dates import month_index, month_start, whole_days
from orderlake.functions.numeric import avg_round, ratio_round
from orderlake.operators.ranking import rank_over

DELIVERED = "delivered"


def delivered(orders: DataFrame) -> DataFrame:
    return orders.filter(F.col("order_status") == DELIVERED)


def review_stats(reviews: DataFrame) -> DataFrame:
    """One row per order: review count, score sum/count, comment count."""
    return reviews.groupBy("order_id").agg(
        F.count(F.lit(1)).alias("n_reviews"),
        F.sum("review_score").alias("score_sum"),
        F.count("review_score").alias("score_n"),
        F.sum("has_comment").alias("comment_sum"),
    )


def _with_reviews(facts: DataFrame, reviews: DataFrame, review_weight: str) -> DataFrame:
    if review_weight not in ("per_row", "per_order"):
        raise ValueError("review_weight must be 'per_row' or 'per_order'")
    return with_weight(facts.join(review_stats(reviews), "order_id", "left"), review_weight)


def with_weight(facts: DataFrame, review_weight: str = "per_row") -> DataFrame:
    """Facts that carry their review totals, with their weight ``_w`` in the review-joined reports."""
    w = F.coalesce(F.col("n_reviews"), F.lit(1)) if review_weight == "per_row" else F.lit(1)
    return facts.withColumn("_w", w.cast("bigint"))


def _review_avg() -> Column:
    return ratio_round(F.sum("score_sum"), F.sum("score_n"), 2)


def _w_sum(c: str) -> Column:
    return F.sum(F.col(c) * F.col("_w"))


def _w_rate_pct(flag: str) -> Column:
    return ratio_round(F.sum(F.col(flag) * F.col("_w")) * 100, F.sum(F.when(F.col(flag).isNotNull(), F.col("_w"))), 2)


def _orders_payments(orders: DataFrame, payments: DataFrame, *cols: str) -> DataFrame:
    return orders.select("order_id", *cols).join(
        payments.select("order_id", "total_payment", "payment_installments_count", "payment_types"), "order_id")


# ---------------------------------------------------------------- A1 / A2

def daily_revenue(orders: DataFrame, payments: DataFrame) -> DataFrame:
    """A1: delivered orders per purchase date: orders, revenue, average order value."""
    return daily_of(_orders_payments(delivered(orders), payments, "purchased_at"))


def daily_of(sold: DataFrame) -> DataFrame:
    """A1 of delivered orders that carry their payment."""
    return sold.groupBy(F.to_date("purchased_at").alias("order_date")).agg(
        F.count_distinct("order_id").alias("total_orders"),
        F.sum("total_payment").cast("double").alias("revenue"),
        avg_round("total_payment", 2).alias("avg_order_value"),
    )


def month_totals(orders: DataFrame, payments: DataFrame) -> DataFrame:
    """Delivered orders per purchase month: orders, revenue (exact), average order value."""
    return month_totals_of(_orders_payments(delivered(orders), payments, "purchased_at"))


def month_totals_of(sold: DataFrame) -> DataFrame:
    """``month_totals`` of delivered orders that carry their payment."""
    return sold.groupBy(month_start("purchased_at").alias("month")).agg(
        F.count_distinct("order_id").alias("total_orders"),
        F.sum("total_payment").alias("_rev"),
        avg_round("total_payment", 2).alias("avg_order_value"),
    )


def month_growth(totals: DataFrame, min_orders: int = 100) -> DataFrame:
    """Months with at least ``min_orders`` orders and their growth vs the previous kept month.

    The LAG window has no partition key, but it runs over the month series,
    which is bounded by the calendar span (not by data volume).
    """
    prev = F.lag("_rev").over(Window.orderBy(F.col("month").asc_nulls_last()))
    return totals.filter(F.col("total_orders") >= min_orders).select(
        "month", "total_orders", F.col("_rev").cast("double").alias("revenue"), "avg_order_value",
        ratio_round((F.col("_rev") - prev) * 100, prev, 2).alias("revenue_growth_pct"),
    )


def monthly_revenue(orders: DataFrame, payments: DataFrame, min_orders: int = 100) -> DataFrame:
    """A2: months with at least ``min_orders`` delivered orders, with growth vs the previous kept month."""
    return month_growth(month_totals(orders, payments), min_orders)


# ---------------------------------------------------------------- A3 / A4

def _two_distincts(facts: DataFrame, group: list[str], other: str, sums: dict[str, Column], orders_out: str, others_out: str) -> DataFrame:
    """Per ``group``: ``sums``, distinct orders and distinct values of ``other``, without a copy of the facts for each distinct.

    The facts come partitioned by order_id, so they are first reduced to one
    row for each (order, group, other) where they are; the first of an order's
    rows in a group stands for the order. Then one shuffle counts the orders
    and adds up by (group, other), and one row of that is one distinct value.
    """
    cells = facts.groupBy("order_id", *group, other).agg(*[c.alias(n) for n, c in sums.items()])
    first = F.row_number().over(Window.partitionBy("order_id", *group).orderBy(F.col(other).asc_nulls_last())) == 1
    cells = cells.withColumn("_first", F.when(first & F.col("order_id").isNotNull(), 1).otherwise(0).cast("bigint"))
    added = [F.sum(n).alias(n) for n in sums]
    pairs = cells.groupBy(*group, other).agg(F.sum("_first").alias(orders_out), *added)
    return pairs.groupBy(*group).agg(F.sum(orders_out).alias(orders_out), F.count(other).alias(others_out), *added)


def top_products(order_items: DataFrame, orders: DataFrame, reviews: DataFrame,
                 review_weight: str = "per_row") -> DataFrame:
    """A3: delivered product revenue with RANK of revenue inside its category."""
    items = order_items.select("order_id", "product_id", "seller_id", "price",
                               F.col("category_english").alias("category"))
    j = items.join(delivered(orders).select("order_id"), "order_id")
    j = _with_reviews(j, reviews, review_weight)
    price_w = F.sum(F.when(F.col("price").isNotNull(), F.col("_w")))
    sums = {"_rev": _w_sum("price"), "_priced": price_w, "_score": F.sum("score_sum"), "_scored": F.sum("score_n")}
    agg = _two_distincts(j, ["product_id", "category"], "seller_id", sums, "total_orders", "seller_count").select(
        "product_id", "category", "total_orders", "_rev", ratio_round(F.col("_rev"), F.col("_priced"), 2).alias("avg_price"),
        ratio_round(F.col("_score"), F.col("_scored"), 2).alias("avg_review_score"), "seller_count")
    ranked = rank_over(agg, "_rev", partition_by=["category"], out="rank_in_category")
    return ranked.select("product_id", "category", "total_orders",
                         F.col("_rev").cast("double").alias("total_revenue"),
                         "avg_price", "avg_review_score", "seller_count", "rank_in_category")


def top_categories(order_items: DataFrame) -> DataFrame:
    """A4: all items (any status) per English category."""
    items = order_items.select("order_id", "product_id", "price", F.col("category_english").alias("category"))
    sums = {"_rev": F.sum("price"), "_priced": F.count("price")}
    return _two_distincts(items, ["category"], "product_id", sums, "total_orders", "unique_products").select(
        "category", "total_orders", F.col("_rev").cast("double").alias("total_revenue"),
        ratio_round(F.col("_rev"), F.col("_priced"), 2).alias("avg_price"), "unique_products")


# ---------------------------------------------------------------- A5

def customer_lifetime_value(customers: DataFrame, orders: DataFrame, payments: DataFrame) -> DataFrame:
    """A5: per (person, state, city): delivered orders, spend, first/last order, segment."""
    op = _orders_payments(delivered(orders), payments, "customer_id", "purchased_at")
    j = op.join(customers.select("customer_id", "customer_unique_id", "state", "city"), "customer_id")
    agg = j.groupBy("customer_unique_id", "state", "city").agg(
        F.count_distinct("order_id").alias("total_orders"),
        F.sum("total_payment").alias("_spent"),
        F.min("purchased_at").alias("first_order_date"),
        F.max("purchased_at").alias("last_order_date"),
        avg_round("total_payment", 2).alias("avg_order_value"),
    )
    spent = F.col("_spent")
    return agg.select(
        "customer_unique_id", "state", "city", "total_orders",
        spent.cast("double").alias("total_spent"),
        "first_order_date", "last_order_date", "avg_order_value",
        whole_days("last_order_date", "first_order_date").alias("customer_lifespan_days"),
        F.when(spent >= 500, "high_value").when(spent >= 200, "mid_value").otherwise("low_value")
        .alias("customer_segment"),
        F.when(F.col("total_orders") > 1, 1).otherwise(0).cast("int").alias("is_repeat_customer"),
    )


# ---------------------------------------------------------------- A6

def kpi_summary(orders: DataFrame, payments: DataFrame, reviews: DataFrame,
                review_weight: str = "per_row") -> DataFrame:
    """Monthly basket, delivery, review and cancellation KPIs over all statuses."""
    j = _orders_payments(orders, payments, "purchased_at", "order_status",
                         "delivered_on_time", "delivery_days")
    return kpi_of(_with_reviews(j, reviews, review_weight))


def kpi_of(paid: DataFrame) -> DataFrame:
    """A6 of orders that carry their payment, their review totals and their weight."""
    w = F.col("_w")
    return paid.groupBy(month_start("purchased_at").alias("month")).agg(
        avg_round("total_payment", 2, weight=w).alias("avg_basket"),
        F.count_distinct("order_id").alias("total_orders"),
        _w_rate_pct("delivered_on_time").alias("on_time_delivery_rate_pct"),
        avg_round("delivery_days", 1, weight=w).alias("avg_delivery_days"),
        _review_avg().alias("avg_review_score"),
        ratio_round(F.sum("comment_sum") * 100, F.sum("n_reviews"), 2).alias("review_comment_rate_pct"),
        ratio_round(F.sum(F.when(F.col("order_status") == "canceled", w).otherwise(0)) * 100,
                    F.sum(w), 2).alias("cancellation_rate_pct"),
    )


# ---------------------------------------------------------------- A7

def seller_performance(order_items: DataFrame, orders: DataFrame, sellers: DataFrame,
                       reviews: DataFrame, review_weight: str = "per_row") -> DataFrame:
    """Delivered sales per seller with a global RANK by revenue."""
    ranked = rank_over(seller_facts(order_items, orders, sellers, reviews, review_weight), "_revenue", out="revenue_rank")
    return ranked.drop("_revenue")


def seller_facts(order_items: DataFrame, orders: DataFrame, sellers: DataFrame,
                 reviews: DataFrame, review_weight: str = "per_row") -> DataFrame:
    """Delivered sales per seller, not ranked; ``_revenue`` is the exact total.

    Facts are aggregated per seller_id before the seller dimension is joined
    (one shuffle of the item facts instead of two). Repeated seller rows with
    the same city/state multiply sums exactly as the row join would: the
    dimension side carries its multiplicity.
    """
    items = order_items.select("order_id", "seller_id", "product_id", "price")
    o = delivered(orders).select("order_id", "delivery_days", "delivered_on_time")
    j = _with_reviews(items.join(o, "order_id"), reviews, review_weight)
    w = F.col("_w")
    sums = {
        "_rev": _w_sum("price"),
        "_w_n": F.sum(w),
        "_score_sum": F.sum("score_sum"),
        "_score_n": F.sum("score_n"),
        "_days_sum": F.sum(F.col("delivery_days") * w),
        "_days_n": F.sum(F.when(F.col("delivery_days").isNotNull(), w)),
        "_ontime_sum": F.sum(F.col("delivered_on_time") * w),
        "_ontime_n": F.sum(F.when(F.col("delivered_on_time").isNotNull(), w)),
    }
    per_seller = _two_distincts(j, ["seller_id"], "product_id", sums, "total_orders", "unique_products")
    dim = sellers.groupBy("seller_id", F.col("city").alias("seller_city"),
                          F.col("state").alias("seller_state")).agg(F.count(F.lit(1)).alias("_m"))
    x = per_seller.join(dim, "seller_id")
    m = F.col("_m")
    revenue = F.col("_rev") * m
    return x.select(
        "seller_id", "seller_city", "seller_state", "total_orders", revenue.cast("double").alias("total_revenue"),
        ratio_round(F.col("_rev"), F.col("_w_n"), 2).alias("avg_product_price"),
        "unique_products",
        ratio_round(F.col("_score_sum"), F.col("_score_n"), 2).alias("avg_review_score"),
        ratio_round(F.col("_days_sum"), F.col("_days_n"), 1).alias("avg_delivery_days"),
        ratio_round(F.col("_ontime_sum") * 100, F.col("_ontime_n"), 2).alias("on_time_rate_pct"),
        revenue.alias("_revenue"),
    )


# ---------------------------------------------------------------- A8

def geo_analysis(customers: DataFrame, orders: DataFrame, payments: DataFrame, reviews: DataFrame,
                 review_weight: str = "per_row") -> DataFrame:
    """Delivered orders per customer state."""
    op = _orders_payments(delivered(orders), payments, "customer_id", "delivery_days", "delivered_on_time")
    op = _with_reviews(op, reviews, review_weight)
    j = op.join(customers.select("customer_id", "customer_unique_id", "state"), "customer_id")
    w = F.col("_w")
    return j.groupBy("state").agg(
        F.count_distinct("customer_unique_id").alias("unique_customers"),
        F.count_distinct("order_id").alias("total_orders"),
        _w_sum("total_payment").cast("double").alias("total_revenue"),
        avg_round("total_payment", 2, weight=w).alias("avg_order_value"),
        avg_round("delivery_days", 1, weight=w).alias("avg_delivery_days"),
        _w_rate_pct("delivered_on_time").alias("on_time_rate_pct"),
        _review_avg().alias("avg_review_score"),
        ratio_round(_w_sum("total_payment"), F.count_distinct("customer_unique_id"), 2)
        .alias("revenue_per_customer"),
    )


# ---------------------------------------------------------------- A9

def payment_analysis(orders: DataFrame, payments: DataFrame) -> DataFrame:
    """Delivered orders per (month, payment type mix)."""
    return payment_kinds_of(_orders_payments(delivered(orders), payments, "purchased_at"))


def payment_kinds_of(sold: DataFrame) -> DataFrame:
    """A9 of delivered orders that carry their payment."""
    return sold.groupBy(month_start("purchased_at").alias("month"), "payment_types").agg(
        F.count_distinct("order_id").alias("total_orders"),
        F.sum("total_payment").cast("double").alias("total_revenue"),
        avg_round("total_payment", 2).alias("avg_payment"),
        avg_round("payment_installments_count", 1).alias("avg_installments"),
    )


# ---------------------------------------------------------------- A10

def cohort_retention(customers: DataFrame, orders: DataFrame) -> DataFrame:
    """A10: active people per (first delivered month, months since it).

    One shuffle on the person: each person's distinct active months are
    collected (combined map-side; bounded by the calendar span, never by the
    person's order count), the cohort is the earliest, and the exploded
    (cohort, offset) pairs are counted with a partial aggregate.
    """
    j = delivered(orders).select("customer_id", "purchased_at").join(
        customers.select("customer_id", "customer_unique_id"), "customer_id")
    j = j.filter(F.col("customer_unique_id").isNotNull())
    m = month_start("purchased_at")
    per_person = j.groupBy("customer_unique_id").agg(
        F.collect_set(m).alias("_months"),
        F.max(m.isNull().cast("int")).alias("_has_null"),
    )
    months = F.when(F.col("_has_null") == 1, F.concat("_months", F.array(F.lit(None).cast("date")))) \
        .otherwise(F.col("_months"))
    act = per_person.select(F.array_min("_months").alias("cohort_month"),
                            F.explode(months).alias("_m"))
    return act.groupBy(
        "cohort_month",
        (month_index("_m") - month_index("cohort_month")).cast("int").alias("months_since_first_order"),
    ).agg(F.count(F.lit(1)).alias("active_customers"))
