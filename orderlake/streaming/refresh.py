"""ST5: keep the daily and monthly reports up to date, batch by batch.

Two ways, for two kinds of batch:

*Replacement by month* (``store_batch``, ``refresh_reports``). Facts, one row
per order with all that the reports need, are stored by purchase month. A
batch's orders replace their former rows: only the touched months are read,
merged and written as new versions, and only their report rows are computed
anew. Any field but the purchase time may have changed.

*Mergeable states* (``add_batch``, ``state_reports``). Where orders only
arrive, a batch is folded into small states, and no month is read again. Sums
and counts add up; the distinct orders are bitmaps over the orders' numbers,
dense within a day, that merge by OR. An order that an earlier batch
has brought is left out, so batches may overlap.
"""

from __future__ import annotations

from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlake.functions.dates import month_start
from orderlake.functions.numeric import ratio_round
from orderlake.operators import metrics as A
from orderlake.operators.ranking import rank_over
from orderlake.sources.files import _fs, path_exists
from orderlake.sources.months import Month, months_of, of_months, read_months, replace_months

# ---------------------------------------------------------------- by month


def order_facts(orders: DataFrame, payments: DataFrame, reviews: DataFrame) -> DataFrame:
    """One row per order: header, payment totals, review totals, and its purchase ``month``."""
    facts = orders.select("order_id", "order_status", "purchased_at", "delivered_on_time", "delivery_days") \
        .join(payments.select("order_id", "total_payment", "payment_installments_count", "payment_types"), "order_id", "left") \
        .join(A.review_stats(reviews), "order_id", "left")
    return facts.withColumn("month", month_start("purchased_at"))


def store_batch(spark: SparkSession, root: str, batch: DataFrame, version: str | None = None) -> list[Month]:
    """Put the facts ``batch`` (one row per order) in place of its orders' former ones; returns the touched months."""
    months = months_of(batch)
    old = read_months(spark, root, "facts", batch.schema, months)
    kept = old.join(batch.select("order_id"), "order_id", "left_anti").select(batch.columns)
    replace_months(kept.unionByName(batch), root, "facts", months, version)
    return months


def _with_month(report: DataFrame) -> DataFrame:
    return report if "month" in report.columns else report.withColumn("month", month_start(F.col("order_date")))


def refresh_reports(spark: SparkSession, root: str, months: Iterable[Month], version: str | None = None) -> None:
    """Compute A1, A2's month totals, A6 and A9 anew for ``months``, from the facts of these months alone (no join, they carry all)."""
    months = list(months)
    paid = read_months(spark, root, "facts", months=months).drop("month").filter(F.col("total_payment").isNotNull())
    sold = A.delivered(paid)
    built = {"daily_revenue": A.daily_of(sold), "month_totals": A.month_totals_of(sold), "kpi_summary": A.kpi_of(A.with_weight(paid)),
             "payment_analysis": A.payment_kinds_of(sold)}
    with ThreadPoolExecutor(max_workers=len(built)) as pool:   # independent tables, written as concurrent jobs
        list(pool.map(lambda name: replace_months(_with_month(built[name]), root, name, months, version), built))


def read_reports(spark: SparkSession, root: str, min_month_orders: int = 100) -> dict[str, DataFrame]:
    """The refreshed reports A1, A2, A6 and A9.

    A2's floor and its growth against the previous kept month are applied to
    the whole series of months, so a touched month also moves the next one's.
    """
    out = {n: read_months(spark, root, n) for n in ("daily_revenue", "kpi_summary", "payment_analysis")}
    out["daily_revenue"] = out["daily_revenue"].drop("month")
    return out | {"monthly_revenue": A.month_growth(read_months(spark, root, "month_totals"), min_month_orders)}


# ---------------------------------------------------------------- states

_CELL = ["month", "order_date", "delivered", "payment_types"]


def _sums() -> dict[str, Column]:
    """The additive measures of a cell; ``w`` is an order's weight in the review-joined report."""
    w = F.coalesce(F.col("n_reviews"), F.lit(1)).cast("bigint")

    def weighted(c: str) -> Column:
        return F.sum(F.col(c) * w)

    def weight(c: str) -> Column:
        return F.sum(F.when(F.col(c).isNotNull(), w))

    return {"n": F.count(F.lit(1)), "paid": F.sum("total_payment"), "paid_n": F.count("total_payment"),
            "installments": F.sum("payment_installments_count"), "installments_n": F.count("payment_installments_count"),
            "w": F.sum(w), "w_paid": weighted("total_payment"), "w_paid_n": weight("total_payment"),
            "w_on_time": weighted("delivered_on_time"), "w_on_time_n": weight("delivered_on_time"),
            "w_days": weighted("delivery_days"), "w_days_n": weight("delivery_days"),
            "w_canceled": F.sum(F.when(F.col("order_status") == "canceled", w).otherwise(0)),
            "score": F.sum("score_sum"), "score_n": F.sum("score_n"), "comments": F.sum("comment_sum"), "reviews": F.sum("n_reviews")}


def _partitions(root: str, name: str, batch_id: int | None = None) -> str:
    return f"{root.rstrip('/')}/{name}" + ("" if batch_id is None else f"/batch_id={batch_id}")


def _committed(spark: SparkSession, root: str, name: str, without: int | None = None) -> DataFrame | None:
    """Table ``name`` as the committed batches (but ``without``) wrote it; None before the first one."""
    if not path_exists(spark, f"{root}/commits"):
        return None
    ids = [r[0] for r in spark.read.parquet(f"{root}/commits").select("batch_id").distinct().collect() if r[0] != without]
    if not ids:
        return None
    rows = spark.read.option("basePath", _partitions(root, name)).parquet(*[_partitions(root, name, i) for i in ids])
    return rows.withColumn("month", F.col("month").cast("date"))


def add_batch(spark: SparkSession, root: str, batch: DataFrame, batch_id: int) -> None:
    """Fold the facts ``batch`` (see ``order_facts``; orders without a payment do not count) into the states.

    Of an order that comes several times, the first batch's row counts, and in
    a batch one of them. Reads the touched months' order numbers, and of the
    states nothing. The batch is computed once, to a folder that goes at the
    end. A batch that is repeated under its id replaces what it wrote; it
    counts once its commit marker is there.
    """
    batch = batch.filter(F.col("total_payment").isNotNull()).dropDuplicates(["order_id"]).withColumn("order_date", F.to_date("purchased_at"))
    arrived = _partitions(root, "arrived", batch_id)
    batch.write.mode("overwrite").parquet(arrived)
    batch = spark.read.schema(batch.schema).parquet(arrived)
    known = _committed(spark, root, "numbers", batch_id)
    taken = None
    if known is not None:
        near = known.filter(of_months(F.col("month"), months_of(batch)))
        batch = batch.join(near.select("order_id"), "order_id", "left_anti")
        taken = near.groupBy(F.col("order_date").alias("day")).agg((F.max("number") + 1).alias("taken"))
    fresh = rank_over(batch, "order_id", partition_by=["order_date"], descending=False, method="row_number", out="number")
    if taken is not None:   # a row a day
        fresh = fresh.join(F.broadcast(taken), F.col("order_date").eqNullSafe(F.col("day")), "left").drop("day") \
            .withColumn("number", F.col("number") + F.coalesce("taken", F.lit(0))).drop("taken")
    fresh = fresh.withColumn("number", F.col("number") - 1).withColumn("delivered", F.coalesce(F.col("order_status") == A.DELIVERED, F.lit(False)))
    at = _partitions(root, "numbers", batch_id)
    fs, staged = _fs(spark, arrived)
    fresh.repartition("month").write.mode("overwrite").partitionBy("month").parquet(at)
    fs.delete(staged, True)
    fresh = spark.read.schema(fresh.schema).parquet(at)   # numbers are fixed from here on
    if fresh.isEmpty():
        return
    cells = fresh.groupBy(*_CELL).agg(*[c.alias(n) for n, c in _sums().items()])
    # Numbers are dense within a day, so a bitmap (one a day, kind and 32,768 numbers) is well filled.
    seen = fresh.groupBy(*_CELL, F.bitmap_bucket_number(F.col("number") + 1).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(F.col("number") + 1)).alias("orders"))
    with ThreadPoolExecutor(max_workers=2) as pool:
        list(pool.map(lambda df, name: df.write.mode("overwrite").parquet(_partitions(root, name, batch_id)), (cells, seen), ("cells", "seen")))
    spark.range(1).select(F.lit(batch_id).cast("bigint").alias("batch_id")).coalesce(1).write.mode("overwrite").parquet(f"{root}/commits/batch={batch_id}")


def _distinct(seen: DataFrame, *keys: str) -> DataFrame:
    """Distinct orders of each group: bitmaps of one day and bucket merged, then counted."""
    whole = seen.groupBy(*{*keys, "order_date", "bucket"}).agg(F.bitmap_or_agg("orders").alias("orders"))
    return whole.groupBy(*keys).agg(F.sum(F.bitmap_count("orders")).alias("total_orders"))


def _joined(sums: DataFrame, counts: DataFrame, *keys: str) -> DataFrame:
    counts = counts.select(*[F.col(k).alias(f"{k}_") for k in keys], "total_orders")
    on = None
    for k in keys:
        same = F.col(k).eqNullSafe(F.col(f"{k}_"))
        on = same if on is None else on & same
    return sums.join(counts, on).drop(*[f"{k}_" for k in keys])


def state_reports(spark: SparkSession, root: str, min_month_orders: int = 100) -> dict[str, DataFrame]:
    """A1, A2, A6 and A9 from the merged states alone; equal to a full run over all batches' orders."""
    cells, seen = _committed(spark, root, "cells"), _committed(spark, root, "seen")
    if cells is None:
        raise FileNotFoundError(f"no committed batch under {root}")

    def merged(rows: DataFrame, *keys: str) -> DataFrame:
        return rows.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in _sums()])

    done, done_seen = cells.filter("delivered"), seen.filter("delivered")
    money, mean = F.col("paid").cast("double"), ratio_round(F.col("paid"), F.col("paid_n"), 2)
    daily = _joined(merged(done, "order_date"), _distinct(done_seen, "order_date"), "order_date").select(
        "order_date", "total_orders", money.alias("revenue"), mean.alias("avg_order_value"))
    totals = _joined(merged(done, "month"), _distinct(done_seen, "month"), "month").select(
        "month", "total_orders", F.col("paid").alias("_rev"), mean.alias("avg_order_value"))
    kinds = _joined(merged(done, "month", "payment_types"), _distinct(done_seen, "month", "payment_types"), "month", "payment_types").select(
        "month", "payment_types", "total_orders", money.alias("total_revenue"), mean.alias("avg_payment"),
        ratio_round(F.col("installments"), F.col("installments_n"), 1).alias("avg_installments"))
    kpi = _joined(merged(cells, "month"), _distinct(seen, "month"), "month").select(
        "month", ratio_round(F.col("w_paid"), F.col("w_paid_n"), 2).alias("avg_basket"), "total_orders",
        ratio_round(F.col("w_on_time") * 100, F.col("w_on_time_n"), 2).alias("on_time_delivery_rate_pct"),
        ratio_round(F.col("w_days"), F.col("w_days_n"), 1).alias("avg_delivery_days"),
        ratio_round(F.col("score"), F.col("score_n"), 2).alias("avg_review_score"),
        ratio_round(F.col("comments") * 100, F.col("reviews"), 2).alias("review_comment_rate_pct"),
        ratio_round(F.col("w_canceled") * 100, F.col("w"), 2).alias("cancellation_rate_pct"))
    return {"daily_revenue": daily, "monthly_revenue": A.month_growth(totals, min_month_orders), "payment_analysis": kinds, "kpi_summary": kpi}
