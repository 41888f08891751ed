"""Map the driver's star-schema parquet tables onto the raw order contract.

Every raw table is a narrow, per-row projection of one testdata table (plus
joins to the fixed 25-row ``nation`` table), so the mapping scales with the
input and keeps Parquet column pruning and filter pushdown. The mapping rules
are documented in FIXTURES.md §2; the DuckDB oracle applies the same rules.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read one testdata table as it is stored; its files and row groups decide the scan's tasks."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


class LazyTables(dict):
    """A dict whose values are built on first access (building a DataFrame analyses its plan)."""

    def __init__(self, builders):
        super().__init__()
        self._builders = dict(builders)

    def __missing__(self, key):
        if key not in self._builders:
            raise KeyError(key)
        value = self[key] = self._builders[key]()
        return value

    def keys(self):
        return self._builders.keys()

    def __iter__(self):
        return iter(self._builders)

    def __len__(self):
        return len(self._builders)

    def __contains__(self, key):
        return key in self._builders

    def items(self):
        return [(k, self[k]) for k in self._builders]

    def values(self):
        return [self[k] for k in self._builders]


def _hours(n: Column) -> Column:
    return F.make_dt_interval(F.lit(0), n.cast("int"))


def _days(n: Column) -> Column:
    return F.make_dt_interval(n.cast("int"))


def _cents_to_money(cents: Column) -> Column:
    return (cents.cast("decimal(18,2)") * F.lit(0.01).cast("decimal(3,2)")).cast("decimal(18,2)")


def raw_orders(orders: DataFrame) -> DataFrame:
    k = F.col("o_orderkey")
    d = F.col("o_orderdate").cast("timestamp_ntz")
    st, prio = F.col("o_orderstatus"), F.col("o_orderpriority")
    status = (F.when(st == "F", "delivered").when(st == "O", "shipped")
              .when((st == "P") & (prio == "5-LOW"), "canceled").when(st == "P", "processing"))
    shipped = F.when(st.isin("F", "O"), d + _days(F.lit(2)))
    delivered = F.when((st == "F") & (k % 50 != 0), d + _days(5 + k % 26) + _hours(F.lit(6)))
    return orders.select(
        F.concat(F.lit("o"), k.cast("string")).alias("order_id"),
        F.concat(F.lit("c"), k.cast("string")).alias("customer_id"),
        status.alias("order_status"),
        (d + _hours(k % 24)).alias("order_purchase_timestamp"),
        (d + _hours(k % 24 + 1)).alias("order_approved_at"),
        shipped.alias("order_delivered_carrier_date"),
        delivered.alias("order_delivered_customer_date"),
        (d + _days(F.lit(20))).alias("order_estimated_delivery_date"),
    )


def raw_orders_dirty(orders: DataFrame) -> DataFrame:
    """First four order fields with NULL keys and repeated order ids injected."""
    base = raw_orders(orders).select("order_id", "customer_id", "order_status", "order_purchase_timestamp")
    base = base.select(
        F.when(F.col("order_id") == "o0", F.lit(None).cast("string")).otherwise(F.col("order_id")).alias("order_id"),
        F.when(F.col("order_id").isin("o7", "o11"), F.lit(None).cast("string"))
        .otherwise(F.col("customer_id")).alias("customer_id"),
        "order_status", "order_purchase_timestamp",
    )
    copies = (base.filter(F.col("order_id").like("o%5"))
              .withColumn("order_purchase_timestamp", F.col("order_purchase_timestamp") + _hours(F.lit(1))))
    return base.unionByName(copies)


def raw_customers(orders: DataFrame, customer: DataFrame, nation: DataFrame) -> DataFrame:
    k, ck = F.col("o_orderkey"), F.col("o_custkey")
    # nation is the fixed 25-row TPC-H dimension, so broadcasting it is bounded.
    cust = customer.select("c_custkey", "c_nationkey").join(
        F.broadcast(nation.select("n_nationkey", "n_name")),
        F.col("c_nationkey") == F.col("n_nationkey"))
    joined = orders.select("o_orderkey", "o_custkey").join(cust, ck == F.col("c_custkey"))
    return joined.select(
        F.concat(F.lit("c"), k.cast("string")).alias("customer_id"),
        F.concat(F.lit("u"), ck.cast("string")).alias("customer_unique_id"),
        F.lpad((F.lit(1000) + ck % 900).cast("string"), 5, "0").alias("customer_zip_code_prefix"),
        F.concat(F.lit("city_"), F.col("c_nationkey").cast("string"), F.lit("_"),
                 F.when(k % 10 == 0, F.lit("1")).otherwise(F.lit("0"))).alias("customer_city"),
        F.col("n_name").alias("customer_state"),
    )


def raw_customers_dirty(orders: DataFrame, customer: DataFrame, nation: DataFrame) -> DataFrame:
    base = raw_customers(orders, customer, nation)
    base = base.withColumn(
        "customer_unique_id",
        F.when(F.col("customer_id").isin("c7", "c11"), F.lit(None).cast("string"))
        .otherwise(F.col("customer_unique_id")))
    copies = (base.filter(F.col("customer_id").like("c%5"))
              .withColumn("customer_city", F.concat(F.col("customer_city"), F.lit("_b"))))
    return base.unionByName(copies)


def raw_order_items(lineitem: DataFrame) -> DataFrame:
    price = F.when((F.col("l_discount") >= 0.095) & (F.col("l_quantity") <= 2), F.lit(0.0)) \
        .otherwise(F.col("l_extendedprice"))
    return lineitem.select(
        F.concat(F.lit("o"), F.col("l_orderkey").cast("string")).alias("order_id"),
        F.col("l_linenumber").cast("int").alias("order_item_id"),
        F.concat(F.lit("p"), F.col("l_partkey").cast("string")).alias("product_id"),
        F.concat(F.lit("s"), F.col("l_suppkey").cast("string")).alias("seller_id"),
        price.cast("decimal(18,2)").alias("price"),
        (F.col("l_quantity") * 0.5).cast("decimal(18,2)").alias("freight_value"),
    )


def raw_order_payments(orders: DataFrame) -> DataFrame:
    """One scan of orders fanned out to 1-2 payment rows per order."""
    k, prio = F.col("o_orderkey"), F.col("o_orderpriority")
    c = F.floor(F.col("o_totalprice")).cast("bigint") % 50000
    first_type = (F.when(prio == "1-URGENT", "voucher").when(prio == "2-HIGH", "debit_card")
                  .when(prio == "5-LOW", "boleto").otherwise("credit_card"))
    first_cents = F.when(prio == "1-URGENT", F.least(c, F.lit(2000))).otherwise(c)

    def row(keep: Column, seq: int, ptype: Column, cents: Column) -> Column:
        return F.struct(keep.alias("keep"), F.lit(seq).alias("seq"), ptype.alias("ptype"),
                        cents.cast("bigint").alias("cents"))

    rows = F.array(
        row(F.lit(True), 1, first_type, first_cents),
        row(prio == "1-URGENT", 2, F.lit("credit_card"), F.greatest(c - 2000, F.lit(0))),
        row(prio == "2-HIGH", 2, F.lit("voucher"), F.lit(0)),
    )
    exploded = (orders.filter(k % 97 != 0)
                .select(k.alias("k"), F.inline(F.filter(rows, lambda r: r["keep"]))))
    return exploded.select(
        F.concat(F.lit("o"), F.col("k").cast("string")).alias("order_id"),
        F.col("seq").cast("int").alias("payment_sequential"),
        F.col("ptype").alias("payment_type"),
        _cents_to_money(F.col("cents")).alias("payment_value"),
    )


def raw_order_reviews(events: DataFrame) -> DataFrame:
    e = F.col("event_id")
    et = F.col("event_type")
    message = (F.when(et.isin("click", "error"), F.lit(None).cast("string"))
               .when(et == "view", F.lit("   ")).otherwise(F.col("props")))
    ts = F.col("ts").cast("timestamp_ntz")
    return events.select(
        F.concat(F.lit("r"), e.cast("string")).alias("review_id"),
        F.concat(F.lit("o"), F.when(e % 7 == 1, e - 1).otherwise(e).cast("string")).alias("order_id"),
        (F.lit(1) + e % 6).cast("int").alias("review_score"),
        F.lit(None).cast("string").alias("review_comment_title"),
        message.alias("review_comment_message"),
        ts.alias("review_creation_date"),
        (ts + _days(F.lit(1))).alias("review_answer_timestamp"),
    )


def raw_products(part: DataFrame) -> DataFrame:
    size = F.col("p_size")
    return part.select(
        F.concat(F.lit("p"), F.col("p_partkey").cast("string")).alias("product_id"),
        F.when(F.col("p_brand") == "Brand#1", F.lit(None).cast("string"))
        .otherwise(F.col("p_type")).alias("product_category_name"),
        (size * 100).cast("double").alias("product_weight_g"),
        F.nullif(size % 10, F.lit(0)).cast("double").alias("product_length_cm"),
        size.cast("double").alias("product_height_cm"),
        (size + 1).cast("double").alias("product_width_cm"),
        F.nullif(size % 5, F.lit(0)).cast("int").alias("product_photos_qty"),
    )


def raw_sellers(supplier: DataFrame, nation: DataFrame) -> DataFrame:
    j = supplier.select("s_suppkey", "s_nationkey").join(
        F.broadcast(nation.select("n_nationkey", "n_name")),
        F.col("s_nationkey") == F.col("n_nationkey"))
    return j.select(
        F.concat(F.lit("s"), F.col("s_suppkey").cast("string")).alias("seller_id"),
        F.lpad(F.col("s_suppkey").cast("string"), 5, "0").alias("seller_zip_code_prefix"),
        F.concat(F.lit("city_"), F.col("s_nationkey").cast("string")).alias("seller_city"),
        F.col("n_name").alias("seller_state"),
    )


def raw_product_category_translation(part: DataFrame, n_translated: int = 4) -> DataFrame:
    """English names for the first ``n_translated`` categories in sort order.

    The distinct category list is aggregated map-side before its single
    small sort, so only one row per category crosses the shuffle.
    """
    cats = part.select(F.col("p_type").alias("product_category_name")).distinct()
    first = cats.orderBy("product_category_name").limit(n_translated)
    return first.select("product_category_name",
                        F.lower("product_category_name").alias("product_category_name_english"))


def raw_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """All eight raw tables (lazy) for one testdata scale factor."""
    def t(name: str) -> DataFrame:
        return load(spark, sf_dir, name)

    return LazyTables({
        "raw_orders": lambda: raw_orders(t("orders")),
        "raw_order_items": lambda: raw_order_items(t("lineitem")),
        "raw_order_payments": lambda: raw_order_payments(t("orders")),
        "raw_order_reviews": lambda: raw_order_reviews(t("events")),
        "raw_customers": lambda: raw_customers(t("orders"), t("customer"), t("nation")),
        "raw_products": lambda: raw_products(t("part")),
        "raw_sellers": lambda: raw_sellers(t("supplier"), t("nation")),
        "raw_product_category_translation": lambda: raw_product_category_translation(t("part")),
    })


def dirty_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Raw tables with injected NULL keys and duplicates (dedup / quality checks)."""
    def t(name: str) -> DataFrame:
        return load(spark, sf_dir, name)

    return LazyTables({
        "raw_orders": lambda: raw_orders_dirty(t("orders")),
        "raw_customers": lambda: raw_customers_dirty(t("orders"), t("customer"), t("nation")),
    })
