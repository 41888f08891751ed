"""Layer runs (S7) and the full refresh of the warehouse.

A layer is a dict of builder functions; ``run_layer`` builds every table of a
layer from its inputs (lazy DataFrames). ``run_full_refresh`` materialises the
clean layer once, then builds the metrics layer from the written clean tables
(so the analytics jobs read compact Parquet instead of re-running the raw
lineage), and finishes with the data-quality report. Tables in a layer are
independent, so their order is free.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlake.operators import clean as C
from orderlake.operators import metrics as A
from orderlake.operators import quality as Q
from orderlake.sources.files import (ensure_database, publish_table, read_table, remove_old_versions,
                                     write_bucketed_table, write_table)

Builder = Callable[[dict[str, DataFrame]], DataFrame]

CLEAN_LAYER: dict[str, Builder] = {
    "orders": lambda r: C.clean_orders(r["raw_orders"]),
    "order_items": lambda r: C.clean_order_items(r["raw_order_items"], r["raw_products"],
                                                 r["raw_product_category_translation"]),
    "customers": lambda r: C.clean_customers(r["raw_customers"]),
    "payments": lambda r: C.clean_payments(r["raw_order_payments"]),
    "reviews": lambda r: C.clean_reviews(r["raw_order_reviews"]),
    "products": lambda r: C.clean_products(r["raw_products"], r["raw_product_category_translation"]),
    "sellers": lambda r: C.clean_sellers(r["raw_sellers"]),
}


def analytics_layer(min_month_orders: int = 100, review_weight: str = "per_row") -> dict[str, Builder]:
    return {
        "daily_revenue": lambda c: A.daily_revenue(c["orders"], c["payments"]),
        "monthly_revenue": lambda c: A.monthly_revenue(c["orders"], c["payments"], min_month_orders),
        "top_products": lambda c: A.top_products(c["order_items"], c["orders"], c["reviews"], review_weight),
        "top_categories": lambda c: A.top_categories(c["order_items"]),
        "customer_lifetime_value": lambda c: A.customer_lifetime_value(c["customers"], c["orders"], c["payments"]),
        "kpi_summary": lambda c: A.kpi_summary(c["orders"], c["payments"], c["reviews"], review_weight),
        "seller_performance": lambda c: A.seller_performance(c["order_items"], c["orders"], c["sellers"],
                                                             c["reviews"], review_weight),
        "geo_analysis": lambda c: A.geo_analysis(c["customers"], c["orders"], c["payments"], c["reviews"],
                                                 review_weight),
        "payment_analysis": lambda c: A.payment_analysis(c["orders"], c["payments"]),
        "cohort_retention": lambda c: A.cohort_retention(c["customers"], c["orders"]),
    }


def run_layer(layer: dict[str, Builder], inputs: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Build every table of a layer (an empty layer gives an empty dict, not an error)."""
    out = {}
    for name, build in layer.items():
        try:
            out[name] = build(inputs)
        except KeyError as missing:
            raise ValueError(f"table {name!r} needs {missing.args[0]!r}, which was not read") from missing
    return out


def layer_named(name: str, min_month_orders: int = 100) -> dict[str, Builder]:
    """The layer of that name; an unknown name raises a message that lists the known ones."""
    layers = {"clean": CLEAN_LAYER, "analytics": analytics_layer(min_month_orders)}
    if name not in layers:
        raise ValueError(f"no layer {name!r}; there are {', '.join(sorted(layers))}")
    return layers[name]


# Clean tables written bucketed: the per-order tables share the order_id
# bucketing, so the metrics joins on order_id read co-located buckets.
CLEAN_BUCKETS = {"orders": "order_id", "order_items": "order_id", "payments": "order_id",
                 "reviews": "order_id", "customers": "customer_id"}


def run_full_refresh(spark: SparkSession, raw: dict[str, DataFrame], warehouse: str,
                 min_month_orders: int = 100, publish: bool = False, buckets: int | None = None,
                 database_prefix: str = "", parallel_tables: int = 4, keep_versions: int | None = None) -> DataFrame:
    """Full refresh: clean → metrics → quality, each table written as a new version.

    The clean layer is written once (bucketed where joins need it, see
    ``CLEAN_BUCKETS``; ``buckets`` defaults to the shuffle partition count) and
    the metrics layer is built from those written tables. With ``publish``
    every version also becomes ``<prefix><layer>.<table>`` in the catalog
    (databases created when absent). The tables of one layer are independent,
    so up to ``parallel_tables`` of them are written as concurrent Spark jobs.
    Returns (layer, table_name, n_rows). With ``keep_versions``, older versions
    of every table that no reader has leased are removed at the end.
    """
    n_buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    written: list[tuple[str, str]] = []

    def db(layer: str) -> str:
        name = f"{database_prefix}{layer}"
        ensure_database(spark, name, f"{warehouse}/_catalog/{name}.db")
        return name

    def write(df: DataFrame, layer: str, name: str) -> DataFrame:
        if layer == "clean" and name in CLEAN_BUCKETS:
            ident = write_bucketed_table(df, f"{warehouse}/{layer}", db(layer), name, CLEAN_BUCKETS[name],
                                         n_buckets)
            source, out = ident, spark.table(ident)
        else:
            source = write_table(df, f"{warehouse}/{layer}", name)
            out = spark.read.parquet(source)
        if publish:
            publish_table(spark, db(layer), name, source)
        written.append((layer, name))
        return out

    def write_layer(tables: dict[str, DataFrame], layer: str) -> dict[str, DataFrame]:
        with ThreadPoolExecutor(max_workers=max(1, parallel_tables)) as pool:
            futures = {name: pool.submit(write, df, layer, name) for name, df in tables.items()}
            return {name: f.result() for name, f in futures.items()}

    db("clean"), db("analytics"), db("quality")      # create the databases before concurrent writes
    clean = write_layer(run_layer(CLEAN_LAYER, raw), "clean")
    write_layer(run_layer(analytics_layer(min_month_orders), clean), "analytics")
    write(Q.data_quality(raw["raw_orders"], raw["raw_order_payments"]), "quality", "checks")
    written.sort(key=lambda t: (["clean", "analytics", "quality"].index(t[0]), t[1]))
    counts = None
    for layer, name in written:
        c = read_table(spark, f"{warehouse}/{layer}", name).agg(F.count(F.lit(1)).alias("n_rows")) \
            .select(F.lit(layer).alias("layer"), F.lit(name).alias("table_name"), "n_rows")
        counts = c if counts is None else counts.unionByName(c)
        if keep_versions:
            remove_old_versions(spark, f"{warehouse}/{layer}", name, keep_versions, f"{database_prefix}{layer}")
    return counts
