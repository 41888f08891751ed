"""ST4: the status of every ingested order, advanced cycle by cycle.

Only open orders (processing, shipped) can move, so they are kept apart:

* ``open/cycle=<c>/`` holds the open orders as cycle ``c`` left them; the next
  cycle reads it, adds the orders that arrived since, and writes the next one.
* ``closed/cycle=<c>/month=<m>/`` holds the orders that left the open ones in
  cycle ``c``, under their purchase month. They are never written again but by
  ``compact``, which gathers the small files of many cycles.
* ``cycles/cycle=<c>/`` is written last and lists the ingest batches that the
  cycle took. A cycle without it does not count, and running it again
  overwrites what it left.

So a cycle writes as many rows as there are open orders and those that close
in it, however many orders have closed before. An order's rows are its open one
if it is open, else its closed one; each order is in one place only.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlake.functions.dates import month_start
from orderlake.operators.lifecycle import advance_status
from orderlake.sources.files import _fs, path_exists
from orderlake.sources.months import months_of, of_months
from orderlake.streaming.jobs import read_commits, read_ingested

#: Statuses that a cycle can still move.
OPEN_STATUSES = ("processing", "shipped")
DEFAULT_FLOOR = dt.datetime(2026, 1, 1)


def _cycles(spark: SparkSession, root: str) -> list[int]:
    """The finished cycles, ascending."""
    if not path_exists(spark, f"{root}/cycles"):
        return []
    return sorted(r[0] for r in spark.read.parquet(f"{root}/cycles").select("cycle").distinct().collect())


def _closed_folders(spark: SparkSession, root: str, cycles: list[int]) -> list[str]:
    """The closed folders that count: the newest compaction's, and those of the cycles after it."""
    compacted = max((c for c in cycles if path_exists(spark, f"{root}/closed/upto={c}/_SUCCESS")), default=None)
    folders = [f"{root}/closed/upto={compacted}"] if compacted is not None else []
    return folders + [f"{root}/closed/cycle={c}" for c in cycles if compacted is None or c > compacted]


def _read(spark: SparkSession, schema, folders: list[str]) -> DataFrame:
    """The rows of ``folders``, each with its own month folders."""
    out = spark.createDataFrame([], schema)
    for f in folders:
        if path_exists(spark, f):
            out = out.unionByName(spark.read.schema(schema).parquet(f))
    return out


def advance_ingested(spark: SparkSession, sink_root: str, root: str, as_of: dt.datetime, floor: dt.datetime = DEFAULT_FLOOR) -> int:
    """Advance the open orders as of ``as_of`` in a new cycle under ``root``; returns its number.

    The orders of ingest batches that no cycle has taken join the open ones
    first; an order that an earlier batch brought is not taken again. Statuses
    other than the open ones close at once.
    """
    cycles = _cycles(spark, root)
    cycle = cycles[-1] + 1 if cycles else 0
    commits = read_commits(spark, sink_root).select("run", "batch_id")
    taken = spark.read.parquet(f"{root}/cycles").filter(F.col("run").isNotNull()).select(F.col("run").cast("string").alias("run"), "batch_id") if cycles else commits.limit(0)
    new = commits.join(taken, ["run", "batch_id"], "left_anti")
    batches = [(r["run"], r["batch_id"]) for r in new.collect()]

    arrived = read_ingested(spark, sink_root, "raw_orders", batches).drop("run", "batch_id") \
        .withColumn("month", month_start("order_purchase_timestamp"))
    schema = arrived.withColumn("moved_cycle", F.lit(0).cast("bigint")).withColumn("shipped_now", F.lit(True)).withColumn("delivered_now", F.lit(True)).schema
    if cycles:
        before = spark.read.schema(schema).parquet(f"{root}/open/cycle={cycles[-1]}")
        known = before.select("order_id")
        if batches:  # an order's month does not change, so its closed row can only be in one of these
            closed = _read(spark, schema, _closed_folders(spark, root, cycles))
            known = known.unionByName(closed.filter(of_months(F.col("month"), months_of(arrived))).select("order_id"))
        arrived = arrived.join(known, "order_id", "left_anti").unionByName(before.select(arrived.columns))

    moved = advance_status(arrived, as_of, floor).withColumn("moved_cycle", F.lit(cycle).cast("bigint")).select(*[f.name for f in schema.fields])
    fresh = f"{root}/advanced/cycle={cycle}"   # both halves come from one computation
    moved.write.mode("overwrite").parquet(fresh)
    moved = spark.read.schema(schema).parquet(fresh)
    still = F.coalesce(F.col("order_status").isin(*OPEN_STATUSES), F.lit(False))
    moved.filter(still).write.mode("overwrite").parquet(f"{root}/open/cycle={cycle}")
    moved.filter(~still).repartition("month").write.mode("overwrite").partitionBy("month").parquet(f"{root}/closed/cycle={cycle}")
    marker = batches or [(None, None)]
    spark.createDataFrame(marker, "run string, batch_id int").coalesce(1).write.mode("overwrite").parquet(f"{root}/cycles/cycle={cycle}")
    fs, path = _fs(spark, fresh)
    fs.delete(path, True)
    return cycle


def read_status(spark: SparkSession, root: str, sink_root: str) -> DataFrame:
    """Every order with its status after the last finished cycle.

    ``shipped_now`` and ``delivered_now`` tell what that cycle moved.
    """
    cycles = _cycles(spark, root)
    if not cycles:
        raise FileNotFoundError(f"no finished cycle under {root}")
    now = spark.read.parquet(f"{root}/open/cycle={cycles[-1]}")
    rows = now.unionByName(_read(spark, now.schema, _closed_folders(spark, root, cycles)))
    this = F.col("moved_cycle") == cycles[-1]
    return rows.withColumn("shipped_now", F.col("shipped_now") & this).withColumn("delivered_now", F.col("delivered_now") & this) \
        .drop("month", "moved_cycle")


def compact(spark: SparkSession, root: str) -> None:
    """Gather the closed rows of all finished cycles in one folder, a file or so a month, and drop what no reader needs any more.

    Readers that started before keep working until the folders go, so call it
    when none is running.
    """
    cycles = _cycles(spark, root)
    if not cycles:
        return
    now = spark.read.parquet(f"{root}/open/cycle={cycles[-1]}")
    folders, target = _closed_folders(spark, root, cycles), f"{root}/closed/upto={cycles[-1]}"
    if folders != [target]:
        _read(spark, now.schema, folders).repartition("month").write.mode("overwrite").partitionBy("month").parquet(target)
    for old in [f for f in folders if f != target] + [f"{root}/open/cycle={c}" for c in cycles[:-1]]:
        fs, path = _fs(spark, old)
        fs.delete(path, True)
