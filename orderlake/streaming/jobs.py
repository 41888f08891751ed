"""Structured Streaming jobs (ST1–ST3; ST4 is ``status``, ST5 is ``refresh``).

ST1  order documents (JSON files) → validate → fan out to four raw tables
     plus rejects, in ``foreachBatch``. Documents are validated first; of the
     valid ones of an order one is kept, and every rejected one is kept. Micro-batch ``b`` of the run whose
     checkpoint has id ``r`` writes its tables under ``run=r/batch_id=b`` with
     overwrite, so a replay rewrites the same files, and a new checkpoint never
     touches another run's. A batch counts once its commit marker is written,
     after all its tables; readers see committed batches only, and of an order
     that came several times the batch committed first.
ST2  deduplicate a stream on a key within an event-time watermark.
ST3  daily revenue in 1-day tumbling windows; late rows beyond the watermark
     are dropped, updated windows are emitted per micro-batch.

Event-time columns are cast to TIMESTAMP before ``withWatermark`` (NTZ is
rejected by the watermark). Checkpoints must live on the shared file system.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from orderlake.operators.ingest import fan_out_orders
from orderlake.operators.quality import validate_orders
from orderlake.schemas import ORDER_DOCUMENT
from orderlake.sources.files import _fs

INGEST_TABLES = ("raw_customers", "raw_orders", "raw_order_items", "raw_order_payments")

#: Documents, of as many orders at most, whose keys a task of ``read_ingested`` holds in memory, at some 170 bytes each.
KEYS_A_TASK = 500_000


# ---------------------------------------------------------------- ST1

def ingest_batch(batch: DataFrame, batch_id: int, sink_root: str, run: str) -> None:
    """One micro-batch of ST1: validated rows to the raw tables, the rest to rejects, then the commit marker.

    Of the valid documents of one order in a batch the earliest purchase is
    kept, and of equally early ones the first as JSON text. Every rejected
    document is kept, with or without an id, however often it came. Whole
    documents move between tasks only if an order came twice, and then once.

    The batch is parsed once, into files that every table is read from: a task
    of a cached batch holds its whole share, and a compressed source file can
    not be split into smaller ones.
    """
    at = f"run={run}/batch_id={batch_id}"
    spark, parsed, once = batch.sparkSession, f"{sink_root}/parsed/{at}", f"{sink_root}/deduplicated/{at}"
    batch.write.mode("overwrite").option("compression", "zstd").parquet(parsed)
    batch = spark.read.schema(batch.schema).parquet(parsed)
    valid, rejected = validate_orders(batch)
    if not valid.groupBy("order_id").count().filter("count > 1").isEmpty():
        one_per_order(valid).write.mode("overwrite").option("compression", "zstd").parquet(once)
        valid = spark.read.schema(valid.schema).parquet(once)
    for name, df in fan_out_orders(valid).items():
        df.write.mode("overwrite").parquet(f"{sink_root}/{name}/{at}")
    rejected.write.mode("overwrite").parquet(f"{sink_root}/rejects/{at}")
    orders = batch.agg(F.count(F.lit(1)).alias("n_documents"), F.current_timestamp().alias("committed_at"))
    orders.write.mode("overwrite").parquet(f"{sink_root}/commits/{at}")
    for folder in (parsed, once):
        fs, path = _fs(spark, folder)
        fs.delete(path, True)


def one_per_order(valid: DataFrame) -> DataFrame:
    """Of each order's documents the one of the earliest purchase, of equally early ones the first as JSON text.

    The documents are spread by order first, so that the shuffle carries them
    alone and not also their JSON texts, which the aggregate makes as it reads.
    """
    whole = F.struct(*valid.columns)
    return valid.repartition("order_id").groupBy("order_id").agg(F.min_by(whole, F.struct("purchased_at", F.to_json(whole))).alias("_d")).select("_d.*")


def checkpoint_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that Spark keeps in a stream's checkpoint: the same after a restart, another for a new checkpoint."""
    return json.loads(spark.read.text(f"{checkpoint}/metadata").first()[0])["id"]


def start_order_ingest(spark: SparkSession, source_dir: str, sink_root: str, checkpoint: str,
                       available_now: bool = True, processing_time: str = "15 minutes",
                       max_files_per_trigger: int | None = None,
                       after_batch: Callable[[int], None] | None = None) -> StreamingQuery:
    """ST1: JSON order documents in ``source_dir`` → raw tables under ``sink_root``."""
    reader = spark.readStream.schema(ORDER_DOCUMENT)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.json(source_dir)

    def handle(df: DataFrame, batch_id: int) -> None:
        ingest_batch(df, batch_id, sink_root, checkpoint_id(spark, checkpoint))
        if after_batch is not None:
            after_batch(batch_id)

    w = stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time)
    return w.start()


def read_commits(spark: SparkSession, sink_root: str) -> DataFrame:
    """The committed batches: run, batch_id, n_documents, committed_at."""
    return spark.read.parquet(f"{sink_root}/commits").withColumn("run", F.col("run").cast("string"))


def read_ingested(spark: SparkSession, sink_root: str, name: str, batches: list[tuple[str, int]] | None = None) -> DataFrame:
    """The rows of a raw table (or ``rejects``) from committed batches, each order from the batch that committed it first.

    ``run`` and ``batch_id`` stay as columns. Customers follow the order that
    carried them. Of a rejected document, which need not have an id, all copies
    stay that the run brought that committed it first; a further run reads the
    same documents again. ``batches`` (run, batch_id) names the batches to
    read, instead of all: only their folders are opened.
    """
    commits = read_commits(spark, sink_root).select("run", "batch_id", "n_documents", F.unix_micros("committed_at").alias("at"))
    if batches is not None:
        commits = commits.join(spark.createDataFrame(batches, "run string, batch_id int"), ["run", "batch_id"], "left_semi")
    # One row a batch; ``_turn`` is its place in the order of the commits.
    in_turn = sorted(commits.collect(), key=lambda c: (c["at"], c["run"], c["batch_id"]))
    turns = spark.createDataFrame([(c["run"], c["batch_id"], i) for i, c in enumerate(in_turn)], "run string, batch_id int, _turn int")

    def committed(table: str) -> DataFrame:
        base = f"{sink_root}/{table}"
        if batches:
            rows = spark.read.option("basePath", base).parquet(*[f"{base}/run={r}/batch_id={b}" for r, b in batches])
        else:
            rows = spark.read.parquet(base)
            rows = rows if batches is None else rows.limit(0)
        return rows.withColumn("run", F.col("run").cast("string")).join(F.broadcast(turns), ["run", "batch_id"])

    rows = committed(name)
    if len(in_turn) < 2 or name == "rejects" and len({c["run"] for c in in_turn}) < 2:   # nothing came earlier
        return rows.drop("_turn")
    if name == "rejects":
        rows = rows.withColumn("_key", F.sha2(F.to_json(F.struct(*[c for c in rows.columns if c not in ("run", "batch_id", "_turn")])), 256))
        first = rows.groupBy(F.col("_key").alias("_of")).agg(F.min("_turn").alias("_first"))
        first = first.join(F.broadcast(turns.select(F.col("_turn").alias("_first"), F.col("run").alias("_run"))), "_first")
        return rows.join(first, (F.col("_key") == F.col("_of")) & (F.col("run") == F.col("_run"))).drop("_key", "_of", "_run", "_first", "_turn")
    # Validation leaves no null key. A hashed partition of short keys, so that no row of the table is sorted. It can not
    # spill, so the documents and not the session decide on the number of partitions.
    key = "customer_id" if name == "raw_customers" else "order_id"
    parts = max(spark.sparkContext.defaultParallelism, -(-sum(c["n_documents"] for c in in_turn) // KEYS_A_TASK))
    first = committed("raw_orders").select(F.col(key).alias("_key"), "_turn").repartition(parts, "_key").groupBy("_key").agg(F.min("_turn").alias("_first"))
    # No row is before its key's first; an equality would be a second join key, and both sides spread again by both.
    kept = (F.col(key) == F.col("_key")) & (F.col("_turn") <= F.col("_first"))
    return rows.repartition(parts, key).join(first.hint("shuffle_hash"), kept).drop("_key", "_first", "_turn")


# ---------------------------------------------------------------- ST2 / ST3

def dedup_stream(stream: DataFrame, key: str, ts_col: str, delay: str = "1 day") -> DataFrame:
    """ST2: drop repeated ``key`` values seen within the watermark delay."""
    s = stream.withColumn(ts_col, F.col(ts_col).cast("timestamp"))
    return s.withWatermark(ts_col, delay).dropDuplicatesWithinWatermark([key])


def daily_revenue_stream(stream: DataFrame, ts_col: str, value_col: str, delay: str = "1 day") -> DataFrame:
    """ST3: per 1-day window: summed value and row count."""
    s = stream.withColumn(ts_col, F.col(ts_col).cast("timestamp")).withWatermark(ts_col, delay)
    return s.groupBy(F.window(ts_col, "1 day").alias("w")).agg(
        F.sum(value_col).alias("revenue"), F.count(F.lit(1)).alias("n_rows")
    ).select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "revenue", "n_rows")


def run_to_parquet(result: DataFrame, out_dir: str, checkpoint: str, output_mode: str = "append") -> None:
    """Drive a streaming result to completion (available-now) into ``out_dir/batch_id=N``."""
    def sink(df: DataFrame, batch_id: int) -> None:
        df.write.mode("overwrite").parquet(f"{out_dir}/batch_id={batch_id}")

    q = (result.writeStream.outputMode(output_mode).foreachBatch(sink)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()


def latest_per_key(updates: DataFrame, keys: list[str]) -> DataFrame:
    """Collapse update-mode output: for each key keep the row of the latest batch."""
    vals = [c for c in updates.columns if c not in keys and c != "batch_id"]
    last = updates.groupBy(*keys).agg(F.max_by(F.struct(*vals), "batch_id").alias("_v"))
    return last.select(*keys, *[F.col(f"_v.{c}").alias(c) for c in vals])
