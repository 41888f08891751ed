"""Raw CSV source (S1/S2) and versioned table sink/source.

CSV files are read with the declared raw schemas (never inferred), every one of
them by many tasks: the fields of reviews may span lines, so their records are
put together by ``records``. Timestamp columns are read as text and cast to
TIMESTAMP_NTZ, which is the raw-text → timestamp conversion of the clean layer.
A missing file is logged and skipped. ``read_raw`` raises on a malformed cell;
``load_raw`` keeps the good rows and returns the bad ones beside them.

Tables are written as immutable versions ``<root>/<name>/v=<version>`` and a
reader always opens the newest version that finished (has ``_SUCCESS``), so a
refresh that dies half-way never exposes a partial table. Paths must be on the
shared file system (the warehouse root or the checkpoint folder).
"""

from __future__ import annotations

import datetime as dt
import logging
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderlake.schemas import RAW_SCHEMAS
from orderlake.sources.records import CSV_OPTIONS, csv_records, parse_checked, parse_strict

log = logging.getLogger(__name__)


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def _text_schema(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, T.StringType() if isinstance(f.dataType, T.TimestampNTZType)
                                       else f.dataType, True) for f in schema.fields])


#: Tables whose quoted fields may hold line breaks.
MULTI_LINE = frozenset({"raw_order_reviews"})


def read_csv_table(spark: SparkSession, path: str, schema: T.StructType, multi_line: bool = False) -> DataFrame:
    if multi_line:
        return parse_strict(csv_records(spark, path, True), schema, (T.TimestampNTZType,))
    df = (spark.read.schema(_text_schema(schema))
          .option("header", True).options(**CSV_OPTIONS).option("mode", "FAILFAST").csv(path))
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def read_raw(spark: SparkSession, directory: str, files: dict[str, str] | None = None) -> dict[str, DataFrame]:
    """The raw tables found in ``directory`` (``<table>.csv`` unless mapped in ``files``)."""
    files = files or {name: f"{name}.csv" for name in RAW_SCHEMAS}
    return {name: read_csv_table(spark, path, RAW_SCHEMAS[name], name in MULTI_LINE) for name, path in _present(spark, directory, files)}


def _present(spark: SparkSession, directory: str, files: dict[str, str]) -> list[tuple[str, str]]:
    out = []
    for name, fname in files.items():
        path = f"{directory.rstrip('/')}/{fname}"
        if path_exists(spark, path):
            out.append((name, path))
        else:
            log.warning("raw file missing, skipped: %s", path)
    return out


REJECTS = "table_name string, record string, problems array<struct<column: string, value: string, reason: string>>"


def load_raw(spark: SparkSession, directory: str, staging: str, files: dict[str, str] | None = None) -> tuple[dict[str, DataFrame], DataFrame]:
    """S1/S2 for imperfect files: (raw tables, rejected records).

    A record goes to the table if it has the table's fields and every cell has
    its column's type (an empty one is NULL); else it goes to the rejects as it
    stands in the file, with each offending column, cell and reason. So the two
    add up to the file's records. ``staging`` is a folder on the shared file
    system where both are written, each file being parsed once.
    """
    tables, rejects = {}, spark.createDataFrame([], REJECTS)
    for name, path in _present(spark, directory, files or {n: f"{n}.csv" for n in RAW_SCHEMAS}):
        checked = parse_checked(csv_records(spark, path, name in MULTI_LINE), RAW_SCHEMAS[name])
        at = f"{staging.rstrip('/')}/{name}"
        good = F.size("problems") == 0
        checked.withColumn("good", good).withColumn("value", F.when(~good, F.col("value"))).write.partitionBy("good").parquet(at)
        parsed = spark.read.schema(checked.withColumn("good", F.lit(True)).schema).parquet(at)
        tables[name] = parsed.filter("good").select("row.*")
        rejects = rejects.unionByName(parsed.filter("not good").select(F.lit(name).alias("table_name"), F.col("value").alias("record"), "problems"))
    return tables, rejects


def write_csv_table(df: DataFrame, path: str) -> None:
    """Write one raw table as CSV with a header (used to stage raw exports)."""
    (df.write.mode("overwrite").option("header", True).option("escape", '"')
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
     .option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss.SSSSSS").csv(path))


# ---------------------------------------------------------------- tables

def ensure_database(spark: SparkSession, name: str, location: str | None = None) -> None:
    """Create the schema (database) when absent."""
    loc = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`{loc}")


def new_version() -> str:
    return dt.datetime.now(dt.timezone.utc).strftime("%Y%m%dT%H%M%S%f")


def write_table(df: DataFrame, root: str, name: str, partition_by: list[str] | None = None) -> str:
    """Write a full refresh of table ``name`` as a new immutable version; returns its path."""
    path = f"{root.rstrip('/')}/{name}/v={new_version()}"
    w = df.write.mode("errorifexists")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path


def write_bucketed_table(df: DataFrame, root: str, database: str, name: str, key: str,
                         buckets: int) -> str:
    """Write a new version bucketed (and sorted) by ``key``; returns its catalog table name.

    Tables bucketed on the same key into the same number of buckets join
    without an exchange. The version lives at ``<root>/<name>/v=<version>``
    (external table: dropping the catalog entry never deletes data).
    """
    version = new_version()
    path = f"{root.rstrip('/')}/{name}/v={version}"
    ident = f"`{database}`.`{name}__v{version}`"
    # Hash partitioning into ``buckets`` uses the bucket hash, so every task
    # writes exactly one bucket file (instead of one file per task and bucket).
    (df.repartition(buckets, key).write.mode("errorifexists").format("parquet")
     .bucketBy(buckets, key).sortBy(key).option("path", path).saveAsTable(ident))
    return ident


def latest_version(spark: SparkSession, root: str, name: str) -> str | None:
    fs, p = _fs(spark, f"{root.rstrip('/')}/{name}")
    if not fs.exists(p):
        return None
    done = []
    for st in fs.listStatus(p):
        child = st.getPath()
        if st.isDirectory() and child.getName().startswith("v=") and \
                fs.exists(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(child, "_SUCCESS")):
            done.append(child.toString())
    return max(done) if done else None


def publish_table(spark: SparkSession, database: str, name: str, source: str) -> None:
    """Make ``database.name`` read a written version.

    ``source`` is a version path or a versioned catalog table. The name is a
    view replaced in one catalog operation, so readers of ``spark.table`` see
    either the previous complete version or the new one, never a partial
    write; a bucketed version keeps its bucketing through the view.
    """
    ensure_database(spark, database)
    target = source if source.startswith("`") else f"parquet.`{source}`"
    spark.sql(f"CREATE OR REPLACE VIEW `{database}`.`{name}` AS SELECT * FROM {target}")


def read_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """The newest complete version of table ``name``."""
    path = latest_version(spark, root, name)
    if path is None:
        raise FileNotFoundError(f"no complete version of table {name!r} under {root}")
    return spark.read.parquet(path)


# ---------------------------------------------------------------- retention

def lease_version(spark: SparkSession, root: str, name: str, seconds: int = 3600) -> tuple[str, str]:
    """(path of the newest complete version, lease): the version is not removed before the lease ends or is released."""
    while True:
        path = latest_version(spark, root, name)
        if path is None:
            raise FileNotFoundError(f"no complete version of table {name!r} under {root}")
        until = int(dt.datetime.now(dt.timezone.utc).timestamp()) + seconds
        lease = f"{root.rstrip('/')}/{name}/leases/{path.rsplit('=', 1)[1]}-{until}-{uuid.uuid4().hex}"
        fs, p = _fs(spark, lease)
        fs.create(p).close()
        if path_exists(spark, f"{path}/_SUCCESS"):   # not removed meanwhile
            return path, lease
        fs.delete(p, False)


def release(spark: SparkSession, lease: str) -> None:
    fs, p = _fs(spark, lease)
    fs.delete(p, False)


def remove_old_versions(spark: SparkSession, root: str, name: str, keep: int = 2, database: str | None = None) -> list[str]:
    """Remove the versions of table ``name`` that nobody needs: returns them, oldest first.

    Kept are the ``keep`` newest complete versions, all that a lease holds, and
    whatever is newer than the newest complete one (it may still be written).
    With ``database``, the catalog tables of bucketed versions go too.
    """
    if keep < 1:
        raise ValueError("at least the newest version stays")
    base = f"{root.rstrip('/')}/{name}"
    fs, p = _fs(spark, base)
    if not fs.exists(p):
        return []
    versions = sorted(s.getPath().getName().removeprefix("v=") for s in fs.listStatus(p) if s.getPath().getName().startswith("v="))
    complete = [v for v in versions if path_exists(spark, f"{base}/v={v}/_SUCCESS")]
    held, now = set(complete[-keep:]), int(dt.datetime.now(dt.timezone.utc).timestamp())
    _, leases = _fs(spark, f"{base}/leases")
    for s in fs.listStatus(leases) if fs.exists(leases) else []:
        version, until, _ = s.getPath().getName().split("-")
        if int(until) > now:
            held.add(version)
        else:
            fs.delete(s.getPath(), False)
    gone = [v for v in versions if v not in held and complete and v < complete[-1]]
    for v in gone:
        if database:
            spark.sql(f"DROP TABLE IF EXISTS `{database}`.`{name}__v{v}`")
        fs.delete(_fs(spark, f"{base}/v={v}")[1], True)
    return gone
