"""Shared helpers: tables in the cluster's shared folder, Arrow batch sizes, bounded samples."""

from __future__ import annotations

import gc
import tempfile
import uuid
import zipfile
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlake.session import checkpoint_dir

#: Rows of an Arrow batch sent to Python. Texts can be long, so it is far below Spark's 10,000.
ARROW_ROWS = 500


_SHIPPED: set[str] = set()


def prepare(spark: SparkSession) -> None:
    """Make a session ready for the package's Arrow functions.

    Workers get the package through Spark's own file distribution (they need
    not have it on their path), and an Arrow batch gets fewer rows where the
    session still has Spark's own default.
    """
    if spark.sparkContext.applicationId not in _SHIPPED:
        package = Path(__file__).resolve().parent.parent
        target = Path(tempfile.mkdtemp(prefix="orderlake-code-")) / f"{package.name}.zip"  # on the driver; Spark serves it
        with zipfile.ZipFile(target, "w") as z:
            for f in sorted(package.rglob("*.py")):
                z.write(f, f.relative_to(package.parent))
        spark.sparkContext.addPyFile(str(target))
        _SHIPPED.add(spark.sparkContext.applicationId)
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(key) == "10000":
        spark.conf.set(key, str(ARROW_ROWS))


#: What operators keep in a worker between its tasks and can make again.
KEPT: list[dict] = []


def let_go(own: dict | None = None) -> None:
    """Called in a worker as a task begins: what operators keep there goes, all but the caller's ``own``.

    The memory that Arrow holds for later use returns to the system.
    """
    others = [kept for kept in KEPT if kept and kept is not own]
    for kept in others:
        kept.clear()
    if others:
        gc.collect()
    pa.default_memory_pool().release_unused()


def new_folder(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared checkpoint folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/llm-{uuid.uuid4().hex}/{name}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to a table in the shared checkpoint folder and read it back.

    This cuts the lineage like ``checkpoint()``, but columnar, compressed and
    computed once; the files survive the loss of any executor.
    """
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def free_name(df: DataFrame, want: str) -> str:
    """``want``, or ``want`` with underscores added until it clashes with no column of ``df``."""
    taken = {c.lower() for c in df.columns}
    while want.lower() in taken:
        want += "_"
    return want


def bounded_sample(df: DataFrame, key: Column, n: int) -> DataFrame:
    """At most ``n`` rows of ``df``: those with the smallest hashes of ``key``; of rows that share a hash, the one whose own hash is smallest.

    The same rows whatever the partitioning. The border is found on the hashes
    alone, and the rows are gathered by hash, so no task holds them all.
    """
    mark = F.xxhash64(key)
    low = df.select(mark.alias("mark")).orderBy("mark").limit(n).agg(F.max("mark")).first()[0]
    if low is None:
        return df.limit(0)
    whole = F.struct(*df.columns)
    return df.filter(mark <= F.lit(low)).groupBy(mark.alias("mark_")).agg(F.min_by(whole, F.xxhash64(whole)).alias("row_")).select("row_.*")


def crc32_of(ids: Column) -> Column:
    """Unsigned crc32 of the decimal text of ``ids``, the hash that splits off held-out rows; null stays null."""
    return F.crc32(ids.cast("string").cast("binary"))
