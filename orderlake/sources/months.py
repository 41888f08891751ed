"""Tables stored by month, replaced month by month.

``<root>/<name>/data/month=<m>/version=<v>/`` holds the rows of one month as
one version wrote them; ``<root>/<name>/commits/version=<v>/`` lists the months
that the version replaced, and is written last. A month's rows are those of the
newest version that committed it. A version that dies half-way is never seen,
writing it again overwrites its own folders alone, and a reader who has listed
the live folders keeps them whatever is written meanwhile.

Reading names the live folders of the wanted months, so no other file is
listed or opened. A batch touches few months: the months of all commits are
calendar-bounded and fit the driver.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderlake.sources.files import _fs, new_version, path_exists

Month = dt.date | None

#: The folder name that Spark gives a NULL partition value.
_NULL = "__HIVE_DEFAULT_PARTITION__"
_COMMIT = "month date, has_rows boolean, version string"


def months_of(df: DataFrame, month: Column | str = "month") -> list[Month]:
    """The distinct months of a batch, ascending, NULL first."""
    found = {r[0] for r in df.select(F.col(month) if isinstance(month, str) else month).distinct().collect()}
    return sorted(found, key=lambda m: (m is not None, m or dt.date.min))


def of_months(month: Column, months: Iterable[Month]) -> Column:
    """Whether ``month`` is one of ``months`` (NULL among them means NULL)."""
    months = list(months)
    known = month.isin([m for m in months if m is not None])
    return F.coalesce(known, F.lit(None in months))


def _folder(root: str, name: str, month: Month, version: str) -> str:
    return f"{root.rstrip('/')}/{name}/data/month={_NULL if month is None else month.isoformat()}/version={version}"


def replace_months(df: DataFrame, root: str, name: str, months: Iterable[Month], version: str | None = None) -> str:
    """Make ``df`` (with a date column ``month``) the rows of ``months``, in a new version; returns the version.

    A month without rows in ``df`` becomes empty. Rows of other months are an
    error of the caller's: their version is written, but not committed.
    """
    spark, version, months = df.sparkSession, version or new_version(), list(months)
    base = f"{root.rstrip('/')}/{name}"
    (df.withColumn("version", F.lit(version)).repartition("month").write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("month", "version").parquet(f"{base}/data"))
    rows = [(m, path_exists(spark, _folder(root, name, m, version)), version) for m in months]
    (spark.createDataFrame(rows, _COMMIT).coalesce(1).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("version").parquet(f"{base}/commits"))
    return version


def live_versions(spark: SparkSession, root: str, name: str) -> dict[Month, str | None]:
    """Each committed month's newest version, None where that left the month empty."""
    commits = f"{root.rstrip('/')}/{name}/commits"
    if not path_exists(spark, commits):
        return {}
    newest = spark.read.schema(_COMMIT).parquet(commits).groupBy("month").agg(
        F.max(F.struct("version", "has_rows")).alias("last"))
    return {r["month"]: r["last"]["version"] if r["last"]["has_rows"] else None for r in newest.collect()}


def read_months(spark: SparkSession, root: str, name: str, schema: T.StructType | None = None,
                months: Iterable[Month] | None = None) -> DataFrame:
    """The live rows of ``months`` (default: all), with their column ``month``.

    Where there are none, the result is empty if ``schema`` (the table's, with
    ``month``) is given; without it a table that was never written is an error.
    """
    live = live_versions(spark, root, name)
    wanted = live if months is None else {m: live.get(m) for m in months}
    folders = [_folder(root, name, m, v) for m, v in wanted.items() if v is not None]
    if not folders:
        known = [_folder(root, name, m, v) for m, v in live.items() if v is not None][:1]
        if schema is None and not known:
            raise FileNotFoundError(f"table {name!r} has no rows under {root}")
        return spark.createDataFrame([], schema) if schema else _read(spark, root, name, known).limit(0)
    return _read(spark, root, name, folders)


def _read(spark: SparkSession, root: str, name: str, folders: list[str]) -> DataFrame:
    df = spark.read.option("basePath", f"{root.rstrip('/')}/{name}/data").parquet(*folders)
    return df.withColumn("month", F.col("month").cast("date")).drop("version")


def remove_replaced(spark: SparkSession, root: str, name: str, keep_since: str) -> list[str]:
    """Delete the folders of versions older than ``keep_since`` that no month shows any more; returns them.

    ``keep_since`` is the version (time) from which readers may still hold a
    listing; commits stay, they are small.
    """
    live, gone = live_versions(spark, root, name), []
    fs, data = _fs(spark, f"{root.rstrip('/')}/{name}/data")
    if not fs.exists(data):
        return gone
    shown = {_folder(root, name, m, v).rsplit("/data/", 1)[1] for m, v in live.items() if v is not None}
    for month in fs.listStatus(data):
        if not month.isDirectory() or not month.getPath().getName().startswith("month="):
            continue
        for old in fs.listStatus(month.getPath()):
            version = old.getPath().getName()
            place = f"{month.getPath().getName()}/{version}"
            if place not in shown and version.removeprefix("version=") < keep_since:
                fs.delete(old.getPath(), True)
                gone.append(place)
    return sorted(gone)
