"""Distributed RANK / ROW_NUMBER without a single-partition window.

``Window.orderBy(...)`` without ``partitionBy`` (a global rank) plans as
``Exchange SinglePartition``, and ``partitionBy(category)`` sends a whole
category to one task. Both break when one group holds a large share of rows.

Here the rows are range-partitioned on (partition keys, order value, tie
breaks) — Spark samples the bounds, so a hot key is split over many tasks —
sorted within each partition and tagged with ``monotonically_increasing_id``
(partition index in the upper bits, position in the lower 33 bits). The tagged
frame is checkpointed to the reliable checkpoint folder so the positions stay
fixed on retries. Per-partition row counts (one row per partition, a proven
size bound) are turned into offsets and broadcast, which gives every row its
global position. Then

* ROW_NUMBER = position - first position of its key + 1
* RANK       = first position of its (key, value) - first position of its key + 1

(first positions come from a grouped ``min``, combined map-side), which equals
SQL RANK with gaps after ties. Ordering follows PostgreSQL: DESC sorts NULLs
first, ASC last; a NULL key is one group of its own.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orderlake.session import checkpoint_dir

_MID, _PID, _POS, _OFF = "_rk_mid", "_rk_pid", "_rk_pos", "_rk_off"


def _join_first(pos: DataFrame, cols: Sequence[str], name: str) -> DataFrame:
    """Join ``min(position)`` per ``cols`` group back onto every row as ``name``."""
    alias = {c: f"{name}_k{i}" for i, c in enumerate(cols)}
    firsts = pos.groupBy(*cols).agg(F.min(_POS).alias(name)).select(
        *[F.col(c).alias(a) for c, a in alias.items()], name)
    cond = None
    for c, a in alias.items():
        e = F.col(c).eqNullSafe(F.col(a))
        cond = e if cond is None else cond & e
    return pos.join(firsts, cond).drop(*alias.values())


def range_stage(df: DataFrame, order: Sequence, n: int) -> DataFrame:
    """Range-partition on the full ordering, sort each partition, tag global order ids.

    The bounds are sampled over (keys, value, tie breaks), so one hot key is
    split across as many partitions as its share of rows needs.
    """
    return (df.repartitionByRange(n, *order)
            .sortWithinPartitions(*order)
            .withColumn(_MID, F.monotonically_increasing_id()))


def rank_over(df: DataFrame, order_col: str, *, partition_by: Sequence[str] = (),
              descending: bool = True, method: str = "rank", tie_break: Sequence[str] = (),
              out: str = "rank", num_partitions: int | None = None) -> DataFrame:
    """Add ``out`` (BIGINT) = RANK() or ROW_NUMBER() OVER (PARTITION BY keys ORDER BY order_col).

    ``tie_break`` columns extend the ordering (needed for a deterministic
    ROW_NUMBER). The input should already be an aggregate (one row per ranked
    entity); the rank itself never moves a group into a single task.
    """
    if method not in ("rank", "row_number"):
        raise ValueError(f"unknown method {method!r}")
    spark = df.sparkSession
    checkpoint_dir(spark)
    keys = list(partition_by)
    v = F.col(order_col)
    order = ([F.col(k).asc_nulls_last() for k in keys]
             + [v.desc_nulls_first() if descending else v.asc_nulls_last()]
             + [F.col(t).asc_nulls_last() for t in tie_break])
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))

    staged = range_stage(df, order, n).checkpoint(eager=True)

    pid = F.shiftright(F.col(_MID), 33)
    counts = staged.groupBy(pid.alias(_PID)).agg(F.count(F.lit(1)).alias("_rk_n"))
    # At most one row per range partition: a fixed, small frame.
    before = Window.orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(_PID, F.coalesce(F.sum("_rk_n").over(before), F.lit(0)).alias(_OFF))
    pos = (staged.join(F.broadcast(offsets), pid == F.col(_PID))
           .withColumn(_POS, F.col(_OFF) + F.col(_MID) - F.shiftleft(F.col(_PID), 33))
           .drop(_PID, _OFF, _MID))

    if method == "row_number":
        first = F.col(_POS)
    else:
        pos = _join_first(pos, keys + [order_col], "_rk_vstart")
        first = F.col("_rk_vstart")
    if keys:
        pos = _join_first(pos, keys, "_rk_kstart")
        start = F.col("_rk_kstart")
    else:
        start = F.lit(0)

    result = pos.withColumn(out, (first - start + 1).cast("bigint"))
    return result.drop(_POS, "_rk_vstart", "_rk_kstart")


def exact_medians(df: DataFrame, value_cols: Sequence[str], group_cols: Sequence[str] = ()) -> DataFrame:
    """Exact medians of several columns per group in one distributed numbering.

    The columns are stacked into (groups, feature, value) rows, numbered once
    with the feature as an extra partition key, and pivoted back to one row per
    group with ``<col>_med`` columns (DOUBLE).
    """
    groups = list(group_cols)
    stacked = df.select(*groups, F.explode(F.array(*[
        F.struct(F.lit(c).alias("_md_f"), F.col(c).cast("double").alias("_md_v")) for c in value_cols
    ])).alias("_md_s")).select(*groups, "_md_s._md_f", "_md_s._md_v")
    med = exact_median(stacked, "_md_v", groups + ["_md_f"], out="_md_med")
    return med.groupBy(*groups).agg(*[
        F.max(F.when(F.col("_md_f") == c, F.col("_md_med"))).alias(f"{c}_med") for c in value_cols])


def exact_median(df: DataFrame, value_col: str, group_cols: Sequence[str] = (), out: str | None = None) -> DataFrame:
    """Exact median of ``value_col`` per group (mean of the two middle values when even).

    Built on the distributed row numbering, so no group's values are buffered
    in one task (``percentile``/``median`` aggregates would). NULL values are
    skipped; groups are compared null-safely. Returns (groups..., out) as DOUBLE.
    """
    out = out or f"{value_col}_med"
    groups = list(group_cols)
    vals = df.select(*groups, value_col).filter(F.col(value_col).isNotNull())
    rn = rank_over(vals, value_col, partition_by=groups, descending=False,
                   method="row_number", out="_md_rn")
    counts = vals.groupBy(*groups).agg(F.count(F.lit(1)).alias("_md_n"))
    alias = {c: f"_md_k{i}" for i, c in enumerate(groups)}
    counts = counts.select(*[F.col(c).alias(a) for c, a in alias.items()], "_md_n")
    cond = F.lit(True)
    for c, a in alias.items():
        cond = cond & F.col(c).eqNullSafe(F.col(a))
    j = rn.join(F.broadcast(counts) if not groups else counts, cond).drop(*alias.values())
    n, r = F.col("_md_n"), F.col("_md_rn")
    middle = j.filter((r == F.floor((n + 1) / 2)) | (r == F.floor(n / 2) + 1))
    return middle.groupBy(*groups).agg(F.avg(F.col(value_col).cast("double")).alias(out))
