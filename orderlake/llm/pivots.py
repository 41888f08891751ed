"""Operator 5: near-duplicate vectors by a pivot-permutation index.

A bounded number of reference vectors (pivots) is drawn from the data and
thinned until no two are near. A vector within CORE of a pivot belongs to its
nearest one's ball; every vector that can link with a member by the triangle
inequality is a guest there, so links of members are found exactly, however
large a group of near copies is. Each other vector is described by its nearest
pivots in order, and stands in the inverted list of each of them; two of these
are compared if they share enough pivots (one, as the list is compared in any
case), which finds most of their links, not surely all. With ``core=-1`` every
vector belongs to a ball, so that no link at all is missed, at the cost of more
guests. A vector is a guest of a ball only if it may link with a member by the
ball's radius and by the two pivots' distances from it: a member is nearest to
its own pivot, so the ball's pivot is at most twice the links' angle farther
than the vector's nearest one. There is one list for each label and ball or pivot; a pair is compared in its smaller ball or in the
list of the smallest pivot that it shares, so it counts once. Equal vectors are
one node.

Long lists (a label or a group of near copies may hold much of all rows) are
cut into chunks, and each pair of chunks is a task of bounded size. A task
reports, for each vector, how many it links with and one vector of its local
component, so what leaves a task is linear in what it read, however many pairs
link.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlake.llm._components import components
from orderlake.llm._io import bounded_sample, prepare, stage
from orderlake.llm._vectors import exact_cosine, unit, usable

#: Nearest pivots that describe a vector, and how many of them a compared pair shares at least.
NEAREST, SHARED = 8, 1
#: Cosine to its nearest pivot from which a vector belongs to that pivot's ball; no two pivots are this near.
CORE = 0.8
#: Pivots: about the square root of the number of vectors, between these.
FEWEST_PIVOTS, MOST_PIVOTS = 64, 4096
#: Vectors of a chunk of a list.
CHUNK = 512


def pivot_count(n: int) -> int:
    return min(MOST_PIVOTS, max(FEWEST_PIVOTS, 1 << round(math.log2(max(1, n)) / 2)))


def padded(column: pa.Array, wide: int) -> np.ndarray:
    """Vectors as unit rows of ``wide`` components; zeros at the end change no cosine between vectors of one length."""
    full = np.zeros((len(column), wide))
    for i, v in enumerate(column):
        full[i, :len(v)] = v.values
    return unit(full) if len(full) else full


def thinned(units: np.ndarray, core: float) -> np.ndarray:
    """The rows of ``units`` but those whose cosine with an earlier one that stays reaches ``core``."""
    stays = np.ones(len(units), bool)
    for i in range(len(units)):
        if stays[i]:
            stays[i + 1:] &= units[i + 1:] @ units[i] < core
    return units[stays]


def linked_vectors(df: DataFrame, threshold: float = 0.93, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
                   nearest: int = NEAREST, shared: int = SHARED, core: float = CORE) -> DataFrame:
    """One row per row of ``df``: ``id_col``, n_links, component_id, kept.

    Rows are linked if their labels are equal and not null and their vectors'
    cosine reaches ``threshold``. n_links counts the rows linked directly;
    component_id is the smallest id reachable (its own included); kept says
    that it is the row's own. Rows with a null label or with a vector that is
    null, empty, zero or holds a null or non-finite component link with
    nothing. Rows with a null id take part; their component is the smallest id
    that is not null, or null (not kept). Repeated ids count row by row.
    Vectors of different lengths are never linked. Links of vectors within
    ``core`` of a pivot are complete; of a pair that has no pivot as near, a
    link may be missed. ``core=-1`` gives all links of all vectors: where no
    pivot is near to most vectors, it compares about all pairs, in cells of
    bounded size.
    """
    spark = df.sparkSession
    prepare(spark)
    part = F.col("label").isNotNull() & usable(F.col("v"))
    rows = df.select(F.col(id_col).alias("id"), F.col(label_col).alias("label"), F.col(vector_col).alias("v"))
    able = rows.filter(part).withColumn("key", F.xxhash64("label", "v"))
    nodes = able.groupBy("label", "v").agg(F.min("id").alias("low"), F.count("*").alias("n"), F.first("key").alias("key"))
    nodes = stage(nodes.withColumn("node", F.xxhash64("key", "label", "v")), "nodes")
    n = nodes.count()
    wide = nodes.agg(F.max(F.size("v"))).first()[0] or 0
    sample = bounded_sample(nodes.select("node", "v"), F.col("node"), pivot_count(n)).orderBy("node")
    pivots = thinned(padded(sample.select("v").toArrow().column(0), wide), CORE) if n else np.zeros((1, 0))
    total = len(pivots)  # also the ball of vectors that belong to none; lists from here on are those of pivots
    nearest = min(nearest, total)
    shared = min(shared, nearest)
    reach = math.acos(max(-1.0, min(1.0, threshold)))

    def belong(batches):
        for batch in batches:
            near = padded(batch.column(2), wide) @ pivots.T
            far = near.max(1)
            home = np.where(far >= (core if core > -1 else -math.inf), near.argmax(1), total).astype(np.int32)
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], batch.column(2).cast(pa.list_(pa.float64())), batch.column(3), pa.array(home), pa.array(far)],
                                             names=["node", "n", "v", "label", "home", "far"])

    name = nodes.schema["label"].dataType.simpleString()
    fields = f"node bigint, n bigint, v array<double>, label {name}, home int"
    housed = stage(nodes.select("node", "n", "v", "label").mapInArrow(belong, f"{fields}, far double"), "housed")
    radius = np.full(total, -math.inf)  # of each ball, from its pivot to its farthest member
    for home, far in housed.filter(F.col("home") < total).groupBy("home").agg(F.min("far")).collect():
        radius[home] = math.acos(max(-1.0, min(1.0, far)))
    open_from = np.where(np.isfinite(radius), np.cos(np.clip(radius + reach, 0, math.pi)) - 1e-6, 2.0)  # cosine from which a ball has guests

    def describe(batches):
        for batch in batches:
            near, out = padded(batch.column(2), wide) @ pivots.T, []
            lowest = np.cos(np.minimum(np.arccos(np.clip(near.max(1), -1, 1)) + 2 * reach, math.pi)) - 1e-6
            for cos, home, low in zip(near, batch.column(4).to_numpy(), lowest, strict=True):
                lists = np.flatnonzero(cos >= np.maximum(open_from, low))
                own = [home] if home < total else total + np.argsort(-cos, kind="stable")[:nearest]
                out.append(np.concatenate([own, lists[lists != home]]).astype(np.int32))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.list_(pa.int32()))], names=[*batch.schema.names, "lists"])

    told = stage(housed.select("node", "n", "v", "label", "home").mapInArrow(describe, f"{fields}, lists array<int>"), "described")
    lists = told.withColumn("list", F.explode("lists")).withColumn("own", (F.col("home") == F.col("list")) | (F.col("list") >= total))
    sizes = lists.groupBy("label", "list").agg(F.count_if("own").alias("members"), F.count_if(~F.col("own")).alias("guests"))
    sizes = sizes.filter("members > 0 and members + guests > 1").select(
        "label", "list", F.ceil(F.col("members") / CHUNK).cast("int").alias("chunks"), F.ceil(F.col("guests") / CHUNK).cast("int").alias("more"))
    lists = lists.join(sizes, ["label", "list"])  # guests' chunks come after the members' and meet those only
    lists = lists.withColumn("chunk", F.when(F.col("own"), F.pmod("node", "chunks")).otherwise(F.col("chunks") + F.pmod("node", "more")).cast("int"))
    last = F.col("chunks") - 1 + F.when(F.col("own"), F.col("more")).otherwise(0)
    cells = lists.withColumn("other", F.explode(F.sequence(F.lit(0), last))).select(
        "label", "list", F.least("chunk", "other").alias("x"), F.greatest("chunk", "other").alias("y"), "chunk", "node", "n", "v", "home", "lists")

    def compare(key: tuple, held: pd.DataFrame) -> pd.DataFrame:
        at, x, y = key[1:4]
        node, count = held["node"].to_numpy(), held["n"].to_numpy()
        vectors = [np.asarray(v, np.float64) for v in held["v"]]
        widths = np.array([len(v) for v in vectors])
        full = np.zeros((len(held), max(widths)))
        for i, v in enumerate(vectors):
            full[i, :len(v)] = v
        units, home = unit(full), held["home"].to_numpy()
        if at < total:
            linked = np.minimum(home[:, None], home[None, :]) == at
        else:
            has = np.zeros((len(held), total), np.float32)
            for i, p in enumerate(held["lists"]):
                has[i, [q - total for q in p if q >= total]] = 1
            linked = (has @ has.T >= shared) & (has[:, :at - total] @ has[:, :at - total].T == 0)
        near = units @ units.T
        linked &= (near >= threshold - 1e-9) & (widths[:, None] == widths[None, :])
        for i, j in zip(*np.nonzero(linked & (near < threshold + 1e-9)), strict=True):
            linked[i, j] = exact_cosine(full[i], full[j]) >= threshold
        if x != y:  # pairs inside a chunk are compared in the chunk's own cell
            side = held["chunk"].to_numpy()
            linked &= side[:, None] != side[None, :]
        np.fill_diagonal(linked, False)
        links = linked.astype(np.float64) @ count.astype(np.float64)
        met = np.flatnonzero(links > 0)
        if not len(met):
            return pd.DataFrame({"node": [], "links": [], "to": []}).astype("int64")
        linked, place = linked[np.ix_(met, met)], np.arange(len(met))
        while True:
            low = np.minimum(place, np.where(linked, place[None, :], len(met)).min(1))
            low = low[low]
            if (low == place).all():
                break
            place = low
        return pd.DataFrame({"node": node[met], "links": links[met].astype(np.int64), "to": node[met][place]})

    found = stage(cells.groupBy("label", "list", "x", "y").applyInPandas(compare, "node bigint, links bigint, to bigint"), "links")
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    linked = components(found.select(F.col("node").alias("a"), F.col("to").alias("b"))).withColumnRenamed("node", "node_")
    named = nodes.join(linked, F.col("node") == F.col("node_"), "left").select("label", "v", "node", "low", "n", F.coalesce("component", "node").alias("component"))
    lowest = named.groupBy("component").agg(F.min("low").alias("component_id"))
    of_node = named.join(lowest, "component").join(links, "node", "left").select(
        F.col("label").alias("label_"), F.col("v").alias("v_"), (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), "component_id")
    return able.select("id", "label", "v").join(of_node, (F.col("label") == F.col("label_")) & (F.col("v") == F.col("v_"))).select("id", "n_links", "component_id") \
        .unionByName(rows.filter(~F.coalesce(part, F.lit(False))).select("id", F.lit(0).cast("bigint").alias("n_links"), F.col("id").alias("component_id"))) \
        .select(F.col("id").alias(id_col), "n_links", "component_id", F.coalesce(F.col("id") == F.col("component_id"), F.lit(False)).alias("kept"))
