"""Operator 13: a Merkle manifest of a dataset, with a membership proof of every row.

A row's leaf hashes its fields. The leaves of a group (a source) stand in id
order; runs of ``FANOUT`` of them become a parent, runs of parents theirs, up
to one subroot a group; the subroots, in group order, are the leaves of a last
tree with the root.

A level is a *slot pivot*: grouped by (group, parent), conditional aggregates
spread the children into FANOUT columns. The columns concatenated are hashed
into the parent; the columns without a child's own give its siblings. Going
down again, each level's siblings are put before those of the levels above, so
that only parents (a sixteenth of the rows) are ever joined.

Positions come from a range-partitioned numbering, so a group may hold any
share of the rows; the shuffles carry digests, never texts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlake.llm._io import crc32_of, stage
from orderlake.operators.ranking import rank_over

#: Children of a node.
FANOUT = 16

_SLOTS = [f"c{j}" for j in range(FANOUT)]
_PATH = "array<struct<left: string, right: string>>"


def digest(value: Column) -> Column:
    """Lowercase hex sha256 of a string's UTF-8 bytes."""
    return F.sha2(value, 256)


def field_text(value: Column) -> Column:
    """``-`` for null, else the value's UTF-8 byte count, ``:`` and the value (numbers in decimal)."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_of(fields: list[Column]) -> Column:
    return digest(F.concat(*[field_text(f) for f in fields]))


def _parents(nodes: DataFrame, value: Column, sizes: DataFrame | None = None) -> DataFrame:
    """(g, pos, n, hash, c0..c15): the runs of FANOUT nodes (g, pos, n), ``value`` of each child in its slot's column.

    ``n`` is the number of nodes of the group's level; where the nodes do not
    tell it, ``sizes`` (g, n) does.
    """
    slot = F.col("pos") % FANOUT
    held = [F.max(F.when(slot == j, value)).alias(c) for j, c in enumerate(_SLOTS)]
    if sizes is None:
        held.append(F.max("n").alias("n"))
    up = nodes.groupBy("g", F.floor(F.col("pos") / FANOUT).alias("pos")).agg(*held)
    if sizes is not None:
        up = up.join(sizes.withColumnRenamed("g", "g_"), F.col("g").eqNullSafe(F.col("g_"))).drop("g_")
    spread = dict(zip(_SLOTS, (F.col(c)["leaf"] if sizes is not None else F.col(c) for c in _SLOTS), strict=True))
    return up.select("g", "pos", F.ceil(F.col("n") / FANOUT).alias("n"), digest(F.concat_ws("", *spread.values())).alias("hash"), *_SLOTS)


def _climb(level: DataFrame) -> list[DataFrame]:
    """The levels from ``level`` up to the one where every group has a single node, each written once."""
    levels = [level]
    while not levels[-1].filter("n > 1").isEmpty():
        nodes = levels[-1].filter("n > 1").select("g", "pos", "n", "hash")
        levels.append(stage(_parents(nodes, F.col("hash")), "level"))
    return levels


def _children(level: DataFrame, hash_of=lambda c: c) -> DataFrame:
    """(g, pos, child, path): one row per child, its siblings left and right put before the parent's ``path``."""
    hashes = [hash_of(F.col(c)) for c in _SLOTS]
    around = F.array(*[F.when(F.col(c).isNotNull(), F.struct(
        F.lit(j).alias("slot"), F.col(c).alias("child"), F.concat_ws("", *hashes[:j]).alias("left"), F.concat_ws("", *hashes[j + 1:]).alias("right")))
        for j, c in enumerate(_SLOTS)])
    told = level.select("g", "pos", "path", F.explode(F.filter(around, lambda x: x.isNotNull())).alias("x"))
    return told.select("g", (F.col("pos") * FANOUT + F.col("x.slot")).alias("pos"), F.col("x.child").alias("child"),
                       F.concat(F.array(F.struct("x.left", "x.right")), "path").alias("path"))


def _descend(levels: list[DataFrame], tops: DataFrame) -> DataFrame:
    """The lowest of ``levels`` with its nodes' paths. ``tops`` (g, path): the paths above each group's single topmost node."""
    tops = tops.select(F.col("g").alias("g_"), F.col("path").alias("above"))
    under = None
    for level in reversed(levels):
        done = level.filter("n = 1").join(tops, F.col("g").eqNullSafe(F.col("g_"))).withColumnRenamed("above", "path").drop("g_")
        if under is not None:
            inner = under.select(F.col("g").alias("g_"), F.col("pos").alias("pos_"), "path")
            lower = level.filter("n > 1").join(inner, F.col("g").eqNullSafe(F.col("g_")) & (F.col("pos") == F.col("pos_"))).drop("g_", "pos_")
            done = done.unionByName(lower)
        under = done if level is levels[0] else _children(stage(done, "paths"))
    return under


def manifest(docs: DataFrame, fields: list[str], changed: dict[str, Column] | None = None, id_col: str = "doc_id",
             group_col: str = "source") -> DataFrame:
    """One row per row of ``docs``: ``id_col``, leaf, subroot, root, path, proof_sha256, folded_root and verified.

    ``path`` holds the siblings (left, right) of the row's node, level by level
    from the leaf to the root; ``proof_sha256`` hashes them one after another.
    ``changed`` gives columns other values: ``folded_root`` is what the row's
    changed leaf folds to along the unchanged path, and ``verified`` whether
    that is the root. Without it, every row verifies.

    Leaves ascend by id within a group: null ids first, rows of one id in the
    order of their leaves (so repeated rows are leaves of their own, in either
    order). A null group is a group, the first of all; the others ascend
    bytewise. Columns beside ``fields`` are not read, texts may be of any
    length. An empty table gives no rows.
    """
    new = changed or {}
    leaves = docs.select(
        F.col(group_col).cast("string").alias("g"), F.col(id_col).alias("id"), leaf_of([F.col(f) for f in fields]).alias("leaf"),
        leaf_of([new.get(f, F.col(f)) for f in fields]).alias("changed"), F.col(id_col).isNotNull().alias("has_id"))
    leaves = stage(leaves, "digests")  # the texts are read once
    placed = rank_over(leaves, "has_id", partition_by=["g"], descending=False, method="row_number", tie_break=["id", "leaf"], out="place")
    placed = placed.select("g", (F.col("place") - 1).alias("pos"), F.struct("id", "leaf", "changed").alias("row"))
    base = stage(placed, "leaves")
    sizes = stage(base.groupBy("g").agg(F.count(F.lit(1)).alias("n")), "sizes")

    # Every leaf sits in a first level; a group of one leaf has that leaf as its subroot, so its first level is not a level of the tree.
    first = stage(_parents(base, F.col("row"), sizes), "level")
    lone = sizes.filter("n = 1").select(F.col("g").alias("g_"))
    single = stage(first.join(lone, F.col("g").eqNullSafe(F.col("g_")), "left_semi").select("g", F.col("c0").alias("row")), "single")
    own = first.join(lone, F.col("g").eqNullSafe(F.col("g_")), "left_anti")
    levels = _climb(own)
    subroots = single.select("g", F.col("row.leaf").alias("hash"))
    for level in levels:
        subroots = subroots.unionByName(level.filter("n = 1").select("g", "hash"))
    subroots = stage(subroots, "subroots")

    # The last tree: its nodes are the groups in order, null first.
    ordered = rank_over(subroots.withColumn("named", F.col("g").isNotNull()), "named", descending=False, method="row_number",
                        tie_break=["g"], out="place")
    many = subroots.count()
    top = stage(ordered.select(F.lit(0).alias("g"), (F.col("place") - 1).alias("pos"), F.lit(many).cast("bigint").alias("n"), "hash",
                               F.col("g").alias("group")), "top")
    no_path = F.array().cast(_PATH)
    if many > 1:
        above = _climb(stage(_parents(top, F.col("hash")), "level"))
        root = above[-1].select("hash")
        inner = _children(_descend(above, top.select("g").distinct().select("g", no_path.alias("path"))))
        tops = top.join(inner.select("pos", "path"), "pos").select(F.col("group").alias("g"), "path", F.col("hash").alias("subroot"))
    else:
        root = top.select("hash")
        tops = top.select(F.col("group").alias("g"), no_path.alias("path"), F.col("hash").alias("subroot"))
    found = root.first()  # one digest, or none of an empty table
    tops = stage(tops.withColumn("root", F.lit(found[0] if found else None).cast("string")), "tops")

    rows = _children(_descend(levels, tops), lambda c: c["leaf"]).select("g", F.col("child").alias("row"), "path")
    rows = rows.unionByName(single.join(tops.select(F.col("g").alias("g_"), "path"), F.col("g").eqNullSafe(F.col("g_"))).drop("g_"))
    ends = tops.select(F.col("g").alias("g_"), "subroot", "root")
    rows = rows.join(ends, F.col("g").eqNullSafe(F.col("g_")))
    siblings = F.array_join(F.flatten(F.transform("path", lambda p: F.array(p["left"], p["right"]))), "")
    folded = F.aggregate("path", F.col("row.changed"), lambda h, p: digest(F.concat(p["left"], h, p["right"])))
    told = rows.select(F.col("row.id").alias(id_col), F.col("row.leaf").alias("leaf"), "subroot", "root", "path",
                       digest(siblings).alias("proof_sha256"), folded.alias("folded_root"))
    return told.withColumn("verified", F.col("folded_root") == F.col("root"))


def lowered_where(text: Column, picked: Column) -> Column:
    """``text`` with A-Z lower-cased where ``picked`` holds; null stays null."""
    capitals = "".join(map(chr, range(65, 91)))
    return F.when(F.coalesce(picked, F.lit(False)), F.translate(text, capitals, capitals.lower())).otherwise(text)


def tampered(id_col: str = "doc_id", text_col: str = "text") -> dict[str, Column]:
    """The change that the query checks: A-Z lower-cased in texts whose id's crc32 is divisible by 5."""
    return {text_col: lowered_where(F.col(text_col), crc32_of(F.col(id_col)) % 5 == 0)}
