"""Operator 7: size-aware heavy-light join of word-shingle sets by Jaccard similarity.

Sets whose similarity reaches the threshold t share at least ceil(t n) of each
one's n shingles, so in any common order of the shingles the first
n - ceil(t n) + k of both sets share at least k. The order puts rare shingles
first: the frequent ones are found by counting (every task counts all of its
shingles and reports those that it meets twice; the most frequent, a bounded
number, are broadcast). It steers the work and never the result.

* Light (small) sets enumerate all 2-subsets of their prefix (k = 2).
* Heavy (large) sets, and light ones near enough in size to meet them, enter
  the inverted lists of the shingles of their prefix (k = 1); a list links a
  heavy set with any other set.
* The size where heavy begins comes from a cost model of the counts.

Equal sets are one node from the start. Within a list, nodes are first compared
with a hub of the list only: the node with the fewest infrequent shingles, as
the original of a group of near copies has. A set's three smallest and three
largest hashes name two more lists, which serve the hubs alone: near copies
mostly share them, texts that share a passage mostly do not. What hubs connect
needs no more comparing: after the first components, only pairs of a list that
lie in different components are compared. The lists of frequent shingles are
dealt out in parts, by salt; long lists that stay open are cut into bands of
sizes, and each band into cells of bounded size, whose pairs are filtered before
any leaves the task. Exact filters come first: on sizes and positions in the order, then
on parity bitmaps, whose distance never exceeds that of the sets. All that is
left is compared shingle by shingle. So the components are exact without
comparing all pairs of any group.

Shingles and sets are told apart by 64-bit hashes of words and sets.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderlake.llm._components import components
from orderlake.llm._io import let_go, prepare, stage
from orderlake.llm._text import PieceCache

#: Words of a shingle.
WORDS = 5
#: Per cent of similarity at which sets link.
THRESHOLD = 80
#: Shingles after which a task reports those that it has met twice.
COUNTED = 2_000_000
#: Frequent shingles that are broadcast at most (16 bytes each): all that were met 2^i times or more, for the smallest i that fits.
FREQUENT = 1_000_000
#: Nodes of a part of a frequent shingle's list, about.
PART_NODES = 300
#: Nodes from which on an open list is compared in cells, and nodes of each side of a cell, about.
CELL = 2048
#: Largest size of a band over its smallest.
BAND = 1.25
#: Bits of a parity bitmap.
BITS = 1024
#: Bits of the bitmap that picks the texts to compare (1 MB).
MARK_BITS = 1 << 23
#: Light sets have at most so many shingles, whatever the costs say (their 2-subsets grow with the square).
LIGHT_MOST = 60

_MULT, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * _MIX
    h = (h ^ (h >> np.uint64(32))) * _MIX
    return h ^ (h >> np.uint64(32))


class Shingler:
    """text -> sorted distinct 64-bit shingle hashes. Words are runs without U+0020 and U+0009 to U+000D; A-Z count as a-z."""

    def __init__(self, words: int = WORDS):
        import xxhash

        self._n = words
        self._hash = PieceCache(xxhash.xxh3_64_digest, 500_000)

    def of(self, text: str | None) -> np.ndarray:
        words = (text or "").encode("utf-8", "surrogatepass").lower().split()
        if not words:
            return np.zeros(0, np.uint64)
        h = np.frombuffer(self._hash.of(words), np.uint64)
        n = min(self._n, len(words))
        out = np.full(len(h) - n + 1, n, np.uint64)
        for i in range(n):
            out = out * _MULT + h[i:len(h) - n + 1 + i]  # the words' hashes are mixed well already
        return np.unique(_mixed(out))


def set_key(hashes: np.ndarray) -> int:
    """64-bit name of a set, as a signed integer."""
    import xxhash

    return int(np.uint64(xxhash.xxh3_64_intdigest(hashes.tobytes())).astype(np.int64))


def _bitmap(hashes: np.ndarray) -> bytes:
    """Bit i is the parity of the number of shingles with hash modulo BITS = i."""
    return np.packbits((np.bincount((hashes % np.uint64(BITS)).astype(np.int64), minlength=BITS) & 1).astype(np.uint8)).tobytes()


def _at_least(n, threshold: int):
    """ceil(threshold % of n)."""
    return -(-threshold * n // 100)


def describe(docs: DataFrame, id_col: str, text_col: str, words: int) -> DataFrame:
    """(``id_col``, mark, n, key, bits, often, times): null key and bits for an empty set; often and times are what a task reports, on some rows."""
    name = docs.schema[id_col].dataType.simpleString()
    from pyspark.sql.pandas.types import to_arrow_type

    schema = pa.schema([(id_col, to_arrow_type(docs.schema[id_col].dataType)), ("mark", pa.int64()), ("n", pa.int64()), ("key", pa.int64()), ("bits", pa.binary()),
                        ("often", pa.list_(pa.int64())), ("times", pa.list_(pa.int64()))])

    def run(batches):
        let_go()
        shingler, held, count, seen = Shingler(words), [], 0, set()

        def report():
            found, times = np.unique(np.concatenate(held), return_counts=True) if held else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
            twice = times > 1
            return found[twice].view(np.int64), times[twice]

        def out(rows):
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

        last = None
        for batch in batches:
            rows = [last] if last else []
            for key, mark, text in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), batch.column(1), strict=True):
                h = shingler.of(text.as_py())
                if not len(h):
                    rows.append((key, mark, 0, None, None, None, None))
                    continue
                name_of = set_key(h)
                if name_of not in seen:  # a task's copies count once
                    seen.add(name_of)
                    held.append(h)
                    count += len(h)
                often = times = None
                if count >= COUNTED:
                    often, times = report()
                    held, count, seen = [], 0, set()
                rows.append((key, mark, len(h), name_of, _bitmap(h), often, times))
            last = rows.pop() if rows else None
            if rows:
                yield out(rows)
        if last:
            often, times = report()
            if last[5] is None:
                last = (*last[:5], often, times)
            yield out([last])

    return docs.select(F.col(id_col), F.col(text_col), F.xxhash64(text_col).alias("mark")).mapInArrow(
        run, f"`{id_col}` {name}, mark bigint, n bigint, key bigint, bits binary, often array<bigint>, times array<bigint>")


def light_limit(total: int, frequent_times: np.ndarray, threshold: int) -> int:
    """The largest size at which enumerating 2-subsets costs no more than scanning inverted lists.

    A set of n shingles has a prefix of p = n - ceil(t n) + 1. Its 2-subsets are
    (p + 1) p / 2 rows; its list entries are p rows, each of which meets as many
    others as a random shingle's list has: the sum of the squared counts over
    all shingles.
    """
    met = 1 + float((frequent_times.astype(np.float64) ** 2).sum()) / max(1, total)
    n = 4
    while n < LIGHT_MOST and (n + 1 - _at_least(n + 1, threshold) + 2) / 2 <= met:
        n += 1
    return n


def _part(node: int, count: np.ndarray) -> np.ndarray:
    """Which part of its lists a node enters: 0 if a list is whole, else from 1 on."""
    parts = -(-count // PART_NODES)
    return np.where(parts > 1, 1 + (node & (2**62 - 1)) % np.maximum(parts, 1), 0)


def _lists(docs: DataFrame, text_col: str, words: int, threshold: int, frequent, light: int) -> DataFrame:
    """Rows of the lists: list (a shingle's or a 2-subset's hash), part, node, n, left (shingles from the last listed one on), odd.

    Parts below zero are those of the lists for hubs alone, named by the ends of a set.
    ``odd`` is how many of a thousand of the node's shingles are not frequent:
    the text that near copies were made from has the fewest, so it makes the
    best hub.
    """
    names = ["list", "part", "node", "n", "left", "odd"]
    kinds = (np.int64, np.int32, np.int64, np.int32, np.int32, np.int32)

    def run(batches):
        tokens, times = frequent.value
        near = np.zeros(1 << 22, bool)
        near[(tokens & np.uint64((1 << 22) - 1)).astype(np.int64)] = True
        let_go()
        shingler, seen = Shingler(words), set()
        for batch in batches:
            made = [[] for _ in names]
            for text in batch.column(0):
                h = shingler.of(text.as_py())
                n = len(h)
                if n < 4:
                    continue  # below four shingles only equal sets reach the threshold
                node = set_key(h)
                if node in seen:
                    continue
                if len(seen) > 200_000:
                    seen.clear()
                seen.add(node)
                count = np.zeros(n, np.int64)
                maybe = np.flatnonzero(near[(h & np.uint64((1 << 22) - 1)).astype(np.int64)])
                if len(maybe):
                    at = np.minimum(np.searchsorted(tokens, h[maybe]), len(tokens) - 1)
                    count[maybe] = np.where(tokens[at] == h[maybe], times[at], 0)
                odd = 1000 * int((count == 0).sum()) // n
                ends, met = np.stack([h[:3], h[-3:]]), np.stack([count[:3], count[-3:]]).min(1)
                names_of = _mixed((ends[:, 0] * _MULT + ends[:, 1]) * _MULT + ends[:, 2])
                p = n - _at_least(n, threshold) + 1
                order = np.argsort(count, kind="stable")[:p + 1]  # shingles of one count stay in the order of their hashes
                first, count = h[order], count[order]
                rows = [(names_of, -1 - _part(node, met), np.full(2, n))]
                if n > light or 100 * n >= threshold * (light + 1):
                    rows.append((first[:p], _part(node, count[:p]), n - np.arange(p)))
                if n <= light:
                    i, j = np.triu_indices(len(first), 1)
                    rows.append((_mixed(first[i] * _MULT + first[j]), _part(node, np.minimum(count[i], count[j])), n - j + 1))
                for lists, parts, left in rows:
                    size = len(lists)
                    for column, x in zip(made, (lists.view(np.int64), parts, np.full(size, node), np.full(size, n), left, np.full(size, odd)), strict=True):
                        column.append(x)
            if made[0]:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c).astype(k)) for c, k in zip(made, kinds, strict=True)], names=names)

    return docs.select(F.col(text_col)).mapInArrow(run, "list bigint, part int, node bigint, n int, left int, odd int")


def _needed(n_a: Column, n_b: Column, threshold: int) -> Column:
    """Shingles that sets of these sizes share at least if they link."""
    return F.ceil((n_a + n_b) * threshold / F.lit(100.0 + threshold) - 1e-9)


def _shared(lists: DataFrame) -> DataFrame:
    """The rows of lists that hold more than one node (of a list in parts, all rows)."""
    part = Window.partitionBy("list", "part")
    met = lists.withColumn("low", F.min("node").over(part)).withColumn("high", F.max("node").over(part))
    return met.filter("low <> high or part not in (-1, 0)").drop("low", "high").dropDuplicates(["list", "part", "node"])


def _met_in_cells(lists: DataFrame, sets: DataFrame, threshold: int) -> DataFrame:
    """The pairs (a, b) of nodes of one list and two components whose sizes, positions and bitmaps let them link.

    Of a pair, the smaller set stands at home in the band of its size; the
    larger one visits the bands of all sizes that it can link with from where
    it stands. A band's homes and visitors are dealt into cells by their hashes.
    """
    def band(n: Column) -> Column:
        return F.floor(F.log(n) / F.log(F.lit(BAND))).cast("int")

    n, left = F.col("n"), F.col("left")
    rows = lists.join(sets.select(F.col("key").alias("node"), "bits"), "node").select("list", "node", "n", "left", "component", "bits")
    rows = stage(rows, "long_lists")
    homes = rows.filter(left >= _needed(n, n, threshold)).withColumn("band", band(n))
    least = F.ceil(n * threshold / F.lit(100.0) - 1e-9)
    most = F.least(n, F.floor(left * (100 + threshold) / F.lit(float(threshold)) + 1e-9) - n)
    guests = rows.filter(least <= most).withColumn("band", F.explode(F.sequence(band(least), band(most))))
    sizes = homes.withColumn("home", F.lit(1)).unionByName(guests.withColumn("home", F.lit(0))).groupBy("list", "band").agg(
        F.ceil(F.sum("home") / CELL).cast("int").alias("across"), F.ceil(F.sum(1 - F.col("home")) / CELL).cast("int").alias("down"))
    sizes = stage(sizes.filter("across > 0 and down > 0"), "cells")

    def dealt(side: DataFrame, own: str, own_count: str, other: str, other_count: str) -> DataFrame:
        placed = side.join(sizes, ["list", "band"]).withColumn(own, F.pmod(F.xxhash64("node"), F.col(own_count)).cast("int"))
        return placed.withColumn(other, F.explode(F.sequence(F.lit(0), F.col(other_count) - 1))).drop("across", "down")

    cell = ["list", "band", "x", "y"]
    homes, guests = dealt(homes, "x", "across", "y", "down"), dealt(guests, "y", "down", "x", "across")
    guests = guests.toDF(*guests.columns)  # columns of its own, apart from those of homes

    def compare(home: pd.DataFrame, guest: pd.DataFrame) -> pd.DataFrame:
        if not len(home) or not len(guest):
            return pd.DataFrame({"a": [], "b": []}).astype("int64")
        spread = [2 * np.unpackbits(np.frombuffer(b"".join(side["bits"]), np.uint8).reshape(len(side), -1), axis=1).astype(np.float32) - 1 for side in (home, guest)]
        apart = (BITS - (spread[0] @ spread[1].T).astype(np.int64)) // 2
        node, n, left, component = ([side[c].to_numpy() for side in (home, guest)] for c in ("node", "n", "left", "component"))
        both = n[0][:, None] + n[1][None, :]
        may = (n[0][:, None] < n[1][None, :]) | (n[0][:, None] == n[1][None, :]) & (node[0][:, None] < node[1][None, :])
        may &= component[0][:, None] != component[1][None, :]
        may &= np.minimum(left[0][:, None], left[1][None, :]) * (100 + threshold) >= threshold * both
        may &= (both - apart) // 2 * (100 + threshold) >= threshold * both
        i, j = np.nonzero(may)
        return pd.DataFrame({"a": np.minimum(node[0][i], node[1][j]), "b": np.maximum(node[0][i], node[1][j])})

    return homes.groupBy(*cell).cogroup(guests.groupBy(*cell)).applyInPandas(compare, "a bigint, b bigint")


def _picked(docs: DataFrame, marks: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose mark may be among ``marks``: all that are, and few others.

    A bitmap of MARK_BITS bits, whatever the number of marks, is broadcast, so
    texts that nobody asks for are not shuffled. With far more marks than bits
    it lets everything pass and only costs its size.
    """
    def place(c: str):
        return F.pmod(c, F.lit(MARK_BITS))

    maps = marks.select(place("mark").alias("at")).groupBy(F.bitmap_bucket_number("at").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("map"))
    rows = docs.withColumn("at", place("mark")).withColumn("bucket", F.bitmap_bucket_number("at"))
    bit = F.bitmap_bit_position("at")
    byte = F.conv(F.hex(F.substring("map", (F.floor(bit / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return rows.join(F.broadcast(maps), "bucket").filter(F.call_function("shiftright", byte, (bit % 8).cast("int")) % 2 == 1).select(*docs.columns)


def _verified(pairs: DataFrame, sets: DataFrame, docs: DataFrame, words: int, threshold: int) -> DataFrame:
    """The pairs (a, b) of nodes whose sets reach the threshold: bitmaps first, then shingle by shingle."""
    a = sets.select(F.col("key").alias("a"), F.col("n").alias("n_a"), F.col("bits").alias("bits_a"))
    b = sets.select(F.col("key").alias("b"), F.col("n").alias("n_b"), F.col("bits").alias("bits_b"))
    table = np.array([bin(i).count("1") for i in range(256)], np.int64)

    def near(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            x, y = (np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint8).reshape(batch.num_rows, -1) for i in (4, 5))
            n_a, n_b = (batch.column(i).to_numpy(zero_copy_only=False) for i in (2, 3))
            apart = table[x ^ y].sum(1)
            keep = (n_a + n_b - apart) // 2 * (100 + threshold) >= threshold * (n_a + n_b)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(keep))

    left = stage(pairs.join(a, "a").join(b, "b").select("a", "b", "n_a", "n_b", "bits_a", "bits_b").mapInArrow(near, "a bigint, b bigint"), "pairs")

    def compare(batches):
        let_go()
        shingler, held, held_set = Shingler(words), None, None
        for batch in batches:
            keep = []
            for a_, text_a, text_b in zip(batch.column(0).to_pylist(), batch.column(2), batch.column(3), strict=True):
                if a_ != held:
                    held, held_set = a_, shingler.of(text_a.as_py())
                other = shingler.of(text_b.as_py())
                both = len(np.intersect1d(held_set, other, assume_unique=True))
                keep.append(100 * both >= threshold * (len(held_set) + len(other) - both))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    wanted = left.select(F.explode(F.array("a", "b")).alias("key")).distinct().join(sets.select("key", "one.id", "one.mark"), "key")
    wanted = stage(wanted.select("key", F.col("id").alias("wanted_id"), F.col("mark").alias("wanted_mark")), "wanted")
    here = _picked(docs.withColumn("mark", F.xxhash64("text")), wanted.select(F.col("wanted_mark").alias("mark")))
    texts = stage(here.join(wanted, (F.col("mark") == F.col("wanted_mark")) & F.col("id").eqNullSafe(F.col("wanted_id")))
                  .groupBy("key").agg(F.first("text").alias("text")), "texts")
    text_a = texts.select(F.col("key").alias("a"), F.col("text").alias("text_a"))
    text_b = texts.select(F.col("key").alias("b"), F.col("text").alias("text_b"))
    both = left.join(text_b, "b").join(text_a, "a").select("a", "b", "text_a", "text_b")
    return stage(both.mapInArrow(compare, "a bigint, b bigint"), "links")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS,
                    threshold: int = THRESHOLD, keys: bool = False) -> DataFrame:
    """One row per row of ``docs``: ``id_col``, n_shingles, component_id (smallest id reachable by links, itself included).

    Null and empty texts have an empty set and link with nothing, so their
    component is their own id; equal sets link. Rows with null ids take part
    and get the smallest id that is not null, or null. Repeated ids count as
    rows of their own. Other columns are not read; an empty table gives no
    rows. Thresholds up to 75 are refused: different sets of three and four
    shingles reach them, and the lists leave out sets below four. ``keys``
    adds two columns by which rows without an id can be told apart: mark (the
    text's xxhash64) and component_key (the same for all rows of a component,
    null for an empty set).
    """
    if not 75 < threshold <= 100:
        raise ValueError(f"threshold must be above 75 and at most 100, not {threshold}")
    spark = docs.sparkSession
    prepare(spark)
    docs = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    told = stage(describe(docs, "id", "text", words), "sets")
    classes = stage(told.filter("n > 0").groupBy("key").agg(F.min("id").alias("low"), F.first("n").alias("n"), F.first("bits").alias("bits"),
                                                               F.min(F.struct("id", "mark")).alias("one")), "classes")

    often = stage(told.select(F.explode(F.arrays_zip("often", "times")).alias("x")).groupBy(F.col("x.often").alias("token"))
                  .agg(F.sum("x.times").alias("times")), "often")
    cut, room = 64, FREQUENT
    for power, n in sorted(often.groupBy(F.floor(F.log2("times")).alias("power")).count().collect(), reverse=True):  # 64 rows at most
        if n > room:
            break
        cut, room = power, room - n
    counted = often.filter(F.floor(F.log2("times")) >= cut).toArrow()
    tokens = counted.column("token").to_numpy().view(np.uint64)
    times = counted.column("times").to_numpy().astype(np.int64)
    by_token = np.argsort(tokens, kind="stable")
    total = classes.agg(F.sum("n")).first()[0] or 0
    light = light_limit(total, times, threshold)
    frequent = spark.sparkContext.broadcast((tokens[by_token], times[by_token]))

    live = stage(_shared(_lists(docs, "text", words, threshold, frequent, light)), "lists")

    hub = live.groupBy("list").agg(F.min(F.struct("odd", "node", "n", "left")).alias("hub"))
    beside = live.join(hub, "list").filter(
        (F.col("node") != F.col("hub.node")) & (F.least("left", "hub.left") >= _needed(F.col("n"), F.col("hub.n"), threshold)))
    first = stage(beside.select(F.least("node", "hub.node").alias("a"), F.greatest("node", "hub.node").alias("b")).distinct(), "hub_pairs")
    links = _verified(first, classes, docs, words, threshold)
    linked = components(links)

    labelled = live.join(linked.withColumnRenamed("node", "node_"), F.col("node") == F.col("node_"), "left").select(
        "list", "part", "node", "n", "left", F.coalesce("component", "node").alias("component")).filter("part >= 0").drop("part")
    mixed = labelled.groupBy("list").agg(F.min("component").alias("low"), F.max("component").alias("high"), F.count("*").alias("size"))
    open_lists = stage(labelled.join(mixed.filter("low <> high").select("list", "size"), "list"), "open_lists")
    short, long = open_lists.filter(F.col("size") <= CELL), open_lists.filter(F.col("size") > CELL)
    x = short.select("list", *[F.col(c).alias(f"{c}_a") for c in ("node", "n", "left", "component")])
    y = short.select("list", *[F.col(c).alias(f"{c}_b") for c in ("node", "n", "left", "component")])
    others = x.join(y, "list").filter(
        (F.col("component_a") < F.col("component_b")) & (F.least("left_a", "left_b") >= _needed(F.col("n_a"), F.col("n_b"), threshold))) \
        .select(F.least("node_a", "node_b").alias("a"), F.greatest("node_a", "node_b").alias("b"))
    if not long.isEmpty():
        others = others.unionByName(_met_in_cells(long, classes, threshold))
    more = _verified(others.distinct().join(first, ["a", "b"], "left_anti"), classes, docs, words, threshold)
    if not more.isEmpty():
        linked = components(links.unionByName(more))

    named = classes.join(linked, classes["key"] == linked["node"], "left").select("key", "low", F.coalesce("component", "key").alias("component"))
    lowest = named.groupBy("component").agg(F.min("low").alias("component_id"))
    of_class = named.join(lowest, "component").select("key", "component_id", F.col("component").alias("component_key"))
    extra = ["mark", "component_key"] if keys else []
    return told.select("id", F.col("n").alias("n_shingles"), "key", *extra[:1]).join(of_class, "key", "left").select(
        F.col("id").alias(id_col), "n_shingles", F.when(F.col("key").isNull(), F.col("id")).otherwise(F.col("component_id")).alias("component_id"), *extra)
