"""Operator 6: bounded-space online packing of token sequences.

Each scan partition streams through one task with a fixed number of open
windows. A document's ids are cut at the window size; the rest of it goes to
the open window with the least free space that still holds it. When none does,
the fullest window is emitted, filled up with the head of the piece if the cut
leaves both parts large enough. The windows that are still open at the end of a
partition keep their ids; a second step merges those of neighbouring
partitions, a bounded number at a time.

The first step is written to the shared folder before the second reads it, so
a lost executor repeats a whole partition or nothing.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlake.llm._io import prepare, stage
from orderlake.llm._batch import gathered
from orderlake.llm._tokens import REMEMBERED, ids_of, start_task

#: Tokens of a full sequence.
WINDOW = 2048
#: Windows that a partition keeps open.
OPEN_WINDOWS = 64
#: Tokens that each part of a cut has at least.
LEAST_PIECE = 32
#: Bytes of text that are coded at once; only speed and memory depend on it.
BATCH_BYTES = 5_000_000
#: Partitions whose last open windows are merged in one task: at most this times OPEN_WINDOWS windows.
MERGED_PARTITIONS = 16


class _Window:
    __slots__ = ("number", "used", "pieces")

    def __init__(self, number: int):
        self.number, self.used, self.pieces = number, 0, []

    def add(self, key, start: int, ids: bytes, total: int) -> None:
        self.pieces.append((key, start, ids, total, self.used))
        self.used += len(ids) // 4


class _Packer:
    """Open windows sorted by (used, number); ``add`` returns the windows that it closed."""

    def __init__(self, window: int, keep: int, least: int):
        self.window, self.keep, self.least = window, keep, least
        self.order: list[tuple[int, int]] = []
        self.open: dict[int, _Window] = {}
        self.made = 0

    def _new(self) -> _Window:
        w = self.open[self.made] = _Window(self.made)
        self.made += 1
        return w

    def _placed(self, w: _Window) -> list[_Window]:
        if w.used == self.window:
            del self.open[w.number]
            return [w]
        insort(self.order, (w.used, w.number))
        return []

    def add(self, key, ids: bytes) -> list[_Window]:
        total, start, closed = len(ids) // 4, 0, []
        while start < total:
            size = min(self.window, total - start)
            at = bisect_left(self.order, (self.window - size, 2**62)) - 1  # the fullest that still holds it
            if at >= 0 and size < self.window:
                w = self.open[self.order.pop(at)[1]]
            elif len(self.open) < self.keep or size == self.window:
                w = self._new()
            else:
                w = self.open[self.order.pop()[1]]
                gap = self.window - w.used
                if gap >= self.least and size - gap >= self.least:
                    size = gap
                else:
                    del self.open[w.number]
                    closed.append(w)
                    w = self._new()
            w.add(key, start, ids[4 * start:4 * (start + size)], total)
            start += size
            closed += self._placed(w)
        return closed


def pack(docs: DataFrame, tokenizer_path: str, end_id: int, id_col: str = "doc_id", text_col: str = "text",
         window: int = WINDOW, open_windows: int = OPEN_WINDOWS, least_piece: int = LEAST_PIECE, remembered: int = REMEMBERED,
         batch_bytes: int = BATCH_BYTES) -> DataFrame:
    """One row per piece: ``id_col``, start, length, ids_crc32, doc_tokens, sequence_id, offset, ids.

    A document is its text's ids (null or empty text: none) and ``end_id``, so
    every row of ``docs`` gives at least one piece; null and repeated ids pass
    through, each row being a document of its own. Texts of any length are cut
    at the window. An empty table gives no rows.
    """
    prepare(docs.sparkSession)
    kind = docs.schema[id_col].dataType
    name = kind.simpleString()
    from pyspark.sql.pandas.types import to_arrow_type

    schema = pa.schema([("key", to_arrow_type(kind)), ("start", pa.int64()), ("ids", pa.binary()), ("doc_tokens", pa.int64()),
                        ("part", pa.int32()), ("window", pa.int64()), ("offset", pa.int64()), ("open", pa.bool_())])

    def first(batches):
        from pyspark import TaskContext

        start_task()
        part, packer, rows = TaskContext.get().partitionId(), _Packer(window, open_windows, least_piece), []

        def take(w: _Window, still_open: bool):
            rows.extend((k, s, ids, total, part, w.number, at, still_open) for k, s, ids, total, at in w.pieces)

        def batch_of():
            out = pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)
            rows.clear()
            return out

        for batch in gathered(batches, batch_bytes):
            for key, ids in zip(batch.column(0).to_pylist(), ids_of(tokenizer_path, batch.column(1), end_id, remembered), strict=True):
                for w in packer.add(key, ids):
                    take(w, False)
                if len(rows) >= 1000:
                    yield batch_of()
        for w in packer.open.values():
            take(w, True)
        if rows:
            yield batch_of()

    cut = stage(docs.select(F.col(id_col).alias("key"), F.col(text_col).alias("text")).mapInArrow(
        first, f"key {name}, start bigint, ids binary, doc_tokens bigint, part int, window bigint, offset bigint, open boolean"),
        "windows")

    merged_schema = pa.schema([f for f in schema if f.name != "open"])

    def merge(rows: pa.Table) -> pa.Table:
        """Fill the fullest windows with the pieces of the emptiest, cutting a piece where a window's end falls in it."""
        held: dict[tuple[int, int], list] = {}
        for r in rows.sort_by([("part", "ascending"), ("window", "ascending"), ("offset", "ascending")]).to_pylist():
            held.setdefault((r["part"], r["window"]), []).append((r["key"], r["start"], r["ids"], r["doc_tokens"]))
        windows = [(sum(len(p[2]) for p in pieces) // 4, part, number, pieces) for (part, number), pieces in held.items()]
        windows.sort(key=lambda w: (-w[0], w[1], w[2]))
        out = []
        while windows:
            used, part, number, pieces = windows.pop(0)
            while windows and used < window:
                size, p, n, spare = windows.pop()
                key, start, ids, total = spare.pop(0)
                room = 4 * (window - used)
                pieces.append((key, start, ids[:room], total))
                used += min(room, len(ids)) // 4
                if len(ids) > room:
                    spare.insert(0, (key, start + room // 4, ids[room:], total))
                if spare:
                    windows.append((sum(len(s[2]) for s in spare) // 4, p, n, spare))
            at = 0
            for key, start, ids, total in pieces:
                out.append((key, start, ids, total, part, number, at))
                at += len(ids) // 4
        return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), merged_schema, strict=True)], schema=merged_schema)

    last = cut.filter("open").withColumn("near", F.floor(F.col("part") / MERGED_PARTITIONS)).groupBy("near").applyInArrow(
        merge, f"key {name}, start bigint, ids binary, doc_tokens bigint, part int, window bigint, offset bigint")
    merged = stage(last, "merged")
    pieces = cut.filter("not open").drop("open").unionByName(merged)
    sequence = F.col("part").cast("bigint") * F.lit(2**32) + F.col("window")
    length = (F.length("ids") / 4).cast("bigint")
    return pieces.select(F.col("key").alias(id_col), "start", length.alias("length"), F.crc32("ids").alias("ids_crc32"), "doc_tokens",
                         sequence.alias("sequence_id"), "offset", "ids")


def padding(pieces: DataFrame, window: int = WINDOW) -> DataFrame:
    """One row: sequences, tokens, and the tokens that padding adds (none at a length that is a power of two)."""
    used = pieces.groupBy("sequence_id").agg(F.sum("length").alias("used"))
    whole = F.col("used").bitwiseAND(F.col("used") - 1) == 0
    return used.agg(F.count("*").alias("sequences"), F.sum("used").alias("tokens"),
                    F.sum(F.when(whole, 0).otherwise(window - F.col("used"))).alias("padding"))


