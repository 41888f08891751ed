"""CSV records of files that many tasks read, line breaks inside quotes included, and a second output for bad rows.

Spark's CSV reader takes a file whose fields hold line breaks as one task. Here
the lines are read as text, which splits, and the records are put together:

1. One pass counts the quotes of every split. A line begins a record where
   the number of quotes before it in the file is even (a quote inside quotes is
   doubled, so it changes nothing), so the prefix sums over a file's splits tell
   how each split begins.
2. A second pass joins each split's lines to records. Only the pieces of a
   record that runs over the end of a split are shuffled.

Parsing stays Spark's own (``from_csv``).
"""

from __future__ import annotations

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Characters that a record may have at most; a quote that is never closed makes the rest of its file one record.
MAX_RECORD = 10_000_000

CSV_OPTIONS = {"escape": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}

_PIECE = "file string, block bigint, kind int, value string"
_HEAD, _TAIL, _WHOLE = 0, 1, 2


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """The lines of the files with the file and the first byte of the split that each was read in, in order within a split."""
    return spark.read.option("lineSep", "\n").text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))


def _join_lines(max_record: int):
    def run(batches):
        schema = pa.schema([("file", pa.string()), ("block", pa.int64()), ("kind", pa.int32()), ("value", pa.string())])
        here, inside, head, held, size = None, False, False, [], 0

        def piece(kind):
            return pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip((*here, kind, "\n".join(held)), schema, strict=True)], schema=schema)

        for batch in batches:
            files, blocks, odd = batch.column("file"), batch.column("block"), batch.column("odd")
            runs = [0, *(pc.indices_nonzero(pc.or_(pc.not_equal(files.slice(1), files.slice(0, len(files) - 1)),
                                                   pc.not_equal(blocks.slice(1), blocks.slice(0, len(blocks) - 1)))).to_numpy() + 1).tolist(), len(files)]
            for a, b in zip(runs, runs[1:], strict=False):
                if a == b:
                    continue
                if (files[a].as_py(), blocks[a].as_py()) != here:
                    if held:
                        yield piece(_HEAD if head else _TAIL)
                    here = (files[a].as_py(), blocks[a].as_py())
                    if not odd[a].is_valid:
                        raise ValueError(f"the splits of {here[0]} changed between the two passes; read it again")
                    inside = head = odd[a].as_py()
                    held, size = [], 0
                values = batch.column("value").slice(a, b - a)
                quotes = pc.bit_wise_and(pc.count_substring(values, '"'), 1)
                whole = []
                for text, q in zip(values.to_pylist(), quotes.to_pylist(), strict=True):
                    if not held and not inside and not q:
                        whole.append(text)
                        continue
                    held.append(text)
                    size += len(text) + 1
                    if size > max_record:
                        raise ValueError(f"a record of {here[0]} has over {max_record} characters: a quote that is not closed?")
                    inside ^= bool(q)
                    if not inside:
                        if head:
                            yield piece(_HEAD)
                            head = False
                        else:
                            whole.append("\n".join(held))
                        held, size = [], 0
                if whole:
                    n = len(whole)
                    yield pa.RecordBatch.from_arrays([pa.nulls(n, pa.string()), pa.nulls(n, pa.int64()), pa.array([_WHOLE] * n, pa.int32()), pa.array(whole, pa.string())], schema=schema)
        if held:
            yield piece(_HEAD if head else _TAIL)

    return run


def multi_line_records(spark: SparkSession, path: str, max_record: int = MAX_RECORD) -> DataFrame:
    """(value): the records of the CSV files at ``path``, headers included; read by one task a split.

    The two passes must cut the files alike. Spark does while its file settings
    and the number of cores stay; if a change comes between them, the second
    pass raises and has to be started again.
    """
    lines = _lines(spark, path)
    quotes = lines.groupBy("file", "block").agg((F.sum(F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))) % 2).alias("q"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)   # one row a split
    starts = quotes.select("file", "block", (F.coalesce(F.sum("q").over(before), F.lit(0)) % 2 == 1).alias("odd"))
    # One row for each split, that is for 128 MB of text: a terabyte has some eight thousand.
    pieces = lines.join(F.broadcast(starts), ["file", "block"], "left").select("value", "file", "block", "odd").mapInArrow(_join_lines(max_record), _PIECE)
    broken = pieces.filter(F.col("kind") != _WHOLE)
    order = Window.partitionBy("file").orderBy("block", "kind")   # at most two rows a split: the head comes first
    number = F.sum(F.when(F.col("kind") == _TAIL, 1).otherwise(0)).over(order)
    joined = broken.withColumn("record", number).groupBy("file", "record").agg(
        F.array_sort(F.collect_list(F.struct("block", "kind", "value"))).alias("parts"))   # the pieces of one record
    glued = joined.select(F.array_join(F.transform("parts", lambda p: p["value"]), "\n").alias("value"))
    return pieces.filter(F.col("kind") == _WHOLE).select("value").unionByName(glued)


def csv_records(spark: SparkSession, path: str, multi_line: bool) -> DataFrame:
    """(value): the data records at ``path``, without headers and blank lines; line ends cut off."""
    header = spark.read.option("lineSep", "\n").text(path).first()
    records = multi_line_records(spark, path) if multi_line else _lines(spark, path).select("value")
    value = F.regexp_replace("value", r"\r\z", "")
    records = records.select(value.alias("value")).filter(F.trim("value") != "")
    return records.filter(F.col("value") != header[0].removesuffix("\r")) if header else records


def _as_text(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])


def parse_strict(records: DataFrame, schema: T.StructType, text_types: tuple) -> DataFrame:
    """Records as typed rows; a bad one raises. Columns of ``text_types`` are read as text and cast."""
    read = T.StructType([T.StructField(f.name, T.StringType() if isinstance(f.dataType, text_types) else f.dataType) for f in schema.fields])
    row = F.from_csv("value", read.simpleString().removeprefix("struct<").removesuffix(">").replace(":", " "), CSV_OPTIONS | {"mode": "FAILFAST"})
    parsed = records.select(row.alias("r"))
    return parsed.select(*[F.col(f"r.{f.name}").cast(f.dataType).alias(f.name) for f in schema.fields])


def parse_checked(records: DataFrame, schema: T.StructType) -> DataFrame:
    """Records with ``row`` (typed; a bad cell is NULL) and ``problems``: array of (column, value, reason).

    Reasons: ``not a <type>`` for a cell that the column's type does not take,
    ``field count`` (column and value NULL) for a record with too few or too
    many fields.
    """
    names = ", ".join(f"`{f.name}` string" for f in schema.fields)
    parsed = records.select("value", F.from_csv("value", f"{names}, `_bad` string", CSV_OPTIONS | {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"}).alias("r"))

    def cell(f: T.StructField) -> tuple[Column, Column]:
        text = F.col(f"r.{f.name}")
        typed = text.try_cast(f.dataType)
        wrong = F.when(text.isNotNull() & typed.isNull(), F.struct(
            F.lit(f.name).alias("column"), text.alias("value"), F.lit(f"not a {f.dataType.simpleString()}").alias("reason")))
        return typed.alias(f.name), wrong

    cells = [cell(f) for f in schema.fields]
    count = F.when(F.col("r._bad").isNotNull(), F.struct(F.lit(None).cast("string").alias("column"), F.lit(None).cast("string").alias("value"), F.lit("field count").alias("reason")))
    problems = F.filter(F.array(count, *[w for _, w in cells]), lambda p: p.isNotNull())
    return parsed.select("value", F.struct(*[t for t, _ in cells]).alias("row"), problems.alias("problems"))
