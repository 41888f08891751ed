"""Operator 4: token ids in binary files, each document compressed on its own with a shared dictionary.

File format (a folder):

``dictionary/``
    One row: ``dict_hash`` (sha256 in hex) and ``dictionary`` (zstandard
    dictionary trained on serialized id arrays; empty if there was too little
    to train on).
``blocks/``
    Rows of ``part`` and ``block`` (ascending doc ids), ``dict_hash``,
    ``first`` (ids of the part before the block), ``doc_ids``, ``sizes`` (ids
    of each document), ``offsets`` (where each document's frame begins in
    ``payload``, and where the last ends) and ``payload`` (one zstandard frame
    per document: its ids as little-endian unsigned 32-bit integers).

``offsets`` is the index: it can be read without the payloads, and one short
document costs one slice of one block. Spark's own writer commits the files,
so a lost executor leaves no half-written part.
"""

from __future__ import annotations

import hashlib
import zlib

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from orderlake.llm._io import bounded_sample, prepare
from orderlake.llm._batch import gathered
from orderlake.llm._tokens import ids_of, start_task

#: Documents that the dictionary is trained on, and ids taken of each: a bounded sample, for the dictionary alone.
SAMPLE_DOCS, SAMPLE_IDS = 1000, 2048
#: Bytes of the dictionary.
DICT_BYTES = 64 * 1024
#: Bytes of compressed frames after which a block ends, and documents in a block at most.
BLOCK_BYTES, BLOCK_DOCS = 2_000_000, 2000
#: Bytes of text that are coded at once; only speed and memory depend on it.
BATCH_BYTES = 5_000_000


def train_dictionary(docs: DataFrame, tokenizer_path: str, end_id: int, id_col: str = "doc_id", text_col: str = "text") -> bytes:
    """A dictionary trained on the serialized ids of a bounded sample; empty if zstandard finds too little in it."""
    import zstandard

    prepare(docs.sparkSession)

    def serialized(batches):
        start_task()
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([i[:4 * SAMPLE_IDS] for i in ids_of(tokenizer_path, batch.column(0), end_id)], pa.binary())], names=["ids"])

    sample = bounded_sample(docs.select(id_col, text_col), F.col(id_col), SAMPLE_DOCS)
    found = [bytes(r[0]) for r in sample.select(text_col).mapInArrow(serialized, "ids binary").collect()]
    try:
        return zstandard.train_dictionary(DICT_BYTES, found).as_bytes()
    except (zstandard.ZstdError, ValueError, TypeError):
        return b""


def write(docs: DataFrame, folder: str, tokenizer_path: str, end_id: int, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Write all of ``docs`` to ``folder`` (any path that Spark writes) in ascending ``id_col`` order.

    A null or empty text is the end id alone. Null ids come first; rows with
    the same id follow one another in the order of their texts' hashes (equal
    rows are alike). Other columns are not read. Texts of any length: a frame
    may be longer than a block. An empty table gives a folder without blocks.
    """
    import zstandard

    spark = docs.sparkSession
    prepare(spark)
    told = train_dictionary(docs, tokenizer_path, end_id, id_col, text_col)
    dict_hash = hashlib.sha256(told).hexdigest()
    spark.range(1).select(F.lit(dict_hash).alias("dict_hash"), F.lit(told).alias("dictionary")).coalesce(1).write.parquet(f"{folder}/dictionary")
    name = docs.schema[id_col].dataType.simpleString()
    from pyspark.sql.pandas.types import to_arrow_type

    schema = pa.schema([("part", pa.int32()), ("block", pa.int64()), ("dict_hash", pa.string()), ("first", pa.int64()),
                        ("doc_ids", pa.list_(to_arrow_type(docs.schema[id_col].dataType))), ("sizes", pa.list_(pa.int64())),
                        ("offsets", pa.list_(pa.int64())), ("payload", pa.binary())])

    def blocks(batches):
        from pyspark import TaskContext

        start_task()
        part, number, first = TaskContext.get().partitionId(), 0, 0
        press = zstandard.ZstdCompressor(level=1, dict_data=zstandard.ZstdCompressionDict(told) if told else None)
        keys, sizes, frames, offsets = [], [], [], [0]

        def block():
            return pa.RecordBatch.from_arrays([pa.array([c], f.type) for c, f in zip(
                (part, number, dict_hash, first, keys, sizes, offsets, b"".join(frames)), schema, strict=True)], schema=schema)

        for batch in gathered(batches, BATCH_BYTES):
            for key, ids in zip(batch.column(0).to_pylist(), ids_of(tokenizer_path, batch.column(1), end_id), strict=True):
                frame = press.compress(ids)
                keys.append(key), sizes.append(len(ids) // 4), frames.append(frame), offsets.append(offsets[-1] + len(frame))
                if offsets[-1] >= BLOCK_BYTES or len(keys) >= BLOCK_DOCS:
                    yield block()
                    number, first = number + 1, first + sum(sizes)
                    keys, sizes, frames, offsets = [], [], [], [0]
        if keys:
            yield block()

    tie = F.xxhash64(F.col(text_col))
    ordered = (docs.select(F.col(id_col), F.col(text_col), tie.alias("tie_")).repartitionByRange(F.col(id_col), F.col("tie_"))
               .sortWithinPartitions(F.col(id_col), F.col("tie_")).select(id_col, text_col))
    ordered.mapInArrow(blocks, f"part int, block bigint, dict_hash string, first bigint, doc_ids array<{name}>, "
                       "sizes array<bigint>, offsets array<bigint>, payload binary") \
        .write.option("compression", "none").parquet(f"{folder}/blocks")


def _dictionary(spark: SparkSession, folder: str) -> tuple[str, bytes]:
    row = spark.read.parquet(f"{folder}/dictionary").first()
    return row[0], bytes(row[1])


def _presser(told: bytes):
    import zstandard

    return zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(told) if told else None)


def read(spark: SparkSession, folder: str, id_col: str = "doc_id") -> DataFrame:
    """Every document of the files: ``id_col``, start (ids of all documents before it), n_tokens, ids_crc32, ids (binary).

    A block whose ``dict_hash`` is not the dictionary's raises an error.
    """
    dict_hash, told = _dictionary(spark, folder)
    files = spark.read.parquet(f"{folder}/blocks")
    kind = files.schema["doc_ids"].dataType.elementType
    from pyspark.sql.pandas.types import to_arrow_type

    schema = pa.schema([(id_col, to_arrow_type(kind)), ("part", pa.int32()), ("start", pa.int64()), ("n_tokens", pa.int64()),
                        ("ids_crc32", pa.int64()), ("ids", pa.binary())])

    def unpack(batches):
        open_frame = _presser(told)
        for batch in batches:
            for row in range(batch.num_rows):
                part, used, first, keys, sizes, offsets, payload = (batch.column(i)[row].as_py() for i in range(7))
                if used != dict_hash:
                    raise ValueError(f"block of part {part} needs dictionary {used}")
                at, out = first, []
                for i, key in enumerate(keys):
                    ids = open_frame.decompress(payload[offsets[i]:offsets[i + 1]], max_output_size=4 * sizes[i])
                    out.append((key, part, at, len(ids) // 4, zlib.crc32(ids), ids))
                    at += sizes[i]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)

    docs = files.select("part", "dict_hash", "first", "doc_ids", "sizes", "offsets", "payload").mapInArrow(
        unpack, f"`{id_col}` {kind.simpleString()}, part int, start bigint, n_tokens bigint, ids_crc32 bigint, ids binary")
    # One row per part, from the index columns alone; a part is a task of the writer, so this window stays small.
    ids = F.aggregate("sizes", F.lit(0).cast("bigint"), lambda a, b: a + b)
    totals = files.groupBy("part").agg(F.sum(ids).alias("ids"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select("part", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("base"))
    return docs.join(F.broadcast(bases), "part").select(id_col, (F.col("base") + F.col("start")).alias("start"), "n_tokens", "ids_crc32", "ids")


def fetch(spark: SparkSession, folder: str, doc_ids: list, id_col: str = "doc_id") -> DataFrame:
    """``id_col`` and ids (array<bigint>) of a few documents: only their blocks' payloads are opened, and in them only their frames."""
    dict_hash, told = _dictionary(spark, folder)
    files = spark.read.parquet(f"{folder}/blocks")
    name = files.schema["doc_ids"].dataType.elementType.simpleString()
    wanted = F.array(*[F.lit(i) for i in doc_ids]).cast(f"array<{name}>")

    def slices(batches):
        import numpy as np

        open_frame = _presser(told)
        for batch in batches:
            frames = [open_frame.decompress(f.as_py(), max_output_size=4 * n.as_py()) for f, n in zip(batch.column(1), batch.column(2), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([np.frombuffer(f, np.uint32) for f in frames], pa.list_(pa.int64()))],
                                             names=[id_col, "ids"])

    found = files.filter((F.col("dict_hash") == dict_hash) & F.arrays_overlap("doc_ids", wanted)).select(
        "payload", "offsets", F.posexplode(F.arrays_zip("doc_ids", "sizes")).alias("at", "doc")).filter(F.array_contains(wanted, F.col("doc.doc_ids")))
    begin, end = F.get("offsets", F.col("at")), F.get("offsets", F.col("at") + 1)
    return found.select(F.col("doc.doc_ids").alias(id_col), F.substring("payload", (begin + 1).cast("int"), (end - begin).cast("int")).alias("frame"),
                        F.col("doc.sizes").alias("n")).mapInArrow(slices, f"`{id_col}` {name}, ids array<bigint>")
