"""Operator 3 [native]: consistent sharding by a permutation-filled lookup table.

Each shard has its own preference order of the table's slots (an offset and a
step from hashes of its name, modulo the prime table size). The shards take
turns; in its turn a shard claims the first slot of its order that is still
free, until the table is full. A key's hash modulo the table size names its
slot, so placing a row is one lookup in a small broadcast table. Every shard
owns as many slots as any other, give or take one, and taking a shard away
moves few keys but its own. Everything is DataFrame expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Slots of the table: a prime, about a hundred for each shard.
TABLE_SIZE = 2039


def _hash(text: Column) -> Column:
    """The first 32 bits of a text's md5 as a bigint."""
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("bigint")


def _is_prime(n: int) -> bool:
    return n > 1 and all(n % d for d in range(2, int(n**0.5) + 1))


def lookup_table(spark: SparkSession, shards: list[str], size: int = TABLE_SIZE) -> DataFrame:
    """(slot int, shard string): ``size`` rows, whatever the data's size.

    The shards' names must differ and none may be null; ``size`` must be a prime
    of at least the number of shards. The fill is a fold over ``size`` turns of
    ``size`` steps each, so keep ``size`` to a few thousand.
    """
    if not _is_prime(size) or not shards or len(set(shards)) < len(shards) or len(shards) > size:
        raise ValueError("size must be a prime of at least the number of shards, and the shards' names must differ")
    names = F.array(*[F.lit(s) for s in shards])

    def order(name: Column) -> Column:
        offset = _hash(F.concat(name, F.lit("#offset"))) % size
        step = _hash(F.concat(name, F.lit("#step"))) % (size - 1) + 1
        return F.transform(F.sequence(F.lit(0), F.lit(size - 1)), lambda j: ((offset + j * step) % size).cast("int"))

    def claim(table: Column, turn: Column) -> Column:
        shard = (turn % len(shards)).cast("int")
        free = F.get(F.filter(F.get(F.col("orders"), shard), lambda s: F.get(table, s) < 0), F.lit(0))
        return F.get(F.transform(F.array(free), lambda at: F.transform(table, lambda v, s: F.when(s == at, shard).otherwise(v))), F.lit(0))

    empty = F.array_repeat(F.lit(-1), size)
    filled = F.aggregate(F.sequence(F.lit(0), F.lit(size - 1)), empty, claim)
    rows = (spark.range(1).select(names.alias("names")).select("names", F.transform("names", order).alias("orders"))
            .select("names", F.posexplode(filled).alias("slot", "owner")))
    return rows.select("slot", F.get("names", F.col("owner")).alias("shard"))


def assign(df: DataFrame, shards: list[str], key_col: str = "doc_id", size: int = TABLE_SIZE) -> DataFrame:
    """``df`` with the columns slot and shard (underscores added where the names are taken).

    The key is ``key_col`` as text; null keys are placed as the empty text, and
    equal keys always share a shard. Rows are neither moved nor dropped; the
    table has ``size`` rows (checked above), so it is broadcast.
    """
    from orderlake.llm._io import free_name

    slot_col, shard_col = free_name(df, "slot"), free_name(df, "shard")
    table = lookup_table(df.sparkSession, shards, size).select(F.col("slot").alias(slot_col), F.col("shard").alias(shard_col))
    key = F.coalesce(F.col(key_col).cast("string"), F.lit(""))
    placed = df.withColumn(slot_col, (_hash(key) % size).cast("int"))
    return placed.join(F.broadcast(table), slot_col).select(*df.columns, slot_col, shard_col)
