"""Operator 3 against a plain fill of the table, and its balance."""
import hashlib
from collections import Counter

import pytest

from orderlake.llm import sharding


def plain_table(shards, size):
    h = lambda s: int(hashlib.md5(s.encode()).hexdigest()[:8], 16)
    prefs = [[(h(s + "#offset") % size + j * (h(s + "#step") % (size - 1) + 1)) % size for j in range(size)] for s in shards]
    table, turn = {}, 0
    while len(table) < size:
        i = turn % len(shards)
        table[next(s for s in prefs[i] if s not in table)] = shards[i]
        turn += 1
    return table


def test_table_is_the_plain_fill(spark):
    shards = ["a", "b", "c"]
    assert {r.slot: r.shard for r in sharding.lookup_table(spark, shards, 101).collect()} == plain_table(shards, 101)


def test_assign_balances_and_moves_little(spark):
    df = spark.createDataFrame([(i, "x", i) for i in range(4000)] + [(None, "y", None), (7, "x", 7)], "doc_id long, shard string, slot long")
    got = sharding.assign(df, ["a", "b", "c", "d"], size=211).collect()
    assert len(got) == 4002 and got[0].asDict().keys() == {"doc_id", "shard", "slot", "slot_", "shard_"}
    sizes = Counter(r.shard_ for r in got)
    assert max(sizes.values()) < 1.2 * min(sizes.values())
    assert len({r.shard_ for r in got if r.doc_id == 7}) == 1 and all(r.shard_ for r in got)
    less = {r.doc_id: r.shard_ for r in sharding.assign(df, ["a", "b", "c"], size=211).collect()}
    moved = sum(less[r.doc_id] != r.shard_ for r in got if r.shard_ != "d")
    assert moved < 0.2 * len(got)
    assert sharding.assign(df.limit(0), ["a"], size=11).count() == 0


def test_bad_tables_are_refused(spark):
    for shards, size in ((["a"], 10), ([], 11), (["a", "a"], 11), (list("abcdef"), 5)):
        with pytest.raises(ValueError):
            sharding.lookup_table(spark, shards, size)
