"""Operator 11: importance resampling of documents towards a target distribution of hashed n-grams.

Texts become features inside Arrow tasks: ``ascii_lower``, ``split_pattern_regex``,
``list_flatten`` and ``dictionary_encode`` number a batch's words; the numbers,
shifted against themselves, form pairs, of which only the distinct ones are
hashed (crc32), and a pair with one more word is again a pair. Each feature
falls in one of a fixed number of buckets. A first pass counts the buckets of
all documents and all target texts (each task adds up its own counts before
the shuffle); a second one takes every feature's gain, the scaled log ratio of
its bucket's two shares, and sums them over each document. Adding Gumbel noise
drawn from the id and keeping the highest scores samples without replacement.

Texts are never shuffled; the ranks come from a range-partitioned sort of
narrow rows.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlake.llm._io import free_name, prepare, stage
from orderlake.operators.ranking import rank_over

#: What stands between words: all ASCII characters but digits and (lower-cased) letters.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Buckets of features; both tables of counts have at most so many rows.
BUCKETS = 10_000
#: Longest run of words that is a feature.
WORDS = 1
#: Scale of gains and noise: both are whole numbers.
SCALE = 1000


def numbered_words(texts: pa.Array, separators: str = SEPARATORS) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """Where each text's words begin and the last one's end, every word's number, and the distinct words as UTF-8 (A-Z lower-cased)."""
    lists = pc.split_pattern_regex(pc.ascii_lower(pc.fill_null(texts, "")), separators)
    coded = pc.list_flatten(lists).dictionary_encode()
    numbers = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    sizes = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
    at = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
    empty = pc.index(coded.dictionary, pa.scalar("", coded.dictionary.type)).as_py()
    if empty >= 0:  # before a leading separator and after a trailing one
        kept = numbers != empty
        at = np.concatenate([[0], np.cumsum(kept, dtype=np.int64)])[at]
        numbers = numbers[kept]
    return at, numbers, coded.dictionary.cast(pa.binary()).to_pylist()


def features(texts: pa.Array, words: int, buckets: int):
    """For runs of 1 to ``words`` words: (where each text's runs begin and the last one's end, distinct runs' buckets, every run's number among them)."""
    at, numbers, spelled = numbered_words(texts)
    sizes = np.diff(at)
    crc = np.fromiter(map(zlib.crc32, spelled), np.int64, len(spelled))
    yield at, crc % buckets, numbers
    runs, ends = numbers, np.repeat(at[1:], sizes)  # runs[i]: the number of the run that begins at word i
    starts = np.arange(len(numbers))
    for size in range(2, words + 1):
        whole = starts + size <= ends
        starts, ends = starts[whole], ends[whole]
        pairs = runs[whole] * len(spelled) + numbers[starts + size - 1]
        distinct, runs = np.unique(pairs, return_inverse=True)
        crc = np.fromiter((zlib.crc32(b" " + spelled[last], int(crc[first])) for first, last in zip(
            *np.divmod(distinct, max(1, len(spelled))), strict=True)), np.int64, len(distinct))
        yield np.concatenate([[0], np.cumsum(np.maximum(sizes - size + 1, 0))]), crc % buckets, runs


def bucket_counts(docs: DataFrame, text_col: str = "text", words: int = WORDS, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, n): the features of all rows of ``docs`` in each bucket that has any. Null and empty texts have none."""
    prepare(docs.sparkSession)

    def count(batches):
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for _, bucket, runs in features(batch.column(0), words, buckets):
                total += np.bincount(bucket[runs], minlength=buckets)
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(total[found])], names=["bucket", "n"])

    return docs.select(text_col).mapInArrow(count, "bucket bigint, n bigint").groupBy("bucket").agg(F.sum("n").alias("n"))


def _vector(counts: DataFrame, buckets: int) -> np.ndarray:
    out = np.zeros(buckets, np.int64)
    for bucket, n in counts.collect():  # at most ``buckets`` rows
        out[bucket] = n
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Each bucket's gain: floor of SCALE times the log ratio of its add-one shares in the target and in the source."""
    size, s_all, t_all = len(source), float(source.sum()), float(target.sum())
    return np.array([math.floor(SCALE * math.log((t + 1.0) * (s_all + size) / ((s + 1.0) * (t_all + size))))
                     for s, t in zip(source.tolist(), target.tolist(), strict=True)], np.int64)


def weigh(docs: DataFrame, gain: np.ndarray, text_col: str = "text", words: int = WORDS,
          names: Sequence[str] = ("n_words", "n_features", "weight")) -> DataFrame:
    """``docs`` without its text, with its words, its features and the sum of their gains (bigints, 0 where there are none)."""
    prepare(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(gain)  # one number a bucket
    kept = [c for c in docs.columns if c != text_col]

    def run(batches):
        table = pa.array(shared.value)
        for batch in batches:
            counted, summed, first = 0, 0, None
            for at, bucket, runs in features(batch.column(batch.schema.names.index(text_col)), words, len(table)):
                taken = table.take(pa.array(bucket)).take(pa.array(runs)).to_numpy(zero_copy_only=False)
                until = np.concatenate([[0], np.cumsum(taken)])
                first = np.diff(at) if first is None else first
                counted, summed = counted + np.diff(at), summed + until[at[1:]] - until[at[:-1]]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), *(pa.array(x, pa.int64()) for x in (first, counted, summed))],
                                             names=[*kept, *names])

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema if f.name != text_col]
    return docs.mapInArrow(run, ", ".join([*fields, *(f"`{n}` bigint" for n in names)]))


def noise(key: Column, seed: str) -> Column:
    """Standard Gumbel noise drawn from ``seed`` and ``key`` (null: empty text), times SCALE, rounded down."""
    digits = F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))), 256), 1, 8)
    drawn = F.conv(digits, 16, 10).cast("bigint").cast("double")
    return F.floor(F.lit(-float(SCALE)) * F.log(-F.log((drawn + 0.5) / 4294967296.0)))


def resample(docs: DataFrame, target: DataFrame, percent: int = 10, least_words: int = 20, seed: str = "2024", words: int = WORDS,
             buckets: int = BUCKETS, id_col: str = "doc_id", text_col: str = "text", carry: Sequence[str] = ()) -> DataFrame:
    """Every row of ``docs``: ``id_col``, the columns ``carry``, n_words, n_features, weight, score and rank.

    Of the N rows with at least ``least_words`` words, floor(``percent`` * N / 100)
    are drawn: those with the highest scores, ties to the smaller id (null ids
    last). Their rank counts from 1; it is null for all others. Null and empty
    texts have no features and weight 0. Repeated rows are drawn separately;
    rows with one id share its noise. New columns whose names ``carry`` takes
    get underscores. Empty ``docs`` give no rows; without target texts every
    gain compares with an even distribution.
    """
    kept = docs.select(id_col, *carry)
    named = [free_name(kept, n) for n in ("n_words", "n_features", "weight", "score", "rank")]
    n_words, n_features, weight, score, rank = named
    gain = gains(_vector(bucket_counts(docs, text_col, words, buckets), buckets),
                 _vector(bucket_counts(target, text_col, words, buckets), buckets))
    aside = free_name(kept, "text_")  # the text under a name that no kept column has
    weighed = weigh(docs.select(id_col, *carry, F.col(text_col).alias(aside)), gain, aside, words, named[:3])
    scored = stage(weighed.withColumn(score, F.col(weight) + noise(F.col(id_col), seed)), "scored")
    able = scored.filter(F.col(n_words) >= least_words)
    drawn = able.count() * percent // 100
    ranked = rank_over(able, score, descending=True, method="row_number", tie_break=[id_col, n_features], out=rank)
    ranked = ranked.withColumn(rank, F.when(F.col(rank) <= drawn, F.col(rank)))
    others = scored.filter(F.col(n_words) < least_words).withColumn(rank, F.lit(None).cast("bigint"))
    return ranked.unionByName(others)
