"""Operator 2: approximate nearest neighbours by multi-index hashing.

A rotation learned on a bounded sample (principal directions, then iterative
quantization) turns each vector into a 64-bit code. A code is cut into eight
substrings, and every substring indexes the codes. Codes within Hamming
distance r of a query agree with it within a few bits in at least one
substring (pigeonhole), so probing the substrings' near values retrieves every
code within r; those are reranked by cosine on the original vectors. The radius
is the one that holds the true neighbours of nearly all sample queries.

Vectors are dealt by hash into shards of bounded size, queries into blocks of
bounded size, and each pair of a block and a shard is one task that indexes its
shard. Nothing depends on how vectors are spread, so common vectors make no
task larger.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderlake.llm._io import bounded_sample, prepare, stage
from orderlake.llm._vectors import exact_cosine, matrix, unit, usable

#: Bits of a code, and of a substring.
BITS, SUB = 64, 8
#: Vectors that the rotation is learned on at most, and sample queries that set the radius.
SAMPLE, SAMPLE_QUERIES = 8000, 400
#: Share of the sample's true neighbours that the radius holds.
HELD = 0.985
#: Vectors of a shard and queries of a block, about.
SHARD, BLOCK = 4096, 4096

_VALUES = np.arange(1 << SUB, dtype=np.int64)
_BIT_COUNT = np.array([bin(v).count("1") for v in _VALUES], np.int64)
#: For each radius, the values within it of each substring value.
_NEAR = [[np.flatnonzero(_BIT_COUNT[_VALUES ^ v] <= r) for v in _VALUES] for r in range(SUB + 1)]


class Codes:
    """The learned projection: unit vector -> 64 bits."""

    def __init__(self, rows: np.ndarray, seed: int = 7, rounds: int = 30):
        random = np.random.default_rng(seed)
        rows = unit(rows)
        self.mean = rows.mean(0)
        centred = rows - self.mean
        _, _, directions = np.linalg.svd(centred, full_matrices=False)
        kept = directions[:BITS].T
        turn, _ = np.linalg.qr(random.normal(size=(kept.shape[1], kept.shape[1])))
        seen = centred @ kept
        for _ in range(rounds):
            u, _, v = np.linalg.svd(np.where(seen @ turn >= 0, 1.0, -1.0).T @ seen)
            turn = (u @ v).T
        self.project = kept @ turn
        if self.project.shape[1] < BITS:  # short vectors: random directions make up the number
            self.project = np.hstack([self.project, random.normal(size=(rows.shape[1], BITS - self.project.shape[1]))])

    def of(self, rows: np.ndarray) -> np.ndarray:
        """(rows, 8) bytes: the substrings."""
        return np.packbits((unit(rows) - self.mean) @ self.project >= 0, axis=1)


def _distance(codes: np.ndarray, code: np.ndarray) -> np.ndarray:
    return _BIT_COUNT[codes ^ code].sum(-1)


def learned_radius(codes: Codes, rows: np.ndarray, k: int) -> int:
    """The Hamming distance within which lie HELD of the k nearest of the sample's first queries, by brute force on the sample."""
    coded, units = codes.of(rows), unit(rows)
    found = []
    for q in range(min(SAMPLE_QUERIES, len(rows))):
        near = units @ units[q]
        near[q] = -2
        top = np.argpartition(-near, min(k, len(rows) - 1))[:k]
        found += _distance(coded[top], coded[q]).tolist()
    return int(np.quantile(found, HELD, method="higher")) if found else BITS


class MultiIndex:
    """Substring tables over one shard's codes."""

    def __init__(self, codes: np.ndarray):
        self.codes = codes
        self.order = [np.argsort(codes[:, t], kind="stable") for t in range(codes.shape[1])]
        self.first = [np.searchsorted(codes[o, t], np.arange((1 << SUB) + 1)) for t, o in enumerate(self.order)]

    def within(self, code: np.ndarray, radius: int) -> np.ndarray:
        """Rows whose code lies within ``radius`` of ``code``: all of them, in ascending order.

        With radius = m a + b over m substrings, such a code is within a in one
        of the first b + 1 substrings or within a - 1 in one of the others.
        """
        m = len(self.order)
        a, b = divmod(radius, m)
        hit = np.zeros(len(self.codes), bool)
        for t in range(m):
            reach = a if t <= b else a - 1
            if reach < 0:
                continue
            values = _NEAR[min(reach, SUB)][code[t]]
            begin, size = self.first[t][values], self.first[t][values + 1] - self.first[t][values]
            at = np.repeat(begin - np.concatenate([[0], np.cumsum(size)[:-1]]), size) + np.arange(size.sum())
            hit[self.order[t][at]] = True
        found = np.flatnonzero(hit)
        return found[_distance(self.codes[found], code) <= radius]


def nearest(df: DataFrame, is_query: Column, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, ``id_col``, score): each query row's ``k`` nearest other rows by cosine, ties to the smaller id.

    ``is_query`` picks the query rows; candidates are all rows but those with
    the query's id. Rows whose vector or id is null, and vectors that are
    empty, zero or hold a null or non-finite component, take no part. Vectors
    of different lengths have no cosine: each length is a table of its own,
    with its own rotation. Where fewer than ``k`` codes lie within the radius,
    a shard is probed again with a larger one, so a query gets min(k, all
    candidates) rows. A table without usable rows gives none.
    """
    spark = df.sparkSession
    prepare(spark)
    vector = F.col(vector_col).cast("array<double>")
    rows = stage(df.filter(usable(F.col(vector_col)) & F.col(id_col).isNotNull())
                 .select(F.col(id_col).cast("bigint").alias("id"), vector.alias("v"), F.coalesce(is_query, F.lit(False)).alias("asks")), "vectors")
    n, asking = rows.agg(F.count("*"), F.count_if("asks")).first()
    if not n:
        return rows.select(F.col("id").alias("query_id"), F.lit(1).alias("rank"), F.col("id").alias(id_col), F.lit(0.0).alias("score")).limit(0)
    lengths = [r[0] for r in rows.select(F.size("v")).distinct().collect()]   # a table has one length, or a few
    found = None
    for wide in sorted(lengths):
        part = rows.filter(F.size("v") == wide) if len(lengths) > 1 else rows
        if len(lengths) > 1:
            n, asking = part.agg(F.count("*"), F.count_if("asks")).first()
        told = _nearest_of_length(part, n, asking, k)
        found = told if found is None else found.unionByName(told)
    # A query has at most k rows from each shard here.
    best = found.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "id")))
    return best.filter(F.col("rank") <= k).select("query_id", "rank", F.col("id").alias(id_col), "score")


def _nearest_of_length(rows: DataFrame, n: int, asking: int, k: int) -> DataFrame:
    """(query_id, id, score): the best ``k`` of every shard for each query, among ``n`` rows (id, v, asks) of one length."""
    sample = matrix(bounded_sample(rows.select("id", "v"), F.col("id"), SAMPLE).orderBy("id").select("v").toArrow().column(0).combine_chunks())
    codes = Codes(sample)
    radius = learned_radius(codes, sample, k)
    shards, blocks = max(1, -(-n // SHARD)), max(1, -(-asking // BLOCK))

    def search(key: tuple, asked: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(asked) and len(held):
            vectors, ids = np.stack(held["v"].to_numpy()), held["id"].to_numpy()
            index, units = MultiIndex(codes.of(vectors)), unit(vectors)
            questions = np.stack(asked["v"].to_numpy())
            question_units = unit(questions)
            for q, (name, code) in enumerate(zip(asked["id"].to_numpy(), codes.of(questions), strict=True)):
                others = int((ids != name).sum())
                reach = radius
                while True:
                    found = index.within(code, reach)
                    found = found[ids[found] != name]
                    if len(found) >= min(k, others):
                        break
                    reach += 4
                near = units[found] @ question_units[q]
                if len(found) > k:
                    found = found[near >= np.partition(near, -k)[-k] - 1e-9]
                score = exact_cosine(vectors[found], questions[q])
                best = np.lexsort((ids[found], -score))[:k]
                out += [(int(name), int(ids[found[i]]), float(score[i])) for i in best]
        return pd.DataFrame(out, columns=["query_id", "id", "score"])

    place = F.xxhash64("id")
    questions = rows.filter("asks").select("id", "v", F.pmod(place, F.lit(blocks)).cast("int").alias("block"),
                                           F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"))
    held = rows.select("id", "v", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"),
                       F.pmod(place, F.lit(shards)).cast("int").alias("shard"))
    return questions.groupBy("block", "shard").cogroup(held.groupBy("block", "shard")).applyInPandas(
        search, "query_id bigint, id bigint, score double")
