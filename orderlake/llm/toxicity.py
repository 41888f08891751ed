"""Operator 10: toxicity by FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

A document's features are the distinct hashes of its words, of neighbouring
word pairs and of pairs with one word between. Training runs through a bounded
sample of labelled documents: every coordinate has its own learning rate, and
the L1 term keeps all but telling coordinates at zero, so the weights that are
broadcast are few. Scoring reads whole texts and shuffles nothing.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlake.llm._io import bounded_sample, free_name, let_go, prepare, stage
from orderlake.llm._text import PieceCache

#: Feature hashes are taken modulo this.
SIZE = 1 << 22
#: Labelled documents of either label that are trained on at most.
SAMPLE = {1: 4000, 0: 6000}
#: FTRL-proximal: learning rate, its softener, L1 and L2; passes over the sample; how often a pass repeats the rarer label 1 at most.
ALPHA, BETA, L1, L2, PASSES, REPEATS = 3.0, 1.0, 12.0, 0.01, 5, 8
#: Score from which a document counts as toxic.
TOXIC = 0.7

_WORD = re.compile(r"\w+")


class Features:
    """text -> sorted distinct feature numbers. Words are runs of letters, digits and underscores, lower-cased."""

    def __init__(self):
        import xxhash

        self._hash = PieceCache(xxhash.xxh32_digest, 400_000)

    def of(self, text: str | None) -> np.ndarray:
        h = np.frombuffer(self._hash.of(_WORD.findall((text or "").lower())), np.uint32).astype(np.uint64)
        parts = [h, h[:-1] * np.uint64(0x9E3779B1) + h[1:] * np.uint64(0x85EBCA77) + np.uint64(1),
                 h[:-2] * np.uint64(0xC2B2AE3D) + h[2:] * np.uint64(0x27D4EB2F) + np.uint64(2)]
        every = np.concatenate(parts)
        return np.unique(((every ^ (every >> np.uint64(29))) % np.uint64(SIZE)).astype(np.int64))


@dataclass(frozen=True)
class Model:
    """Telling coordinates (ascending) with their weights, and the bias."""

    at: np.ndarray
    weight: np.ndarray
    bias: float

    def score(self, features: np.ndarray) -> float:
        total = self.bias
        if len(self.at):
            place = np.minimum(np.searchsorted(self.at, features), len(self.at) - 1)
            total += float(self.weight[place][self.at[place] == features].sum())
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, total))))


def fit(rows: list[tuple[int, np.ndarray]]) -> Model:
    """FTRL-proximal over (label, features) rows in the order given; without both labels, the bias alone tells their share.

    Where label 1 is the rarer, each of its rows counts as several, so that both weigh about the same.
    """
    positive = sum(y for y, _ in rows)
    if not 0 < positive < len(rows):
        return Model(np.zeros(0, np.int64), np.zeros(0), math.log((positive + 0.5) / (len(rows) - positive + 0.5)))
    again = min(REPEATS, max(1, round((len(rows) - positive) / positive)))
    rows = [row for row in rows for _ in range(again if row[0] else 1)]
    z, n = np.zeros(SIZE + 1), np.zeros(SIZE + 1)

    def weights(at):
        return np.where(np.abs(z[at]) <= L1, 0.0, -(z[at] - np.sign(z[at]) * L1) / ((BETA + np.sqrt(n[at])) / ALPHA + L2))

    for _ in range(PASSES):
        for y, features in rows:
            at = np.append(features, SIZE)  # the last coordinate is the bias
            w = weights(at)
            g = 1 / (1 + math.exp(-max(-30.0, min(30.0, float(w.sum()))))) - y
            rate = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / ALPHA
            z[at] += g - rate * w
            n[at] += g * g
    at = np.flatnonzero(np.abs(z[:SIZE]) > L1)   # all others weigh nothing
    return Model(at, weights(at), float(weights(np.array([SIZE]))[0]))


def train(docs: DataFrame, labels: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> Model:
    """A model of the labelled documents that ``learn`` (a condition on ``id_col``) picks.

    At most SAMPLE documents of either label, those with the smallest hashes of
    their ids. Rows without label or id are left out; several labels of one id
    count as the highest. Ids that repeat in ``docs`` train once a row. The
    features are made where the texts are and written once; one task, then the
    driver, holds the bounded sample's.
    """
    spark = docs.sparkSession
    prepare(spark)
    told = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("y"), learn.alias("learn")).filter(
        "id is not null and y is not null and learn").groupBy("id").agg(F.max("y").alias("y"))
    chosen = [bounded_sample(told.filter(F.col("y") == y), F.col("id"), n) for y, n in SAMPLE.items()]
    # At most the sum of SAMPLE ids, so broadcasting them spares shuffling the texts.
    picked = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(chosen[0].unionByName(chosen[1])), "id")

    def features(batches):
        let_go()
        maker = Features()
        for batch in batches:
            out = [maker.of(t.as_py()).astype(np.int32) for t in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.list_(pa.int32()))], names=["mark", "y", "at"])

    made = stage(picked.select(F.xxhash64("id").alias("mark"), "y", "text").mapInArrow(features, "mark bigint, y int, at array<int>"), "features")

    def learn_all(batches):
        let_go()
        rows = sorted(((m.as_py(), y.as_py(), np.array(a.values, np.int32)) for b in batches
                       for m, y, a in zip(b.column(0), b.column(1), b.column(2), strict=True)), key=lambda r: (r[0], r[1], len(r[2])))
        model = fit([(y, at) for _, y, at in rows])
        yield pa.RecordBatch.from_arrays([pa.array([model.at], pa.list_(pa.int64())), pa.array([model.weight], pa.list_(pa.float64())),
                                          pa.array([model.bias])], names=["at", "weight", "bias"])

    row = made.coalesce(1).mapInArrow(learn_all, "at array<bigint>, weight array<double>, bias double").collect()
    if not row:
        return fit([])
    return Model(np.asarray(row[0][0], np.int64), np.asarray(row[0][1], np.float64), row[0][2])


def score(docs: DataFrame, model: Model, text_col: str = "text", out_col: str = "score") -> DataFrame:
    """``docs`` with ``out_col`` (underscores added where that name is taken): how likely label 1 is, 0 to 1.

    Null and empty texts have no features, so the bias alone scores them. Texts
    of any length are read whole. Rows, repeated ones too, stay as they are.
    """
    prepare(docs.sparkSession)
    out_col = free_name(docs, out_col)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        let_go()
        maker, held = Features(), shared.value
        for batch in batches:
            texts = batch.column(batch.schema.names.index(text_col))
            got = pa.array([held.score(maker.of(t.as_py())) for t in texts], pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns, got], names=[*batch.schema.names, out_col])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return docs.mapInArrow(run, f"{fields}, `{out_col}` double")
