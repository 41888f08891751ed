"""The ``opN_*`` queries: each applies its operator to the whole of its table and derives the result columns."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlake.llm import ann, bpe, jaccard, language, matching, merkle, packing, pii, pivots, resampling, sharding, token_files, toxicity
from orderlake.llm._io import crc32_of, new_folder
from orderlake.llm.oracle import ORACLES

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

#: Shards of op3.
SHARDS = [f"shard-{i:02d}" for i in range(16)]


def _register(fn):
    QUERIES[fn.__name__] = fn
    return fn


def held_out(divisor: int, remainder: int) -> Column:
    """Whether the id's crc32 has the remainder; a row without an id is never learned from, so it counts as held out."""
    return F.coalesce(crc32_of(F.col("doc_id")) % divisor == remainder, F.lit(True))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


@_register
def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    coded = bpe.encode(table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)
    return bpe.digests(bpe.decode(coded, ranks))


@_register
def op2_nearest_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


@_register
def op3_shard_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign(table(spark, sf_dir, "documents").select("doc_id", "source"), SHARDS)


@_register
def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark, "token_files")
    token_files.write(table(spark, sf_dir, "documents"), folder, public_tokenizers.path("byte_bpe_50k.json"), end_id=0)
    return token_files.read(spark, folder).select("doc_id", "start", "n_tokens", "ids_crc32")


@_register
def op5_linked_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pivots.linked_vectors(table(spark, sf_dir, "embeddings"))


@_register
def op6_pack_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), end_id=1).drop("ids")


@_register
def op7_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_duplicates(table(spark, sf_dir, "documents"))


@_register
def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    apart = held_out(4, 2)
    sample = language.train(docs, ~apart)
    return language.predict(docs.select("doc_id", apart.alias("held_out"), "text"), sample).select("doc_id", "held_out", "lang_pred", "score", "phrase_rate")


@_register
def op9_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = pii.find(docs, pii.train(docs))
    counts = [pii.count_of("base", kind).alias(f"n_{kind}") for kind in pii.KINDS]
    return found.select("doc_id", *counts, F.sha2(pii.joined(F.col("base")), 256).alias("base_sha256"), pii.joined(F.col("spans")).alias("spans"))


@_register
def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    apart = held_out(3, 1)
    model = toxicity.train(docs, table(spark, sf_dir, "labels"), ~apart)
    scored = toxicity.score(docs.select("doc_id", apart.alias("held_out"), "text"), model)
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= toxicity.TOXIC).cast("int").alias("predicted"))


@_register
def op11_resample_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    drawn = resampling.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


@_register
def op12_text_probability(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = matching.score(docs, ~held_out(10, 0))
    return scored.select("doc_id", (~F.col("learned")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


@_register
def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    fields = ["doc_id", "source", "lang", "n_chars", "text"]
    return merkle.manifest(table(spark, sf_dir, "documents"), fields, merkle.tampered()).drop("path")
