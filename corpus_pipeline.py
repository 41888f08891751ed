"""The corpus pipeline: toxicity filter, language filter, near-duplicate removal, personal-data redaction, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; what it returns
is written as Parquet and reread as the next one's ``docs``. All but the last
return the columns of ``docs``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlake.llm import jaccard, language, packing, pii, toxicity
from orderlake.llm._io import crc32_of, free_name, stage

#: No SQL expresses the classifiers and the packing; tests/llm checks each stage instead.
ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents whose toxicity score stays below the threshold (operator 10, trained on the labelled two thirds)."""
    learn = crc32_of(F.col("doc_id")) % 3 != 1
    model = toxicity.train(docs, spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet"), learn)
    column = free_name(docs, "score")
    return toxicity.score(docs, model, out_col=column).filter(F.col(column) < toxicity.TOXIC).select(docs.columns)


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that have a letter and are written in a learned language's letters (operator 8).

    Rejected: ``und``, and texts of any length with more than language.FOREIGN
    of their letters in no learned language. A text's language need not be
    the one that its row declares. Where no row has a language to learn from,
    all documents stay.
    """
    sample = language.train(docs, crc32_of(F.col("doc_id")) % 4 != 2)
    if not sample.languages:
        return docs
    names = [free_name(docs, n) for n in ("lang_pred", "score", "phrase_rate", "strange")]
    told = language.predict(docs, sample, lang_out=names[0], score_out=names[1], rate_out=names[2], strange_out=names[3])
    return told.filter((F.col(names[0]) != "und") & (F.col(names[3]) <= language.FOREIGN)).select(docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the one whose id is the group's smallest (operator 7).

    Rows that share that id stay where their texts differ. Of a group where no
    row has an id, the text with the smallest hash stays. Texts without a
    shingle are in no group, so they stay once each.
    """
    groups = stage(jaccard.near_duplicates(docs, keys=True), "groups")
    keep = groups.filter("doc_id = component_id").select("doc_id").distinct()
    kept = docs.join(keep, "doc_id", "left_semi").select(docs.columns)
    nameless = groups.filter("doc_id is null and component_id is null")
    if not nameless.isEmpty():
        marks = nameless.groupBy("component_key", F.when(F.col("component_key").isNull(), F.col("mark")).alias("own")).agg(F.min("mark").alias("mark_"))
        bare = docs.filter("doc_id is null")
        kept = kept.unionByName(bare.join(marks.select("mark_"), F.xxhash64("text") == F.col("mark_"), "left_semi").select(docs.columns))
    return kept.dropDuplicates(["doc_id", "text"])


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, each span of personal data replaced by its kind in angle brackets (operator 9); n_chars follows the text."""
    names = [free_name(docs, n) for n in ("base", "spans", "redacted")]
    told = pii.find(docs, pii.train(docs), base_out=names[0], spans_out=names[1], redacted_out=names[2])
    new = {"text": F.col(names[2]), "n_chars": F.length(names[2]).cast(docs.schema["n_chars"].dataType) if "n_chars" in docs.columns else None}
    return told.select(*[new[c].alias(c) if c in new else F.col(c) for c in docs.columns])


def pack_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in their sequences (operator 6).

    Spark's Python workers still hold what the earlier stages left, so this one remembers fewer pieces of text.
    """
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=1, remembered=350_000, batch_bytes=2_000_000).drop("ids")


STAGES = [
    ("toxicity", drop_toxic),
    ("language", keep_known_languages),
    ("near_duplicates", drop_near_duplicates),
    ("personal_data", redact_personal_data),
    ("packing", pack_documents),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table ``documents``."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
