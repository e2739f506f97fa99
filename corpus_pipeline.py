"""Corpus pipeline: stages over ``documents``, each written and reread.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and
returns what the next stage reads. ``run`` applies them to ``documents``.
All but the last return the columns of ``docs``, whatever these are beside
doc_id and text.

Stages decide by doc_id. Rows that share an id are decided together: they
stay if one of them does. A row with a null id cannot be named in a decision
and stays. The SimHash stage decides by row: one row of each group stays.
"""

from __future__ import annotations

import os
import sys

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from ledgerstar.llm import decontam, langid, packing, quality, simhash  # noqa: E402
from ledgerstar.llm.common import table, written  # noqa: E402

#: Below this share, or posterior, of its main language a document is rejected.
LANGUAGE_SCORE = 0.4


def without(docs: DataFrame, judged: DataFrame, keep: str) -> DataFrame:
    """Rows of ``docs`` but those whose id has only rejections in ``judged``."""
    rejected = judged.groupBy("doc_id").agg(F.max(keep).alias("any_kept")).where("not any_kept").select(F.col("doc_id").alias("rejected_id"))
    return docs.join(rejected, docs["doc_id"] == rejected["rejected_id"], "left_anti")


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter, or without a main language, go. Without a
    ``lang`` column or label nothing can be learned, and every document is kept."""
    if "lang" not in docs.columns:
        return docs
    blocks = langid.train(docs.where(langid.fold(parts=4) != 2))
    if not langid.learned(blocks):
        return docs
    judged = langid.predict(docs, blocks)
    return without(docs, judged.withColumn("known", (F.col("lang_pred") != langid.UNKNOWN) & (F.col("score") >= LANGUAGE_SCORE)), "known")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rules, or are probably bad, go."""
    return without(docs, quality.score(docs), "kept")


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies stays, the one with the smallest
    id, null ids last, and of rows that share it the smallest text hash."""
    return simhash.representatives(docs, shingle=4, radius=4)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    judged = decontam.decontaminate(docs, table(spark, sf_dir, "benchmark"))
    return without(docs, judged.withColumn("clean", ~F.col("contaminated")), "clean")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of 4096 tokens."""
    out = packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=2, window=4096)
    return out.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


STAGES = [
    ("language_id", language_id),
    ("quality_rules", quality_rules),
    ("simhash_dedup", simhash_dedup),
    ("decontaminate", decontaminate),
    ("pack", pack),
]

ORACLE_SQL = None  # language mixtures, EM, fingerprints and tokenizers have no SQL form


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
