"""Corpus pipeline: quality rules, line dedup, near-dedup, decontamination, packing.

Every stage takes what the one before kept and returns documents with all their
columns; the last returns the packed pieces. ``run`` writes each stage as Parquet in the
shared checkpoint folder and reads it back, so a lost executor costs a stage's tasks at
most. Every stage that rejects rows judges each text for itself: equal rows (doc_id and
text) stay or go together; rows without a doc_id, or with one doc_id and different texts,
do not.
"""

from __future__ import annotations

import functools
import uuid

from pyspark.sql import DataFrame, SparkSession

from pitchside.llm import common, decontaminate, lines, near_dup, packing, quality, tokens
from pitchside.sources import store

SHINGLE_WORDS = 5
SIMILARITY_PERCENT = 80


def _each_text(stage):
    """The stage over rows whose doc_id stands for one text; doc_ids come back as given."""

    @functools.wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        rows, own = common.with_own_ids(docs)
        return common.with_given_ids(stage(spark, rows, sf_dir), own, docs.columns)

    return run_stage


@_each_text
def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go; the others lose their frequent lines."""
    return quality.kept_documents(docs, copies_once=True)


@_each_text
def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that many documents hold stay in the last of them only."""
    return lines.documents_without(docs)


@_each_text
def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document with the smallest id stays
    (rows without a doc_id come after all others)."""
    found = near_dup.near_duplicates(docs, SHINGLE_WORDS, SIMILARITY_PERCENT)
    return common.without(docs, found.where("_id <> comp"))


@_each_text
def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    _, spans, _ = decontaminate.contamination(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return common.without(docs, spans)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of all documents in sequences of at most 2048."""
    out = packing.pack(docs, tokens.vocabulary("byte_bpe_50k.json"))
    return out.select(common.public_id(), "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("best_fit_packing", best_fit_packing),
]
# tokens and similarity cannot be expressed in SQL; tests hold run() against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    root = f"{store.folder(spark)}/pipeline-{uuid.uuid4().hex}"
    for i, (name, stage) in enumerate(STAGES):
        path = f"{root}/{i}_{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
