"""From raw documents to packed sequences, one operator per stage.

Every stage takes (spark, docs, sf_dir), works on all rows of ``docs`` and returns a
DataFrame with the columns of ``documents``; the last returns the packing. ``run`` writes
each stage's rows as Parquet in the session's shared folder and reads them for the next, so a
lost executor costs a stage's tasks and never an earlier stage.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from timepoint.llm import mixing, near_dedup, packing, quality_rules, substring_dedup
from timepoint.llm.common import durable, table
from timepoint.llm.queries import tokenizer

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the current policy accepts."""
    return quality_rules.accepted(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: the one with the smallest doc_id."""
    return near_dedup.without_near_duplicates(docs)


def substrings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that an earlier document has."""
    return substring_dedup.cut_repeats(docs)


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it: not at all, once or several times."""
    return mixing.mixed_documents(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents and their places in training sequences."""
    return packing.pack(docs, tokenizer("word_bpe_49k.json"))


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality),
    ("near_dedup", near_duplicates),
    ("substring_dedup", substrings),
    ("source_mix", mixed_sources),
    ("packing", packed),
]

#: The stages cannot be said in SQL; tests compare them with plain versions.
ORACLE_SQL = None


def _folder(spark: SparkSession) -> str:
    """A new folder on the storage that the session shares."""
    durable(spark.range(0))  # a session without a checkpoint folder gets one
    root = spark.sparkContext._jsc.sc().getCheckpointDir().get()
    return f"{root}/pipeline-{uuid.uuid4().hex}"


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    folder = _folder(spark)
    for number, (name, stage) in enumerate(STAGES):
        place = f"{folder}/{number}-{name}"
        stage(spark, docs, sf_dir).write.parquet(place)
        docs = spark.read.parquet(place)
    return docs
