"""The corpus pipeline: language ID, exact de-duplication, MinHash near-duplicates, mixing, packing."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martforge.llm import exact_dedup, language_id, minhash, mixing, packing
from martforge.llm.common import table
from martforge.llm.queries import BYTE_BPE
from martforge.session import scratch_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised: those without a letter go. The model learns from the corpus itself."""
    model = language_id.train(table(spark, sf_dir, "documents").filter(language_id.fold(F.col("doc_id"), 3) != 1))
    found = language_id.detect(docs, model)
    return found.filter(F.col("lang_pred") != language_id.UND).select("row.*")


def distinct_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.dedup(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group: five-word shingles, similarity 0.8 or more."""
    return minhash.dedup(docs, shingle=5)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.packed(docs, BYTE_BPE)


STAGES: list[tuple[str, Stage]] = [
    ("language_id", known_language),
    ("exact_dedup", distinct_texts),
    ("near_dedup", near_duplicates),
    ("mixing", mixed),
    ("packing", packed),
]

#: Neither PPM code lengths nor token ids can be expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
