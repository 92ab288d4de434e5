"""The corpus pipeline: quality rules, near duplicates, benchmark passages, packing.

Each stage takes the documents that the stage before it kept, written as Parquet and read again, and its decisions take
effect: rejected rows are gone. All stages but the last return the columns of documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trendspark.llm.arrow import stored
from trendspark.llm.bagminhash import keep_one_of_each
from trendspark.llm.decontamination import keep_clean
from trendspark.llm.packing import pack
from trendspark.llm.quality import keep_quality
from trendspark.llm.tokens import vocabulary_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that meet the base rule and the cascade."""
    return keep_quality(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates, the one with the smallest id."""
    return keep_one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages of the benchmark."""
    return keep_clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in packed sequences."""
    pieces = pack(docs, vocabulary_path("byte_bpe_50k.json"))
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


STAGES: list[tuple[str, Stage]] = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("packing", packing),
]

# Packing needs a vocabulary's ids, which SQL has not.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
