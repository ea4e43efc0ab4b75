"""The corpus pipeline: quality rules, line dedup, near-dedup, mixing, packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerlake.llm import line_dedup, mixing, near_dup, packing, quality
from ledgerlake.llm.queries import pack_tokenizer
from ledgerlake.llm.storage import ship_code, written


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Quality rules: documents that fail the base rules or the trees go."""
    ship_code(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality.keep_good(docs, quality.fit_quality(docs, labels))


def distinct_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Line dedup: later occurrences of three consecutive lines are cut out."""
    return line_dedup.without_repeated_windows(docs)


def one_of_each_class(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """MinHash near-dedup: one document of each group stays."""
    return near_dup.one_of_each(docs)


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mixing: a row for each pass over a source that takes words of a document, with those words."""
    return mixing.mixture(docs)


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Best-fit packing: the place of every piece in sequences of 4096 tokens."""
    return packing.pack(docs, pack_tokenizer())


STAGES = [
    ("quality_rules", good_documents),
    ("line_dedup", distinct_lines),
    ("near_dedup", one_of_each_class),
    ("source_mixing", mixed_sources),
    ("best_fit_packing", packed_sequences),
]

ORACLE_SQL = None  # fitted trees and packing cannot be expressed in SQL


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
