"""The training-data pipeline: each stage works on all documents that the stage before kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from claimstrata.llm import decontaminate, line_dedup, mixing, near_dup, repetition
from claimstrata.llm.frames import stored

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return repetition.keep_good(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that repeat an earlier line go, and documents that lose all their words by that."""
    return line_dedup.drop_lines(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays."""
    return near_dup.keep_one(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    items = spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet")
    return decontaminate.drop_contaminated(docs, items)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with the block, slot and place in which they are to be read."""
    return mixing.interleave(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality", quality),
    ("lines", lines),
    ("near_duplicates", near_duplicates),
    ("benchmark", benchmark),
    ("mix", mix),
]

# Suffix arrays and MinHash have no SQL form; the tests hold the stages against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage_{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
