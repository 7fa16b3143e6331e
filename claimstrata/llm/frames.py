"""Stored frames, packed exchanges between blocks and buckets, connected components."""

from __future__ import annotations

import pathlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimstrata.session import shuffle_partitions
from claimstrata.sinks.lineage import new_folder

__all__ = ["components", "dealt", "new_folder", "renamed", "shuffle_partitions", "stored", "with_package"]


def stored(df: DataFrame, name: str) -> DataFrame:
    """The frame written to the shared folder and read back, which cuts its lineage."""
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def dealt(df: DataFrame) -> DataFrame:
    """The frame as a side of a join that shuffles both sides and broadcasts neither.

    For tables that grow with the input. Spark broadcasts by the size of files,
    and packed columns of numbers are ten times as large and more in a
    driver's memory, which then holds every such table of a plan at once.
    """
    return df.hint("merge")


def renamed(docs: DataFrame, *own: str) -> tuple[DataFrame, dict[str, str]]:
    """The frame with all columns but ``own`` under made names, and the made name of each column.

    Operators that add columns of their own work on such a frame, so that none
    of a caller's columns can have the name of one of theirs.
    """
    made = {name: name if name in own else f"c{i}" for i, name in enumerate(docs.columns)}
    return docs.select(*(F.col(f"`{name}`").alias(inner) for name, inner in made.items())), made


def with_package(spark: SparkSession) -> SparkSession:
    """The session, with Python workers told where this package lies.

    On a cluster the path must exist on every executor or the package be
    shipped with the job; a session that was started elsewhere needs it too.
    """
    root = str(pathlib.Path(__file__).resolve().parents[2])
    environment = spark.sparkContext.environment
    known = environment.get("PYTHONPATH", "")
    if root not in known.split(":"):
        environment["PYTHONPATH"] = f"{root}:{known}" if known else root
    return spark


def components(edges: DataFrame) -> DataFrame:
    """``node, label`` for every node of the edges ``a, b``: the smallest node reachable.

    Alternating large and small stars: each round links the larger neighbours
    of every node, then the smaller ones, to the smallest neighbour, until all
    edges lead to their component's smallest node. The rounds grow with the
    logarithm of the longest path. Smallest neighbours come from a grouping
    with partial results, and a node of very many edges is split by adaptive
    execution, as it meets one row of the other side. Edges of each round are
    stored and shuffled, never broadcast; the driver sees their number and a
    checksum. No edges, no rows.
    """
    edges = edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    edges = stored(edges.distinct(), "edges")
    seen = None
    while True:
        mark = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
        if mark == seen:
            break
        seen = mark
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        lowest = both.groupBy("u").agg(F.min("v").alias("m"))
        lowest = lowest.select("u", F.least("u", "m").alias("m"))
        upper = edges.select(F.col("v").alias("u"), F.col("u").alias("w")).join(dealt(lowest), "u")
        large = upper.select(F.col("w").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        lowest = large.groupBy("u").agg(F.min("v").alias("m"))
        lower = large.join(dealt(lowest), "u")
        small = lower.select(
            F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")
        ).select("e.*")
        edges = stored(small.where("u <> v").distinct(), "edges")
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("label")).unionByName(roots)
