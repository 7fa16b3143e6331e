"""Session settings. On a cluster these belong to the deployment."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

JSON_SPLIT_BYTES = 256 * 1024**2
JSON_BYTES_PER_PARTITION = 2 * 1024**3
ADVISORY_BYTES = 64 * 1024**2
# Compared with compressed bytes of a partition; the table in memory is several
# times larger, cannot spill, and an executor builds one per task. Spark asks
# that it is not below the advisory size.
HASH_JOIN_BYTES = ADVISORY_BYTES
_SPLITS = "spark.sql.files.maxPartitionBytes"
_PARTITIONS = "spark.sql.shuffle.partitions"


def settings_for(input_bytes: int) -> dict[str, str]:
    """SQL settings for a run over ``input_bytes`` of JSON.

    JSON is read in splits of 256 MB. Shuffles start with one partition per
    2 GB of JSON, at least 200, and adaptive execution merges those that turn
    out small. At 100 TB that is 51,200 partitions of some hundred MB; more
    would make the blocks of a shuffle, one per map and reduce task, tiny.
    A join whose smaller side fits a hash table in every partition, as the
    policy metrics do, runs without sorting the rows.
    """
    partitions = str(max(200, -(-input_bytes // JSON_BYTES_PER_PARTITION)))
    return {
        "spark.sql.adaptive.enabled": "true",
        # The same number twice: adaptive execution starts with the one, and
        # whoever sizes slices or blocks by the shuffle reads the other.
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": partitions,
        _PARTITIONS: partitions,
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(ADVISORY_BYTES),
        "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": str(HASH_JOIN_BYTES),
        _SPLITS: str(JSON_SPLIT_BYTES),
    }


def shuffle_partitions(spark: SparkSession) -> int:
    """The number of partitions a shuffle starts with."""
    initial = spark.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum", None)
    adaptive = spark.conf.get("spark.sql.adaptive.enabled") == "true"
    return int(initial if adaptive and initial else spark.conf.get(_PARTITIONS))


def _bytes(setting: str) -> int:
    """A size setting such as ``134217728b`` or ``16m`` in bytes."""
    text = setting.strip().lower().removesuffix("b")
    unit = {"k": 1024, "m": 1024**2, "g": 1024**3, "t": 1024**4}.get(text[-1:], 1)
    return int(text.rstrip("kmgt")) * unit


def source_bytes(df: DataFrame) -> int:
    """The size of a frame's files as the planned scan knows it."""
    return int(str(df._jdf.queryExecution().analyzed().stats().sizeInBytes()))


@contextmanager
def scan_splits(spark: SparkSession, size: int) -> Iterator[None]:
    """Plan file scans inside the ``with`` block with splits of at most ``size`` bytes."""
    before = spark.conf.get(_SPLITS)
    spark.conf.set(_SPLITS, str(min(size, _bytes(before))))
    try:
        yield
    finally:
        spark.conf.set(_SPLITS, before)


def local_session(cores: int | str = "*", name: str = "claimstrata") -> SparkSession:
    """A single-machine session for tests and the benchmark, without the web page."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
