"""Parquet layers and CSV exports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

MAX_RECORDS_PER_FILE = 5_000_000
# Digests in hex are random to codecs that only look for repeats; this one also halves their digits.
LAYER_CODEC = "zstd"
# A text that comes again in a row group, such as the digest of a person with several sales, is stored once and
# numbered as long as all different texts fit here; by default it is an eighth of this.
DICTIONARY_BYTES = 8 * 1024**2
LAYER_OPTIONS = {
    "compression": LAYER_CODEC,
    "maxRecordsPerFile": MAX_RECORDS_PER_FILE,
    "parquet.dictionary.page.size": DICTIONARY_BYTES,
}
# One task reads a compressed text file from its beginning to its end, so such files hold fewer rows.
MAX_RECORDS_PER_PACKED_FILE = 500_000
PACKED_OPTIONS = {
    "compression": "gzip",
    "maxRecordsPerFile": MAX_RECORDS_PER_PACKED_FILE,
    # A sixth more bytes for a tenth less CPU time of a whole export from JSON.
    "zlib.compress.level": "BEST_SPEED",
}


def write_layer(df: DataFrame, path: str) -> DataFrame:
    """Replace the Parquet layer at ``path`` and return it, read back.

    Every task writes its own files, none above MAX_RECORDS_PER_FILE rows.
    The result starts a new lineage from stored files: later reads get column
    pruning and filter pushdown, and a lost executor costs a re-read, not the
    work before the layer.
    """
    df.write.mode("overwrite").options(**LAYER_OPTIONS).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_csv(df: DataFrame, path: str, gather: bool = False, packed: bool = False) -> None:
    """Replace the CSV directory at ``path``, with a header in every file.

    By default each task writes its files. With ``gather`` Spark first merges
    small partitions up to its advisory partition size: a small aggregate
    becomes one file, and one that turns out large becomes several, so no
    task ever writes an unbounded result alone. ``packed`` files are gzip, a
    fifth of the text; ``read_csv`` and ``read_version`` read either.

    CSV does not keep NULL and empty text apart, and Spark trims outer blanks
    on write. Arrays are rejected.
    """
    frame = df.hint("rebalance") if gather else df
    options = PACKED_OPTIONS if packed else {"compression": "none", "maxRecordsPerFile": MAX_RECORDS_PER_FILE}
    frame.write.mode("overwrite").option("header", True).options(**options).csv(path)


def read_csv(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """A directory written by ``write_csv``, under the given schema."""
    return spark.read.schema(schema).option("header", True).csv(path)
