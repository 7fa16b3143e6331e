"""A layer laid out by sale month: a directory for each month, read and replaced alone."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from claimstrata.sinks.files import LAYER_OPTIONS
from claimstrata.sinks.storage import Store

MONTH_COLUMN = "sale_month"
# Spark's name for the directory of rows whose partition column is NULL.
_NO_MONTH = "__HIVE_DEFAULT_PARTITION__"


def month_key(day: Column) -> Column:
    """Year and month of a date as a number such as 199803; a NULL day gives NULL."""
    return F.year(day) * 100 + F.month(day)


def _with_month(df: DataFrame, day: str) -> DataFrame:
    return df.withColumn(MONTH_COLUMN, month_key(F.col(day)).cast("int"))


def _together(df: DataFrame) -> DataFrame:
    # Rows of a month come together, so a task does not write a file for every
    # month; adaptive execution then cuts a hot month into pieces of its
    # advisory size and merges small ones.
    return df.hint("rebalance", MONTH_COLUMN)


def _write(df: DataFrame, path: str, mode: str) -> None:
    writer = df.write.mode("overwrite").partitionBy(MONTH_COLUMN)
    writer.options(**LAYER_OPTIONS, partitionOverwriteMode=mode).parquet(path)


def write_months(
    df: DataFrame, path: str, day: str = "sale_day", last: Callable[[DataFrame], DataFrame] | None = None
) -> DataFrame:
    """Replace the layer at ``path`` by the rows of ``df`` in months, and return it, read back.

    ``day`` names a date column. The layer has ``sale_month`` as its last
    column, NULL where the day is; a condition on it picks directories before
    any file is opened. The rows are shuffled once, by month. A month that
    holds most rows is written by several tasks into several files.

    ``last`` is applied to the rows, with ``sale_month``, after their shuffle.
    It is for what makes rows longer and looks at one row alone, such as
    digests of identity numbers: the shuffle files are smaller then. They hold
    what ``last`` replaces; ``spark.io.encryption.enabled`` encrypts them.
    """
    rows = _together(_with_month(df, day))
    rows = last(rows) if last else rows
    _write(rows, path, "static")
    return read_months(df.sparkSession, path, rows.schema)


def read_months(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The layer under the schema it was written with, ``sale_month`` among its columns or not."""
    if MONTH_COLUMN not in schema.names:
        schema = StructType([*schema.fields, StructField(MONTH_COLUMN, IntegerType())])
    return spark.read.schema(schema).parquet(path)


def month_directory(path: str, month: int | None) -> str:
    return f"{path}/{MONTH_COLUMN}={_NO_MONTH if month is None else month}"


def replace_month(df: DataFrame, path: str, month: int | None, day: str = "sale_day") -> None:
    """Put the rows of ``df`` that fall into ``month`` (as 199803; None for no date) in place of that month's.

    Other months' files are not touched, and rows of ``df`` in other months are
    not used. The new files are staged and take the place of the old ones at
    the end, so ``df`` may read the very layer. With no rows the month goes.
    """
    key = F.col(MONTH_COLUMN)
    rows = _with_month(df.drop(MONTH_COLUMN), day)
    rows = rows.where(key.isNull() if month is None else key == month)
    if rows.isEmpty():
        Store(df.sparkSession, path).delete(month_directory(path, month))
    else:
        _write(_together(rows), path, "dynamic")
