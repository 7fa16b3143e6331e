"""Customer counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def total_customers(df: DataFrame) -> DataFrame:
    """One row with the exact number of distinct customer codes; NULL counts as one."""
    codes = df.select("customer_code").distinct()
    return codes.agg(F.count(F.lit(1)).alias("total_customers"))


def distribution(df: DataFrame, by: str) -> DataFrame:
    """Rows with a customer code per value of ``by``, NULL included as a value.

    The count is of rows, not of distinct customers: on claim rows a customer
    counts once per claim. Tasks count before the shuffle, so a value that
    holds most of the rows costs one partial count per map task.
    """
    return df.groupBy(by).agg(F.count("customer_code").alias("customer_count"))


def distributions(df: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """``dimension, value, customer_count``: ``distribution`` of several text columns in one scan.

    A grouping set for each column; ``dimension`` is the column's name, told by
    the grouping number, so NULL as a value is not taken for a column that is
    not grouped by. Tasks count before the shuffle; what is shuffled is
    bounded by the values, not by the rows.
    """
    counted = df.groupingSets([[name] for name in columns], *columns).agg(
        F.grouping_id().alias("number"), F.count("customer_code").alias("customer_count")
    )
    # A column that a row is grouped by has the bit 0, the others 1; the first has the highest.
    full = (1 << len(columns)) - 1
    dimension = value = F.lit(None).cast("string")
    for i, name in enumerate(columns):
        mine = F.col("number") == (full ^ (1 << (len(columns) - 1 - i)))
        dimension = F.when(mine, F.lit(name)).otherwise(dimension)
        value = F.when(mine, F.col(name)).otherwise(value)
    return counted.select(dimension.alias("dimension"), value.alias("value"), "customer_count")
