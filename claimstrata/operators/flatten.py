"""Nested wire documents to flat, typed columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimstrata.functions import wrapped_int, wrapped_ints


def _int(path: str) -> Column:
    return wrapped_int(path).alias(path.rsplit(".", 1)[-1])


def flatten(wire: DataFrame, *extra: str) -> DataFrame:
    """One flat row per document, with ``claims`` still an array and ``extra`` columns behind.

    A single projection: wrapped numbers become ints, texts stay texts and a
    NULL struct gives NULL for each of its leaves. The document id is dropped.
    """
    return wire.select(
        _int("customer_code"),
        _int("age"),
        "age_group",
        "city",
        "acquisition_channel",
        "policy_id",
        _int("base_coverage_amt"),
        _int("base_premium_amt"),
        wrapped_ints("claims").alias("claims"),
        "date",
        _int("day"),
        _int("month"),
        _int("year"),
        "day_type",
        "injection_date",
        _int("sale.sale_id"),
        F.col("sale.sale_date"),
        _int("sale.final_premium_amt"),
        F.col("sale.sales_mode"),
        _int("revenue.revenue_id"),
        F.col("revenue.revenue_date"),
        _int("revenue.revenue_amt"),
        F.col("pii_fields.pan_number"),
        F.col("pii_fields.aadhaar_number"),
        *extra,
    )
