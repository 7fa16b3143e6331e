"""Bronze to silver, step by step."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame

from claimstrata.functions import day_stamp, strip_special
from claimstrata.operators.narrow import narrowed, widened

# The columns silver takes from bronze.
SILVER_COLUMNS = (
    "sale_id",
    "sale_date",
    "final_premium_amt",
    "sales_mode",
    "revenue_id",
    "revenue_date",
    "revenue_amt",
    "customer_code",
    "age",
    "age_group",
    "city",
    "acquisition_channel",
    "policy_id",
    "base_coverage_amt",
    "base_premium_amt",
    "date",
    "day",
    "month",
    "year",
    "day_type",
    "claim_amount",
    "pan_number_encrypted",
    "aadhaar_number_encrypted",
)


def project_silver(bronze: DataFrame) -> DataFrame:
    return bronze.select(*SILVER_COLUMNS)


def stamp_etl_date(df: DataFrame, as_of: dt.date | None = None) -> DataFrame:
    """Add the load day as ``etl_date`` text; the session's current day by default."""
    return df.withColumn("etl_date", day_stamp(as_of))


def fill_nulls(df: DataFrame) -> DataFrame:
    """NULL numbers become 0 and NULL texts become empty; other types stay."""
    return df.na.fill(0).na.fill("")


def drop_copies(df: DataFrame) -> DataFrame:
    """Keep one of each set of equal rows.

    Tasks drop the copies they see before the shuffle, so a row repeated any
    number of times reaches its reducer at most once per map task. Whole rows
    are moved and compared, with digests as bytes and ints side by side.
    """
    if len(set(df.columns)) < len(df.columns):
        return df.dropDuplicates()
    return widened(narrowed(df).dropDuplicates(), df)


def strip_column(df: DataFrame, column: str) -> DataFrame:
    """Replace the column by its text without special characters, in place."""
    return df.withColumn(column, strip_special(column))
