"""The layers as compositions of operators. Nothing here starts a job."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame

from claimstrata.functions import sale_day
from claimstrata.operators import (
    attach_policy_metrics,
    drop_copies,
    explode_claims,
    fill_nulls,
    flatten,
    mask_fields,
    project_silver,
    stamp_etl_date,
    strip_column,
)

# The columns of bronze.
BRONZE_COLUMNS = (
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
    "injection_date",
    "sale_id",
    "sale_date",
    "final_premium_amt",
    "sales_mode",
    "revenue_id",
    "revenue_date",
    "revenue_amt",
    "claim_amount",
    "pan_number_encrypted",
    "aadhaar_number_encrypted",
)

# Gold puts the policy first and the three measures last.
GOLD_MEASURES = ("total_claims", "total_claim_amount", "avg_claim_amount")


def documents(wire: DataFrame, *extra: str) -> DataFrame:
    """Typed, masked documents, one row each, ``claims`` still an array, and ``extra`` columns.

    Masking comes before the explode, so a document is hashed once and not
    once per claim, and no stored layer holds a plain identity number.
    ``sale_day`` is the parsed sale date, kept so that a month can be read
    without parsing or reading the rest.
    """
    return mask_fields(flatten(wire, *extra)).withColumn("sale_day", sale_day())


def bronze(docs: DataFrame, *extra: str) -> DataFrame:
    """One row per claim. ``extra`` names columns to keep beside the 24 of bronze."""
    return explode_claims(docs).select(*BRONZE_COLUMNS, *extra)


def silver(
    rows: DataFrame,
    as_of: dt.date | None = None,
    distinct: Callable[[DataFrame], DataFrame] = drop_copies,
) -> DataFrame:
    """Bronze rows projected, filled, without copies, cleaned and stamped.

    ``distinct`` drops the copies: ``drop_copies`` in one pass that shuffles
    whole rows, ``drop_copies_by_fingerprint`` in several over stored rows
    that shuffles eight bytes of each.

    The stamp is the same on every row, so it is added after the copies are
    dropped and does not travel through that shuffle. ``age`` is cleaned
    after it as well, and becomes text.
    """
    kept = distinct(fill_nulls(project_silver(rows)))
    return stamp_etl_date(strip_column(kept, "age"), as_of)


def gold_claim_policy(docs: DataFrame, metrics: DataFrame, **split: int) -> DataFrame:
    """Bronze rows with their policy's metrics, from documents.

    The join runs on documents and the explode after it: the shuffle carries
    each document once with its array instead of once per claim.
    """
    rest = [name for name in BRONZE_COLUMNS if name != "policy_id"]
    joined = attach_policy_metrics(docs, metrics, **split)
    return explode_claims(joined).select("policy_id", *rest, *GOLD_MEASURES)
