"""``DataFrame -> DataFrame`` operators, meant for ``df.transform``."""

from claimstrata.operators.bitmaps import code_bitmaps, count_codes, merge_bitmaps
from claimstrata.operators.claims import explode_claims
from claimstrata.operators.cleaning import (
    SILVER_COLUMNS,
    drop_copies,
    fill_nulls,
    project_silver,
    stamp_etl_date,
    strip_column,
)
from claimstrata.operators.customers import distribution, distributions, total_customers
from claimstrata.operators.distinct import drop_copies_by_fingerprint
from claimstrata.operators.flatten import flatten
from claimstrata.operators.masking import IDENTITY_FIELDS, mask_fields
from claimstrata.operators.policies import attach_policy_metrics, policy_metrics
from claimstrata.operators.revenue import monthly_revenue, monthly_slice

__all__ = [
    "IDENTITY_FIELDS",
    "SILVER_COLUMNS",
    "attach_policy_metrics",
    "code_bitmaps",
    "count_codes",
    "distribution",
    "distributions",
    "drop_copies",
    "drop_copies_by_fingerprint",
    "explode_claims",
    "fill_nulls",
    "flatten",
    "mask_fields",
    "merge_bitmaps",
    "monthly_revenue",
    "monthly_slice",
    "policy_metrics",
    "project_silver",
    "stamp_etl_date",
    "strip_column",
    "total_customers",
]
