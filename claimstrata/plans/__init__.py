from claimstrata.plans.batches import (
    merged_metrics,
    partial_metrics,
    read_batches,
    refreshed_metrics,
    store_batch,
)
from claimstrata.plans.intake import store_checked
from claimstrata.plans.layers import BRONZE_COLUMNS, bronze, documents, gold_claim_policy, silver
from claimstrata.plans.policy_layout import PolicyLayout, write_policy_layout
from claimstrata.plans.publish import Layers, export_csv, export_csv_version, export_database, publish

__all__ = [
    "BRONZE_COLUMNS",
    "Layers",
    "PolicyLayout",
    "bronze",
    "documents",
    "export_csv",
    "export_csv_version",
    "export_database",
    "gold_claim_policy",
    "merged_metrics",
    "partial_metrics",
    "publish",
    "read_batches",
    "refreshed_metrics",
    "silver",
    "store_batch",
    "store_checked",
    "write_policy_layout",
]
