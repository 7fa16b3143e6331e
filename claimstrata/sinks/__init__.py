from claimstrata.sinks.database import DatabaseTarget, write_table
from claimstrata.sinks.figures import Figures, write_counted
from claimstrata.sinks.files import read_csv, write_csv, write_layer
from claimstrata.sinks.lineage import checkpointed, new_folder, persisted, shared_folder
from claimstrata.sinks.months import MONTH_COLUMN, month_key, read_months, replace_month, write_months
from claimstrata.sinks.storage import Store
from claimstrata.sinks.versions import (
    current_version,
    damaged_files,
    read_manifest,
    read_version,
    write_version,
)

__all__ = [
    "MONTH_COLUMN",
    "DatabaseTarget",
    "Figures",
    "Store",
    "checkpointed",
    "current_version",
    "damaged_files",
    "month_key",
    "new_folder",
    "persisted",
    "read_csv",
    "read_manifest",
    "read_months",
    "read_version",
    "replace_month",
    "shared_folder",
    "write_counted",
    "write_csv",
    "write_layer",
    "write_months",
    "write_table",
    "write_version",
]
