"""Hashing of identity fields."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame

from claimstrata.functions import digest

# The identity fields of a document.
IDENTITY_FIELDS = ("pan_number", "aadhaar_number")


def mask_fields(df: DataFrame, fields: Iterable[str] = IDENTITY_FIELDS) -> DataFrame:
    """Swap each field ``f`` for its hash ``f_encrypted``, added at the end."""
    names = list(fields)
    hashed = {f"{name}_encrypted": digest(name) for name in names}
    return df.withColumns(hashed).drop(*names)
