"""One row per claim."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def explode_claims(df: DataFrame) -> DataFrame:
    """Replace the ``claims`` array by one row per element, as ``claim_amount``.

    Documents whose array is NULL or empty give no row; a NULL element gives
    a row with a NULL amount. Every other column repeats on each row, so sums
    of per-sale columns over the result count a sale once per claim.
    """
    repeated = [name for name in df.columns if name != "claims"]
    return df.select(*repeated, F.explode("claims").alias("claim_amount"))
