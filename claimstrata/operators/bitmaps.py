"""Exact distinct counts of int codes as bitmaps that can be merged.

The ints fall into buckets of 32,768 neighbours, and a bucket's bitmap has one
bit for each of them (4 KB). Bitmaps of different days or batches are united
bit by bit, so a total over many days needs their bitmaps and not their rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def code_bitmaps(df: DataFrame, code: str = "customer_code", by: tuple[str, ...] = ()) -> DataFrame:
    """``*by, bucket, codes``: a bitmap for each bucket of ints that has a row.

    NULL is a code of its own, in the bucket NULL. Tasks build the bitmaps of
    their rows before the shuffle, so what is shuffled is bounded by the
    buckets a task has seen (at most 131,073 for each value of ``by``), not by
    rows or codes. Codes far apart fill a bitmap each; Spark's compression
    of shuffles and files takes the empty bytes out.
    """
    bit = F.coalesce(F.bitmap_bit_position(code), F.lit(0).cast("long"))
    bucket = F.bitmap_bucket_number(code).alias("bucket")
    return df.groupBy(*by, bucket).agg(F.bitmap_construct_agg(bit).alias("codes"))


def merge_bitmaps(bitmaps: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """The union of bitmaps per value of ``by``; other columns are summed up over."""
    return bitmaps.groupBy(*by, "bucket").agg(F.bitmap_or_agg("codes").alias("codes"))


def count_codes(bitmaps: DataFrame, name: str = "total_customers", by: tuple[str, ...] = ()) -> DataFrame:
    """The number of different codes per value of ``by``, from bitmaps merged by it.

    Without ``by`` the result is one row, 0 for no bitmaps.
    """
    bits = F.coalesce(F.sum(F.bitmap_count("codes")), F.lit(0).cast("long")).alias(name)
    return bitmaps.groupBy(*by).agg(bits) if by else bitmaps.agg(bits)
