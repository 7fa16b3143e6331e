"""Shorter rows for a shuffle, and the same rows again after it.

A shuffle packs rows by what they repeat. The digits of a digest repeat
nothing, and every number has a slot of eight bytes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType

from claimstrata.functions.columns import DIGEST_BITS
from claimstrata.operators.masking import IDENTITY_FIELDS

_DIGESTS = tuple(f"{name}_encrypted" for name in IDENTITY_FIELDS)
_BYTES = DIGEST_BITS // 8
# Fewer numbers than this have no use of an array.
_LEAST_NUMBERS = 3


def _packed(text: Column) -> Column:
    """Half as many bytes for a digest in lower-case hex, other texts as they are; no two texts share a result.

    Only a digest has ``_BYTES`` bytes: a byte is put behind other texts that are as long or longer.
    """
    raw, plain = F.unhex(text), text.cast("binary")
    digest = (F.length(text) == 2 * _BYTES) & (F.lower(F.hex(raw)) == text)
    return F.when(digest, raw).when(F.length(plain) < _BYTES, plain).otherwise(F.concat(plain, F.lit(b"\0")))


def _unpacked(value: Column) -> Column:
    size = F.length(value)
    plain = F.when(size < _BYTES, value).otherwise(value.substr(F.lit(1), size - 1))
    return F.when(size == _BYTES, F.lower(F.hex(value))).otherwise(plain.cast("string"))


def _digests(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if f.name in _DIGESTS and f.dataType == StringType()]


def short_digests(df: DataFrame) -> DataFrame:
    """The digests of identity fields as bytes, in place."""
    return df.withColumns({name: _packed(F.col(name)) for name in _digests(df)})


def long_digests(rows: DataFrame, df: DataFrame) -> DataFrame:
    """Rows made from ``short_digests(df)``, with digests as text again and any other text as it was."""
    return rows.withColumns({name: _unpacked(F.col(name)) for name in _digests(df)})


def _numbers(df: DataFrame) -> list[str]:
    names = [f.name for f in df.schema if f.dataType == IntegerType()]
    return names if len(names) >= _LEAST_NUMBERS else []


def narrowed(df: DataFrame) -> DataFrame:
    """The rows with short digests, and with their ints in one array; rows are equal where they were before."""
    numbers, array = _numbers(df), "numbers"
    while array in df.columns:
        array += "_"
    rest = [F.col(f"`{name}`") for name in df.columns if name not in numbers]
    held = [F.array(*(F.col(f"`{name}`") for name in numbers)).alias(array)] if numbers else []
    return short_digests(df.select(*rest, *held))


def widened(narrow: DataFrame, df: DataFrame) -> DataFrame:
    """Rows of ``narrowed(df)`` with the columns of ``df``."""
    numbers, rows = _numbers(df), long_digests(narrow, df)
    array = F.col(f"`{rows.columns[-1]}`")
    held = {name: array[i].alias(name) for i, name in enumerate(numbers)}
    return rows.select(*(held.get(name, F.col(f"`{name}`")) for name in df.columns))
