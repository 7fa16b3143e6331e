"""Column expressions shared by the operators. All of them run inside the JVM."""

from claimstrata.functions.columns import (
    day_stamp,
    digest,
    sale_day,
    strip_special,
    wrapped_int,
    wrapped_ints,
)

__all__ = ["day_stamp", "digest", "sale_day", "strip_special", "wrapped_int", "wrapped_ints"]
