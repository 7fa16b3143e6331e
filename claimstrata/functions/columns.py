"""Column expressions: decoding, dates, text cleaning and hashing."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the data contract.
INT_WRAPPER = "$numberInt"
STAMP_FORMAT = "dd-MM-yyyy"
SPECIAL_CHARACTERS = "[^a-zA-Z0-9 ]"
DIGEST_BITS = 256

_EXPONENT = "eE"
# Ten digits before the point hold every int; what is cut off may have 28.
_DECIMAL = "decimal(38,28)"


def _int(text: Column) -> Column:
    """Only text that is no plain int takes the way over decimals."""
    cut = F.translate(text, _EXPONENT, "xx").try_cast(_DECIMAL).try_cast("int")
    return F.coalesce(text.try_cast("int"), cut)


def wrapped_int(path: str) -> Column:
    """The int inside a typed wrapper such as ``{"$numberInt": "31"}``.

    A fraction is cut off, as by a plain cast without ANSI mode. Text that is
    no number, has an exponent or does not fit an int gives NULL in both modes.
    """
    return _int(F.col(f"{path}.{INT_WRAPPER}"))


def wrapped_ints(path: str) -> Column:
    """An array of typed wrappers as ``array<int>``, each element as in ``wrapped_int``.

    A bad element becomes NULL and the others stay. A NULL array stays NULL and
    an empty one stays empty.
    """
    return F.transform(f"{path}.{INT_WRAPPER}", _int)


def sale_day(column: str = "sale_date") -> Column:
    """The sale date text as a date; text that is no date gives NULL."""
    return F.col(column).try_cast("date")


def day_stamp(as_of: dt.date | None = None) -> Column:
    """The given day, or the current one, as ``dd-MM-yyyy`` text."""
    day = F.current_date() if as_of is None else F.lit(as_of)
    return F.date_format(day, STAMP_FORMAT)


def strip_special(column: str) -> Column:
    """The column as text, every character but letters, digits and blanks replaced by a blank."""
    return F.regexp_replace(F.col(column).cast("string"), SPECIAL_CHARACTERS, " ")


def digest(column: str) -> Column:
    """SHA-256 of the column's text in lower-case hex; NULL stays NULL.

    The hash is unsalted, so this is pseudonymisation: an identity number
    with few possible values can be found again by trying them all.
    """
    return F.sha2(F.col(column).cast("string"), DIGEST_BITS)
