"""20-byte and 32-byte address text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .amounts import col


def unpadded(c) -> Column:
    """Drop the 24 zero digits in front of a 32-byte address, if all are zero."""
    digits = F.substring(col(c), 3, 1 << 30)
    return F.lower(F.concat(F.lit("0x"), F.regexp_replace(digits, "^0{24}", "")))


def last_20_bytes(c) -> Column:
    """The last 40 hex digits, whatever stands before them."""
    return F.lower(F.concat(F.lit("0x"), F.right(col(c), F.lit(40))))


def padded(c) -> Column:
    """20-byte address to the 32-byte form."""
    return F.lower(F.concat(F.lit("0x"), F.lpad(F.substring(col(c), 3, 1 << 30), 64, "0")))


def is_zero(c) -> Column:
    return F.lower(col(c)).rlike("^0x0*$")
