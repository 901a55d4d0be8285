"""Typed key parsing (V2)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: a key is optional spaces, an optional sign, decimal digits,
# optional spaces, and must fit in a signed 64-bit integer.
KEY_PATTERN = r"^ *[+-]?[0-9]+ *$"


def parse_key(raw: Column) -> Column:
    """``raw`` as BIGINT, or null when it is null, malformed or overflows.

    ``try_cast`` never raises under ANSI mode; the pattern rejects forms a
    bare cast would accept in other engines (``5.0``).
    """
    return F.when(raw.rlike(KEY_PATTERN), F.trim(raw).try_cast("bigint"))
