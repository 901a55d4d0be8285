"""Scalar string rules, all JVM-side expressions (no Python UDF)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# A string is blank when it is empty or made only of whitespace
# in the Java sense (tab through carriage return, the four ASCII separators
# U+001C..U+001F) or of Unicode space separators (category Z: space, NBSP,
# U+2028, U+3000, ...). U+0085 and U+200B are not blank.
BLANK_PATTERN = r"\A[\t-\r \p{Z}\x1c-\x1f]*\z"

# Fixed value: the first single-quoted token of a reason text, non-greedy.
QUOTED_TOKEN_PATTERN = r"'(.+?)'"


def is_blank(c: Column) -> Column:
    """True when ``c`` is empty or whitespace only; null stays null."""
    return c.rlike(BLANK_PATTERN)


def quoted_token(c: Column) -> Column:
    """First single-quoted token of ``c``; ``''`` when there is none."""
    return F.regexp_extract(c, QUOTED_TOKEN_PATTERN, 1)
