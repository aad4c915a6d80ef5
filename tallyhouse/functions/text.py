"""String clean-up shared by tokens, masks and fingerprints."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters Unicode counts as white space (Spark's trim removes only blanks).
WHITE_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# Fixed value: a well-formed address. A closing line feed is tolerated.
EMAIL_SHAPE = r"^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}\n?\z"


def strip(value: Column) -> Column:
    return F.btrim(value, F.lit(WHITE_SPACE))


def folded(value: Column) -> Column:
    """Lower case without surrounding white space."""
    return strip(F.lower(value))


def digits_only(value: Column) -> Column:
    """Keep decimal digits of any script."""
    return F.regexp_replace(value, r"\P{Nd}", "")


def is_email(value: Column) -> Column:
    return value.rlike(EMAIL_SHAPE)


def shorten(value: Column, limit: int = 100, suffix: str = "...") -> Column:
    """Cut to ``limit`` characters, the suffix included."""
    head = F.substring(value, 1, max(limit - len(suffix), 0))
    return F.when(F.char_length(value) <= limit, value).otherwise(F.concat(head, F.lit(suffix)))


def has_text(value: Column) -> Column:
    """True for a non-NULL, non-empty string."""
    return value.isNotNull() & (value != "")
