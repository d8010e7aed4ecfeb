"""Column helpers shared by all operators: key cleaning and falsy fallback."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def strip(c: Column) -> Column:
    """Drop surrounding white space of any kind (trim() drops blanks only)."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def clean_key(c: Column | str) -> Column:
    """Stripped, lower-cased key text; blank becomes null."""
    c = F.col(c) if isinstance(c, str) else c
    return F.nullif(F.lower(strip(c)), F.lit(""))


def is_blank(c: Column) -> Column:
    """True for null, empty and white-space-only text."""
    return F.coalesce(strip(c) == "", F.lit(True))


def first_filled(*cols: Column) -> Column:
    """First value that is neither null nor the empty string."""
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in cols])
