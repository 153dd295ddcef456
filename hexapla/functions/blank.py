"""What counts as blank, column by column, when records are merged."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The spellings of a missing value in each kind of column, besides null.
BLANKS: dict[str, tuple[str, ...]] = {
    "name": ("", "Unknown"),
    "text": ("",),
    "json_object": ("", "{}"),
    "json_array": ("", "[]"),
    "download_status": ("", "pending"),
    "integrity_status": ("", "unchecked"),
}


def is_blank(c: Column, kind: str = "text") -> Column:
    """Whether a value is null or one of its kind's spellings of a missing value."""
    return c.isNull() | c.isin(*BLANKS[kind])


def keep_nonblank(new: Column, old: Column, kind: str = "text") -> Column:
    """The new value, or the old one where the new one is blank."""
    return F.when(is_blank(new, kind), old).otherwise(new)
