"""Deterministic keys: a retry gives the same key, unlike random ids or sequences."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _plain(col: Column) -> Column:
    text = F.replace(col.cast("string"), F.lit("\\"), F.lit("\\\\"))
    return F.coalesce(F.replace(text, F.lit("|"), F.lit("\\|")), F.lit("\\N"))


def hash_key(*cols: Column) -> Column:
    """SHA-256 over the values joined by '|', with '|' inside values escaped."""
    return F.sha2(F.concat_ws("|", *[_plain(c) for c in cols]), 256)


def ordered_pair(a: Column, b: Column) -> tuple[Column, Column]:
    """The same two columns for (a, b) and (b, a)."""
    return F.least(a, b), F.greatest(a, b)
