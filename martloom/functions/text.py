"""Text columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def part_of(col: Column, sep: str, n: int) -> Column:
    """n-th piece (1-based) of a separated text; empty text past the end."""
    return F.split_part(col, F.lit(sep), F.lit(n))


def clean(col: Column) -> Column:
    """Trimmed lower-case text."""
    return F.trim(F.lower(col))


def join_text(*cols: Column, sep: str = "") -> Column:
    """Concatenation that skips NULL pieces."""
    return F.concat_ws(sep, *cols)


def normalise(col: Column, mapping: dict[str, str], default: str) -> Column:
    """Synonyms of a lower-cased value mapped to one name, anything else to `default`."""
    low = F.lower(col)
    by_target: dict[str, list[str]] = {}
    for synonym, target in mapping.items():
        by_target.setdefault(target, []).append(synonym)
    result = None
    for target, synonyms in by_target.items():
        hit = low.isin(synonyms)
        result = F.when(hit, target) if result is None else result.when(hit, target)
    return F.lit(default) if result is None else result.otherwise(default)
