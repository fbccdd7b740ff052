"""Row filters."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def require(df: DataFrame, *cols: str) -> DataFrame:
    """Rows where every given column is present."""
    return df.dropna(subset=list(cols))


def changed_since(df: DataFrame, cols: Sequence[str], watermark) -> DataFrame:
    """Rows touched after the watermark in any of the load-time columns.  The
    watermark is a plain value, so each comparison can reach the scan."""
    if watermark is None:
        return df
    at = F.lit(watermark).cast("timestamp_ntz")
    return df.filter(reduce(Column.__or__, [F.col(c) > at for c in cols]))


def valid_orders(df: DataFrame, user: str = "h_user_pk", items: str = "products",
                 status: str = "status", closed: str = "CLOSED") -> DataFrame:
    """Messages worth counting: with a user and at least one item, and closed.  A
    missing status passes; only another status is dropped."""
    return df.filter(
        (F.col(status).isNull() | (F.col(status) == "") | (F.col(status) == closed))
        & F.col(user).isNotNull()
        & (F.col(user).cast("string") != "")
        & (F.coalesce(F.size(items), F.lit(0)) > 0)
    )


def preview(df: DataFrame, order: Sequence[str], n: int = 10) -> DataFrame:
    """First n rows in a fixed order, for people to look at."""
    return df.orderBy(*order).limit(n)
