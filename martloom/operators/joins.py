"""Join shapes beyond a plain `df.join`."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .windows import top_n


def lookup_keys(src: DataFrame, dim: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Attach a dimension through its natural key."""
    return src.join(dim, list(keys), how)


def anti_join(df: DataFrame, seen: DataFrame, keys: Sequence[str], null_aware: bool = False) -> DataFrame:
    """Rows of df whose key is not in `seen`.

    With null_aware the SQL rule of NOT IN holds on a single key: one NULL among
    the seen keys empties the result, and rows with a NULL key never pass.
    """
    keys = list(keys)
    seen = seen.select(*keys).distinct()
    if not null_aware:
        return df.join(seen, keys, "left_anti")
    if len(keys) != 1:
        raise ValueError("null_aware needs exactly one key")
    key = keys[0]
    state = seen.agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col(key).isNull()).alias("nulls"),
    ).select(F.struct("n", "nulls")).scalar()
    # The two counts are a scalar subquery: NOT IN over an empty list keeps all rows.
    return df.join(seen, keys, "left_anti").filter(
        (state["nulls"] == 0) & (F.col(key).isNotNull() | (state["n"] == 0))
    )


def semi_top_k(df: DataFrame, dim: DataFrame, key: str, order: Sequence, k: int) -> DataFrame:
    """Rows of df whose key is among the first k keys of `dim`; k rows are broadcast."""
    first = dim.orderBy(*order).limit(k).select(key)
    return df.join(F.broadcast(first), key, "left_semi")


def join_on_day(a: DataFrame, b: DataFrame, key: str, ts_a: str, ts_b: str, how: str = "inner") -> DataFrame:
    """Equi-join on a key and the calendar day of two timestamps."""
    return a.withColumn("_day", F.to_date(ts_a)).join(
        b.withColumn("_day", F.to_date(ts_b)).drop(ts_b), [key, "_day"], how
    ).drop("_day")


def sum_then_join(base: DataFrame, detail: DataFrame, key: str, value: str, output: str) -> DataFrame:
    """Total of the detail rows per key, then attached; keys without detail get 0."""
    totals = detail.groupBy(key).agg(F.sum(value).alias(output))
    return base.join(totals, key, "left").withColumn(
        output, F.coalesce(F.col(output), F.lit(0).cast(totals.schema[output].dataType))
    )


def latest_name(hub: DataFrame, sat: DataFrame, key: str, name: str, load_dt: str,
                default: str = "unknown") -> DataFrame:
    """Hub rows with the name of the newest satellite version, or a default."""
    newest = sat.groupBy(key).agg(F.max_by(name, F.struct(load_dt, name)).alias(name))
    return hub.join(newest, key, "left").withColumn(name, F.coalesce(F.col(name), F.lit(default)))


def any_linked(hub: DataFrame, link: DataFrame, key: str, linked: str) -> DataFrame:
    """One linked key per hub row; the smallest, so that reruns agree."""
    return hub.join(link.groupBy(key).agg(F.min(linked).alias(linked)), key)


def affected(fact: DataFrame, delta_keys: DataFrame, keys: Sequence[str]) -> DataFrame:
    """All fact rows of the changed keys, each once however often the key changed."""
    keys = list(keys)
    return fact.join(delta_keys.select(*keys).distinct(), keys, "left_semi")


def first_match(df: DataFrame, detail: DataFrame, key: str, order: Sequence, cols: Sequence[str]) -> DataFrame:
    """df with the first detail row per key, or NULLs."""
    return df.join(top_n(detail, [key], order, 1).select(key, *cols), key, "left")
