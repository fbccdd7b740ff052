"""Keyed table changes as pure functions (target, source) -> new target.

Publishing the result is the sink's business (`sinks.tables`)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .aggregates import dedup_first


def unique_on(df: DataFrame, keys: Sequence[str], what: str = "source") -> DataFrame:
    """The same rows; the job fails if a key occurs twice."""
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys]
    grouped = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_n"), F.first(F.struct(*rest) if rest else F.lit(1)).alias("_row")
    )
    complaint = F.raise_error(F.concat(F.lit(f"{what} has a repeated key: "), F.to_json(F.struct(*keys))))
    checked = grouped.filter(F.when(F.col("_n") > 1, complaint.cast("boolean")).otherwise(F.lit(True)))
    return checked.select(*keys, *[F.col("_row")[c].alias(c) for c in rest]).select(*df.columns)


def keyed_merge(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    update_cols: Sequence[str] | None = None,
    check: bool = True,
) -> DataFrame:
    """MERGE: matched rows take `update_cols` from the source (all by default), the
    rest of the source is inserted, other target rows stay.  One full outer join.
    A NULL coming from the source is a value like any other."""
    keys = list(keys)
    values = [c for c in target.columns if c not in keys]
    updated = values if update_cols is None else list(update_cols)
    source = source.select(*target.columns)
    if check:
        source = unique_on(source, keys)
    t = target.select(*keys, F.struct(F.lit(1).alias("_here"), *values).alias("_t"))
    s = source.select(*keys, F.struct(F.lit(1).alias("_here"), *values).alias("_s"))
    joined = t.join(s, keys, "full_outer")
    fresh, known = F.col("_s").isNotNull(), F.col("_t").isNotNull()

    def pick(c: str) -> Column:
        take = fresh if c in updated else fresh & ~known
        return F.when(take, F.col("_s")[c]).otherwise(F.col("_t")[c]).alias(c)

    return joined.select(*[F.col(c) if c in keys else pick(c) for c in target.columns])


def insert_ignore(target: DataFrame, source: DataFrame, keys: Sequence[str], order: Sequence | None = None,
                  unique: bool = False) -> DataFrame:
    """Target plus the source rows whose key is new; one row per key, the first in
    `order`."""
    return target.unionByName(new_rows(target, source, keys, order, unique).select(*target.columns))


def new_rows(target: DataFrame, source: DataFrame, keys: Sequence[str], order: Sequence | None = None,
             unique: bool = False) -> DataFrame:
    """Source rows whose key the target lacks, one per key.  `unique` says that the
    source has one row per key by construction (a grouped or distinct frame)."""
    keys = list(keys)
    if unique:
        return source.join(target.select(*keys), keys, "left_anti")
    rest = [c for c in source.columns if c not in keys]
    # De-duplicate first: repeats go before the shuffle, and the anti join then
    # finds the rows already partitioned by the key.
    return dedup_first(source, keys, list(order) if order else (rest or keys)).join(
        target.select(*keys), keys, "left_anti"
    )


def update_from(target: DataFrame, source: DataFrame, keys: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """UPDATE ... FROM: matched rows take the columns from the source; nothing is inserted."""
    keys = list(keys)
    s = unique_on(source.select(*keys, *cols), keys).select(*keys, F.struct(*cols).alias("_s"))
    joined = target.join(s, keys, "left")
    return joined.select(*[
        F.when(F.col("_s").isNotNull(), F.col("_s")[c]).otherwise(F.col(c)).alias(c) if c in cols else F.col(c)
        for c in target.columns
    ])


def update_where(df: DataFrame, pred: Column, changes: Mapping[str, Column]) -> DataFrame:
    """UPDATE ... SET ... WHERE on columns of the same row."""
    return df.withColumns({c: F.when(pred, e).otherwise(F.col(c)) for c, e in changes.items()})


def require_known(df: DataFrame, known: DataFrame, key: str, what: str = "key") -> DataFrame:
    """The same rows, after a check that `known` has every key.

    The check is an action, so it comes before any write and cannot be optimised
    away; one missing key reaches the driver for the message.
    """
    missing = df.select(key).join(known.select(key), key, "left_anti").take(1)
    if missing:
        raise ValueError(f"{what} not found: {missing[0][0]}")
    return df


def delete_by_key(df: DataFrame, gone: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.join(gone.select(*keys).distinct(), list(keys), "left_anti")


def rename_key(df: DataFrame, mapping: DataFrame, key: str, new_key: str) -> DataFrame:
    """Replace key values through a (key, new_key) table; use it on every table that
    carries the key."""
    renames = unique_on(mapping.select(key, new_key), [key], "mapping")
    return (
        df.join(renames, key, "left")
        .withColumn(key, F.coalesce(F.col(new_key), F.col(key)))
        .select(*df.columns)
    )


def replace_rows(target: DataFrame, slice_rows: DataFrame, pred: Column) -> DataFrame:
    """DELETE WHERE pred, then INSERT the new rows of that slice."""
    keep = target.filter(~F.coalesce(pred, F.lit(False)))
    return keep.unionByName(slice_rows.filter(pred).select(*target.columns))
