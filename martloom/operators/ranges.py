"""Running values over a table in a total order, without a task that holds a whole key.

Rows are dealt to range partitions of the order and that layout is fixed by a checkpoint
(another sample of the same rows could cut the ranges elsewhere).  Windows run inside a
partition; what a partition needs from the ones before it is one row for each partition,
so those edges are small whatever a single key holds.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import checkpointed

PART = "_part"


def in_ranges(df: DataFrame, order: Sequence[str | Column]) -> DataFrame:
    """The rows in range partitions of the order, with their partition's number `_part`.
    The order should end in a unique column, or equal rows stay together."""
    return checkpointed(df.repartitionByRange(*order).withColumn(PART, F.spark_partition_id()))


def _edges(parts: DataFrame, aggregates: Sequence[Column], carried: Mapping[str, Column]) -> DataFrame:
    """Aggregates of each partition, carried over the partitions before it: a row for each."""
    # One row per partition: the only window without a partition key.
    return parts.groupBy(PART).agg(*aggregates).select(PART, *[c.alias(k) for k, c in carried.items()])


def before_part() -> Window:
    """The partitions before one, for windows over edges."""
    return Window.orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)


def last_seen(parts: DataFrame, order: Sequence[str], values: Mapping[str, Column]) -> DataFrame:
    """For each output the last value that is not null, at the row or before it in the
    whole order.  `parts` comes from `in_ranges` with that order."""
    inside = Window.partitionBy(PART).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    place = F.struct(*order)
    edges = _edges(
        parts,
        [F.max_by(v, F.when(v.isNotNull(), place)).alias(k) for k, v in values.items()],
        {f"_{k}": F.last(k, ignorenulls=True).over(before_part()) for k in values})
    rows = parts.select("*", *[F.last(v, ignorenulls=True).over(inside).alias(k) for k, v in values.items()])
    return rows.join(F.broadcast(edges), PART).withColumns(
        {k: F.coalesce(k, f"_{k}") for k in values}).drop(*[f"_{k}" for k in values])


def running(parts: DataFrame, key: Sequence[str], order: Sequence[str], sums: Mapping[str, Column]) -> DataFrame:
    """For each output the sum over the rows of the same key up to the row.

    `order` begins with the key; `parts` comes from `in_ranges` with that order.  Only
    the first key of a partition can have rows before it, and those stand at the ends of
    the partitions before.  Null keys are a key.
    """
    key, order = list(key), list(order)
    inside = Window.partitionBy(PART, *key).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    rows = parts.select("*", *[F.sum(v).over(inside).alias(k) for k, v in sums.items()])
    ends = rows.groupBy(PART).agg(
        F.min(F.struct(*key)).alias("_first"),
        F.max_by(F.struct(F.struct(*key).alias("_key"), *sums), F.struct(*order)).alias("_end"))
    # The sums at a partition's end go to later partitions that begin with the same key.
    given = ends.select(F.col("_end._key").alias("_key"), PART, F.lit(1).alias("_kind"), *[f"_end.{k}" for k in sums])
    asked = ends.select(F.col("_first").alias("_key"), PART, F.lit(0).alias("_kind"))
    earlier = Window.partitionBy("_key").orderBy(PART, "_kind").rowsBetween(Window.unboundedPreceding, -1)
    carry = given.unionByName(asked, allowMissingColumns=True).select(
        PART, "_key", "_kind", *[F.sum(k).over(earlier).alias(f"_{k}") for k in sums]).filter("_kind = 0").drop("_kind")
    at = F.struct(*key).eqNullSafe(F.col("_key"))
    return rows.join(F.broadcast(carry), PART).withColumns(
        {k: F.col(k) + F.when(at, F.coalesce(f"_{k}", F.lit(0))).otherwise(0) for k in sums}).drop(
        "_key", *[f"_{k}" for k in sums])


def previous_value(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str,
                   output: str = "previous") -> DataFrame:
    """Value of the row before, per key, in the given total order (LAG).

    A plain LAG puts every row of a key in one task.  Here a key may reach over as many
    partitions as its rows need, wherever they lie in the order, and a partition's first
    row takes the last one of the partition before it.  Null keys are a key.
    """
    keys, whole = list(keys), [*keys, *order]
    parts = in_ranges(df, whole)
    inside = Window.partitionBy(PART, *keys).orderBy(*order)
    rows = parts.withColumns({"_rn": F.row_number().over(inside), "_lag": F.lag(value).over(inside)})
    last = F.max_by(F.struct(F.struct(*keys).alias("key"), F.col(value).alias("value")), F.struct(*whole)).alias("_last")
    edges = parts.groupBy(PART).agg(last).select(PART, F.lag("_last").over(Window.orderBy(PART)).alias("_edge"))
    carried = F.when(F.col("_edge.key").eqNullSafe(F.struct(*keys)), F.col("_edge.value"))
    return rows.join(F.broadcast(edges), PART).withColumn(
        output, F.when(F.col("_rn") == 1, carried).otherwise(F.col("_lag"))).drop(PART, "_rn", "_lag", "_edge")


def count_changes(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, output: str = "changes") -> DataFrame:
    """How often the value differs from the row before, per key."""
    narrow = df.select(*dict.fromkeys([*keys, *order, value]))
    marked = previous_value(narrow, keys, order, value, "_previous")
    moved = F.when(F.col("_previous") != F.col(value), 1).otherwise(0)
    return marked.groupBy(*keys).agg(F.sum(moved).cast("bigint").alias(output))
