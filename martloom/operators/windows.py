"""Window operators.  Every order ends in a unique column, so results repeat."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import checkpointed, shuffle_partitions
from .ranges import previous_value


def top_n(df: DataFrame, by: Sequence[str], order: Sequence, n: int = 1) -> DataFrame:
    """First n rows per group.  Spark limits each group before the shuffle too, so
    at most n rows of a hot group leave every task."""
    w = Window.partitionBy(*by).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= n).drop("_rn")


def rank_top(df: DataFrame, by: Sequence[str], order: Sequence, n: int = 1) -> DataFrame:
    """Rows of rank n or better; ties stay."""
    w = Window.partitionBy(*by).orderBy(*order)
    return df.withColumn("_rk", F.rank().over(w)).filter(F.col("_rk") <= n).drop("_rk")


def latest(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Last row per key."""
    return top_n(df, keys, [F.col(c).desc() for c in order], 1)


def best_overall(df: DataFrame, measure: str) -> DataFrame:
    """All rows with the largest measure: DENSE_RANK = 1 over everything, without
    sorting everything in one task.  Feed it an aggregate."""
    top = df.agg(F.max(measure)).scalar()
    return df.filter(F.col(measure) == top)


def flag_first(df: DataFrame, key: str, row_id: str, order: Sequence[str], output: str = "is_first") -> DataFrame:
    """1 on the first row of each key, else 0.  The first row is found by a partial
    aggregate and joined back on the unique row id, so a hot key is never gathered."""
    first = df.groupBy(key).agg(F.min_by(row_id, F.struct(*order)).alias(row_id)).select(
        row_id, F.lit(1).alias(output)
    )
    return df.join(first, row_id, "left").withColumn(output, F.coalesce(F.col(output), F.lit(0)))


def flag_change(df: DataFrame, keys: Sequence[str], order: Sequence[str], col: str,
                output: str = "is_change") -> DataFrame:
    """1 where the value differs from the row before, else 0."""
    marked = previous_value(df, keys, order, col, "_previous")
    return marked.withColumn(
        output, F.when(F.col("_previous").isNotNull() & (F.col(col) != F.col("_previous")), 1).otherwise(0)
    ).drop("_previous")


def pct_change(col: Column, previous: Column, digits: int = 2) -> Column:
    """Change against the previous value in percent; NULL without one or at zero."""
    return F.round(F.try_divide(col - previous, previous) * 100, digits)


def with_previous(df: DataFrame, keys: Sequence[str], order: Sequence[str], col: str, output: str) -> DataFrame:
    """LAG over an aggregate, where a key has few rows (years, months)."""
    return df.withColumn(output, F.lag(col).over(Window.partitionBy(*keys).orderBy(*order)))


def islands(df: DataFrame, keys: Sequence[str], date: str) -> DataFrame:
    """Runs of consecutive days per key: days, start_date, end_date.

    Days are made distinct first, so a key brings at most one row per calendar day.
    """
    days = df.select(*keys, F.to_date(date).alias("_day")).distinct()
    rn = F.row_number().over(Window.partitionBy(*keys).orderBy("_day"))
    return (
        days.withColumn("_run", F.date_sub("_day", rn))
        .groupBy(*keys, "_run")
        .agg(
            F.count(F.lit(1)).alias("days"),
            F.min("_day").alias("start_date"),
            F.max("_day").alias("end_date"),
        )
        .drop("_run")
    )


def home_state(df: DataFrame, key: str, state: str, date: str, min_days: int = 27) -> DataFrame:
    """State of the most recent run of at least min_days days; ties by longer run,
    then by name."""
    runs = islands(df, [key, state], date).filter(F.col("days") >= min_days)
    return top_n(runs, [key], [F.col("end_date").desc(), F.col("days").desc(), F.col(state)], 1)


def number_rows(df: DataFrame, order: Sequence[str], start: int = 1, output: str = "number",
                partitions: int | None = None) -> DataFrame:
    """Consecutive numbers over the whole table in the given order.

    Rows are range-partitioned and the layout is fixed by a checkpoint; each
    partition numbers its own rows and adds the count of the partitions before.
    """
    n = partitions or shuffle_partitions(df.sparkSession)
    spread = checkpointed(df.repartitionByRange(n, *order).withColumn("_part", F.spark_partition_id()))
    sizes = spread.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    # One row per partition: the only window without a partition key.
    before = F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = sizes.select("_part", F.coalesce(before, F.lit(0)).alias("_before"))
    rn = F.row_number().over(Window.partitionBy("_part").orderBy(*order))
    return (
        spread.join(F.broadcast(offsets), "_part")
        .withColumn(output, (F.col("_before") + rn + (start - 1)).cast("bigint"))
        .drop("_part", "_before")
    )


def top_k(df: DataFrame, order: Sequence, k: int) -> DataFrame:
    """First k rows overall; each task keeps k rows only."""
    return df.orderBy(*order).limit(k)
