"""Aggregations.  All of them combine on the map side before rows are shuffled."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import checkpointed
from .ranges import PART, in_ranges, running
from .windows import top_n


def by_period(df: DataFrame, ts: str, fmt: str = "yyyy-MM", output: str = "period") -> DataFrame:
    return df.withColumn(output, F.date_format(ts, fmt))


def null_pct(df: DataFrame, col: str, output: str = "null_percentage") -> DataFrame:
    """Share of NULLs in percent, with the fraction kept."""
    share = F.lit(100).cast("decimal(5,0)") * F.count_if(F.col(col).isNull()).cast("decimal(13,0)")
    return df.agg(F.round(F.try_divide(share, F.count(F.lit(1)).cast("decimal(13,0)")), 2).alias(output))


def sum_if(pred: Column, value: Column, zero: Column | None = None) -> Column:
    return F.sum(F.when(pred, value).otherwise(F.lit(0) if zero is None else zero))


def count_if(pred: Column) -> Column:
    return F.count_if(pred)


def count_distinct_if(pred: Column, col: Column) -> Column:
    return F.count_distinct(F.when(pred, col))


def median_by(df: DataFrame, keys: Sequence[str], value: str, output: str = "median") -> DataFrame:
    """Exact continuous median per key, NULLs ignored."""
    counted = df.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_n"))
    return median_of_counts(counted, keys, value, "_n", output)


def median_of_counts(counted: DataFrame, keys: Sequence[str], value: str, weight: str, output: str,
                     *others: Column) -> DataFrame:
    """Median of values given as (value, weight) rows, with other aggregates beside it.

    Equal values are already folded, so a window holds one row per distinct value of
    a group (whole days: a few thousand) and the sort is over those rows only.
    """
    whole = Window.partitionBy(*keys)
    present = F.when(F.col(value).isNotNull(), F.col(weight))
    marked = counted.withColumns({
        "_upto": F.sum(present).over(whole.orderBy(value)),
        "_all": F.sum(present).over(whole),
    })
    low = F.min(F.when(F.col("_upto") * 2 >= F.col("_all"), F.col(value)))
    high = F.min(F.when(F.col("_upto") * 2 > F.col("_all"), F.col(value)))
    return marked.groupBy(*keys).agg(((low + high) / 2).cast("double").alias(output), *others)


def median_over_ranges(df: DataFrame, keys: Sequence[str], value: str, output: str = "median") -> DataFrame:
    """Exact continuous median per key of values from a wide domain, NULLs ignored.

    Equal values are folded, and the rows lie in range partitions of (key, value).  What a
    partition holds of a key is one row of counts; those rows tell in which partition the
    middle stands, and only there are values looked at, so a group may be of any size.
    """
    keys = list(keys)
    order = [*keys, value]
    weight = F.when(F.col(value).isNotNull(), F.col("_n")).otherwise(F.lit(0))
    counted = df.groupBy(*order).agg(F.count(F.lit(1)).alias("_n"))
    parts = in_ranges(counted, order)
    # Keys as one struct, in which nulls are equal.
    upto = running(parts, keys, order, {"_upto": weight}).withColumn("_key", F.struct(*keys))
    ends = checkpointed(upto.groupBy(PART, "_key").agg(
        F.max("_upto").alias("_last"), F.min(F.col("_upto") - weight).alias("_before")))
    middle = ends.groupBy("_key").agg(F.max("_last").alias("_all")).selectExpr(
        "_key", "(_all + 1) div 2 AS _low", "_all div 2 + 1 AS _high")
    hits = ends.join(middle, "_key").filter("_before < _high and _last >= _low").select(PART, "_key", "_low", "_high")
    low = F.min(F.when(F.col("_upto") >= F.col("_low"), F.col(value)))
    high = F.min(F.when(F.col("_upto") >= F.col("_high"), F.col(value)))
    found = upto.select(PART, "_key", value, "_upto").join(hits, [PART, "_key"])
    return found.groupBy("_key").agg(((low + high) / 2).cast("double").alias(output)).select("_key.*", output)


def string_agg_chunks(df: DataFrame, keys: Sequence[str], col: str, output: str, size: int = 1000, sep: str = ", ") -> DataFrame:
    """Distinct values of a group in sorted order as texts of `size` values each, numbered
    by `chunk` from 0, for groups of any size: the texts of a group, joined in the order
    of the chunks, are its whole list, and no task holds more than one of them."""
    keys, order = list(keys), [*keys, col]
    values = df.select(*order).where(F.col(col).isNotNull()).distinct()
    numbered = running(in_ranges(values, order), keys, order, {"_place": F.lit(1).cast("long")})
    return numbered.withColumn("chunk", F.expr(f"(_place - 1) div {size}")).groupBy(*keys, "chunk").agg(
        F.array_join(F.sort_array(F.collect_list(col)), sep).alias(output))


def string_agg_distinct(df: DataFrame, keys: Sequence[str], col: str, output: str, sep: str = ", ") -> DataFrame:
    """Distinct values of a group in one text, in sorted order."""
    # Pairs are made distinct first: repeats of a hot group never meet in one task.
    pairs = df.select(*keys, col).where(F.col(col).isNotNull()).distinct()
    return pairs.groupBy(*keys).agg(F.array_join(F.sort_array(F.collect_list(col)), sep).alias(output))


def set_of(col: str) -> Column:
    """Sorted array of distinct values."""
    return F.sort_array(F.collect_set(col))


def dedup_first(df: DataFrame, keys: Sequence[str], order: Sequence) -> DataFrame:
    """First row per key in a stated order.  The row limit runs before the shuffle
    as well, so repeats of a hot key are dropped where they are read."""
    return top_n(df, keys, order, 1)


def distinct_on(df: DataFrame, keys: Sequence[str], order: Sequence) -> DataFrame:
    return dedup_first(df, keys, order)


def changes(df: DataFrame, keys: Sequence[str], col: str, output: str = "changes") -> DataFrame:
    """Number of entries minus one."""
    return df.groupBy(*keys).agg((F.count(col) - 1).alias(output))


def span(df: DataFrame, keys: Sequence[str], date: str, first: str = "first_date", last: str = "last_date") -> DataFrame:
    return df.groupBy(*keys).agg(F.min(date).alias(first), F.max(date).alias(last))


def add_counts(target: DataFrame, delta: DataFrame, keys: Sequence[str], count: str,
               labels: Sequence[str] = ()) -> DataFrame:
    """Counters after adding a delta; labels come from the delta when it has one."""
    marked = target.withColumn("_new", F.lit(0)).unionByName(delta.withColumn("_new", F.lit(1)))
    return marked.groupBy(*keys).agg(
        *[F.max_by(F.col(c), F.when(F.col(c).isNotNull(), F.struct(F.col("_new"), F.col(c)))).alias(c)
          for c in labels],
        F.sum(count).cast("bigint").alias(count),
    )
