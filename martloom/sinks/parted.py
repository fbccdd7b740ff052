"""Tables laid out by a part of their key, so that a change touches only its parts.

The part is a column made from the key (a range or a hash of it), and a folder of the
table.  An increment names the parts it falls into; only those are listed, read, merged
and replaced, and the files of all others stay as they are.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.merge import keyed_merge
from ..session import checkpointed
from .tables import write_table

PART = "part"


def by_range(key: str, width: int) -> Column:
    """Parts of `width` neighbouring whole-number keys; null keys have one of their own.
    Right when increments bring new or recent keys."""
    return F.coalesce(F.floor(F.col(key) / F.lit(width)).cast("long"), F.lit(-1).cast("long"))


def by_hash(keys: Sequence[str], parts: int) -> Column:
    """Equal parts whatever the keys are.  Right when the key has no order in time."""
    return F.pmod(F.xxhash64(*keys), F.lit(parts))


def write_parted(df: DataFrame, path: str, part: Column, sort_by: Sequence[str] = (), more: Sequence[str] = ()) -> None:
    """A new table; `more` are columns that divide the parts further."""
    write_table(df.withColumn(PART, part), path, partition_by=[PART, *more], sort_by=sort_by)


def parts_of(df: DataFrame) -> list[int]:
    """The parts that a frame falls into: as many as a table has folders at most."""
    return sorted(r[0] for r in df.select(PART).distinct().toLocalIterator())


def read_parts(spark: SparkSession, path: str, parts: Sequence[int] | None = None) -> DataFrame:
    """The table, or these parts of it: a filter on folders, so no other is read."""
    table = spark.read.parquet(path)
    return table if parts is None else table.filter(F.col(PART).isin([*parts]))


def touched(path: str, source: DataFrame, keys: Sequence[str], part: Column, update_cols: Sequence[str] | None = None,
            check: bool = True) -> tuple[DataFrame, list[int]]:
    """The touched parts after the merge, and their numbers.  One row per key in `source`."""
    source = source.withColumn(PART, part)
    parts = parts_of(source)
    target = read_parts(source.sparkSession, path, parts)
    merged = keyed_merge(target, source, [*keys, PART], update_cols, check)
    return merged, parts


def merge_into(path: str, source: DataFrame, keys: Sequence[str], part: Column,
               update_cols: Sequence[str] | None = None, check: bool = True,
               before: Callable[[DataFrame], DataFrame] = lambda df: df) -> list[int]:
    """MERGE into the stored table: matched rows take `update_cols` (all by default), the
    rest of the source is inserted.  Only the parts it falls into are read and replaced;
    returns their numbers.

    The merged parts are first kept in the checkpoint folder: a lost executor does not
    read files that are being replaced, and a repeated run gives the same table.
    """
    merged, parts = touched(path, checkpointed(before(source)), keys, part, update_cols, check)
    if parts:
        checkpointed(merged).hint("rebalance", PART).write.mode("overwrite").option(
            "partitionOverwriteMode", "dynamic").partitionBy(PART).parquet(path)
    return parts
