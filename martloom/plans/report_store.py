"""Monthly reports refreshed from a stored fact table at the cost of the increment.

The fact table is laid out by a hash of the report's owner, and inside by the year of the
load, its rows in the order of their load times.  The years from the watermark on, and in
them only the row groups after it, name the owners that have new lines; their history is read
from their parts only; and their rows replace those of the stored report, again by parts.
A folder for each load day would make as many small files as there are days times parts.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.filters import changed_since
from ..session import checkpointed
from ..sinks.parted import PART, by_hash, parts_of, read_parts, write_parted
from ..sinks.tables import write_table

DAYS = "load_days_from"  # the first day of the year that a folder holds
Report = Callable[[DataFrame, DataFrame, DataFrame, DataFrame, str], DataFrame]


def _days_from(at: Column) -> Column:
    return F.to_date(F.trunc(at, "year"))


def store_facts(fact: DataFrame, path: str, owner_id: str, parts: int) -> None:
    fact = fact.withColumn(DAYS, _days_from(F.col("load_dttm")))
    write_parted(fact, path, by_hash([owner_id], parts), sort_by=[DAYS, "load_dttm"], more=[DAYS])


def append_facts(fact: DataFrame, path: str, owner_id: str, parts: int) -> None:
    """New lines as further files of their year."""
    fact = fact.withColumn(DAYS, _days_from(F.col("load_dttm"))).withColumn(PART, by_hash([owner_id], parts))
    write_table(fact, path, "append", [PART, DAYS], ["load_dttm"])


def store_report(report: DataFrame, path: str, owner_id: str, parts: int) -> None:
    write_parted(report, path, by_hash([owner_id], parts))


def new_lines(spark: SparkSession, path: str, watermark) -> DataFrame:
    """Lines loaded after the watermark: only folders from its year on are read."""
    at = F.lit(watermark).cast("timestamp_ntz")
    return spark.read.parquet(path).filter((F.col(DAYS) >= _days_from(at)) & (F.col("load_dttm") > at))


def owners_of_changes(spark: SparkSession, facts: str, dims: dict[str, DataFrame], owner_id: str, watermark) -> DataFrame:
    """Owners with new lines, and those that a changed owner, partner or product concerns.
    Old lines are only looked through, two columns of them, for a dimension that did change."""
    found = new_lines(spark, facts, watermark).select(owner_id)
    for key, dim in dims.items():
        changed = changed_since(dim, ["load_dttm"], watermark).select(key).distinct()
        if key == owner_id:
            found = found.unionByName(changed)
        elif not changed.isEmpty():
            found = found.unionByName(spark.read.parquet(facts).select(*{key, owner_id}).join(changed, key, "left_semi").select(owner_id))
    return found.distinct()


def refresh_stored(spark: SparkSession, facts: str, mart: str, report: Report, customers: DataFrame, craftsmen: DataFrame,
                   products: DataFrame, owner_id: str, watermark, as_of: str, parts: int) -> list[int]:
    """The stored report after the lines loaded since the watermark; equals a rebuild.
    Returns the parts that were replaced."""
    dims = {"customer_id": customers, "craftsman_id": craftsmen, "product_id": products}
    owners = checkpointed(owners_of_changes(spark, facts, dims, owner_id, watermark).withColumn(PART, by_hash([owner_id], parts)))
    touched = parts_of(owners)
    if not touched:
        return []
    history = read_parts(spark, facts, touched).join(owners, [owner_id, PART], "left_semi").drop(PART, DAYS)
    fresh = report(history, customers, craftsmen, products, as_of).withColumn(PART, by_hash([owner_id], parts))
    kept = read_parts(spark, mart, touched).join(owners, [owner_id, PART], "left_anti")
    checkpointed(kept.unionByName(fresh)).hint("rebalance", PART).write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic").partitionBy(PART).parquet(mart)
    return touched
