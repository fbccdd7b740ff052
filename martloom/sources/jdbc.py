"""Tables behind JDBC."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def read_jdbc(spark: SparkSession, url: str, table: str, **options: str) -> DataFrame:
    """Whole table; for large ones give partitionColumn, lowerBound, upperBound and
    numPartitions so that executors read ranges in parallel."""
    return spark.read.format("jdbc").options(url=url, dbtable=table, **options).load()


def read_jdbc_slice(spark: SparkSession, url: str, table: str, date_col: str, day: str,
                    where: Column | None = None, **options: str) -> DataFrame:
    """Rows of one day; the range and the extra predicate are sent to the database."""
    start = dt.date.fromisoformat(day)
    end = start + dt.timedelta(days=1)
    df = read_jdbc(spark, url, table, **options)
    dtype = df.schema[date_col].dataType.simpleString()
    df = df.filter((F.col(date_col) >= F.lit(str(start)).cast(dtype)) & (F.col(date_col) < F.lit(str(end)).cast(dtype)))
    return df if where is None else df.filter(where)


def write_jdbc(df: DataFrame, url: str, table: str, mode: str = "append", batch_size: int = 1000,
               truncate: bool = False, **options: str) -> None:
    """Batched inserts from all executors; with truncate an overwrite keeps the table."""
    df.write.format("jdbc").options(
        url=url, dbtable=table, batchsize=str(batch_size), truncate=str(truncate).lower(), **options
    ).mode(mode).save()
