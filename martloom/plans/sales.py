"""Sales fact with refunds and weekly customer retention."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import date_to_int, int_to_date, iso_week, on_day, trailing_days
from ..functions.money import signed_amount, sum_money
from ..operators.aggregates import sum_if
from ..operators.merge import insert_ignore, new_rows


def calendar(spark, first: str, last: str) -> DataFrame:
    """d_calendar(date_id yyyymmdd, date_actual)."""
    days = F.explode(F.sequence(F.lit(first).cast("date"), F.lit(last).cast("date")))
    return spark.range(1).select(days.alias("date_actual")).select(
        date_to_int(F.col("date_actual")).alias("date_id"), "date_actual"
    )


def append_increment(log: DataFrame, increment: DataFrame, key: str = "uniq_id") -> DataFrame:
    """Log plus the increment's new keys, one row per key."""
    return insert_ignore(log, increment, [key])


def sales_fact(log: DataFrame, day: str | None = None) -> DataFrame:
    """One row per order line; refunds are negative, a missing status means shipped.
    With a day only that slice is built, to be put in place by `replace_slice`."""
    rows = log if day is None else log.filter(on_day(F.col("date_time"), day))
    return rows.select(
        date_to_int(F.col("date_time")).alias("date_id"), "item_id", "customer_id", "city_id", "quantity",
        signed_amount(F.col("payment_amount"), F.col("status")).alias("payment_amount"),
        F.coalesce(F.col("status"), F.lit("shipped")).alias("status"),
    )


def new_cities(dim: DataFrame, log: DataFrame) -> DataFrame:
    return new_rows(dim, log.groupBy("city_id", "city_name").agg(F.lit(1).alias("_")).drop("_"), ["city_id"])


def new_items(dim: DataFrame, log: DataFrame) -> DataFrame:
    return new_rows(dim, log.groupBy("item_id", "item_name").agg(F.lit(1).alias("_")).drop("_"), ["item_id"])


def new_customers(dim: DataFrame, log: DataFrame) -> DataFrame:
    """Customers not in the dimension yet, with the largest city id seen."""
    rows = log.groupBy("customer_id", "first_name", "last_name").agg(F.max("city_id").alias("city_id"))
    return new_rows(dim, rows, ["customer_id"])


def retention(sales: DataFrame, last_day: str | None = None, days: int = 7) -> DataFrame:
    """ISO week and item: new (one purchase), returning (more) and refunding customers
    with their revenue.

    With last_day the trailing window of `days` is used, which can touch two weeks;
    without it every full week of the table gets its rows.  New or returning is
    judged inside the rows read, per item and status.
    """
    date = int_to_date(F.col("date_id"))
    rows = sales.withColumn("_date", date)
    if last_day is not None:
        rows = rows.filter(trailing_days(F.col("_date").cast("timestamp_ntz"), last_day, days))
    per_customer = (
        rows.withColumn("period_start", F.trunc("_date", "week"))
        .groupBy("period_start", "item_id", "customer_id", "status")
        .agg(sum_money(F.col("payment_amount")).alias("_revenue"), F.count(F.lit(1)).alias("_orders"))
    )
    refunded = F.col("status") == "refunded"
    kinds = {
        "new": ~refunded & (F.col("_orders") == 1),
        "returning": ~refunded & (F.col("_orders") > 1),
        "refunded": refunded,
    }
    # A customer counts once per kind, whatever the number of statuses.  One more
    # fold per customer replaces three distinct counts, which would triple the rows.
    zero = F.lit(0).cast("decimal(24,2)")
    customers = per_customer.groupBy("period_start", "item_id", "customer_id").agg(
        *[F.max(pred.cast("int")).alias(f"_is_{k}") for k, pred in kinds.items()],
        *[sum_if(pred, F.col("_revenue"), zero).cast("decimal(24,2)").alias(f"_{k}") for k, pred in kinds.items()],
    )
    known = F.col("customer_id").isNotNull()
    return (
        customers.groupBy("period_start", "item_id")
        .agg(
            sum_if(known, F.col("_is_new")).alias("new_customers_count"),
            sum_if(known, F.col("_is_returning")).alias("returning_customers_count"),
            sum_if(known, F.col("_is_refunded")).alias("refunded_customer_count"),
            F.sum("_new").alias("new_customers_revenue"),
            F.sum("_returning").alias("returning_customers_revenue"),
            F.sum("_refunded").alias("customers_refunded"),
        )
        .withColumn("period_id", iso_week(F.col("period_start")))
        .withColumn("period_name", F.lit("weekly"))
    )
