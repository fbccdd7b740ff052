"""Courier settlement ledger and the staging of API objects."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.documents import json_get
from ..functions.money import PAYOUT_TIERS, PAYOUT_TOP, PROCESSING_FEE, TIPS_SHARE, dec, mean_of, sum_money, tiered
from ..operators.aggregates import dedup_first
from ..operators.merge import keyed_merge, new_rows
from ..session import shuffle_partitions

LEDGER_KEY = ["courier_id", "settlement_year", "settlement_month"]


def stage_objects(staged: DataFrame, incoming: DataFrame, keep: str = "first") -> DataFrame:
    """API objects (object_id, object_value, load_dttm) by id.  The first version is
    kept for ever; `keep="latest"` takes the newest instead."""
    if keep == "first":
        return staged.unionByName(new_rows(staged, incoming, ["object_id"], ["load_dttm", "object_value"]))
    order = [F.col("load_dttm").desc(), F.col("object_value")]
    return keyed_merge(staged, dedup_first(incoming, ["object_id"], order), ["object_id"], check=False)


def couriers_from(staged: DataFrame) -> DataFrame:
    return staged.select(
        F.col("object_id").alias("courier_id"),
        json_get(F.col("object_value"), "$.name").alias("courier_name"),
    )


def deliveries_from(staged: DataFrame) -> DataFrame:
    v = F.col("object_value")
    return staged.select(
        json_get(v, "$.delivery_id").alias("delivery_id"),
        json_get(v, "$.order_id").alias("order_id"),
        json_get(v, "$.courier_id").alias("courier_id"),
        json_get(v, "$.delivery_ts", "timestamp_ntz").alias("order_ts"),
        json_get(v, "$.rate", "int").alias("rate"),
        json_get(v, "$.tip_sum", "decimal(14,2)").alias("tip_sum"),
    )


def ledger(deliveries: DataFrame, couriers: DataFrame, product_sales: DataFrame, per_order_floor: bool = False) -> DataFrame:
    """Courier and month: distinct orders, total, mean rating (rounded to two digits
    before the tier is chosen), 25 % fee, payout, tips, reward = payout + 95 % of tips.

    The payout floor applies to the month's total, or to each order when
    per_order_floor is set.
    """
    totals = product_sales.groupBy("order_id").agg(sum_money(F.col("total_sum")).alias("_total"))
    # Distinct orders are counted by the first row of each, marked in the order that the join
    # sorts by anyway: a distinct aggregate would keep every order of a task in hash maps.
    keyed = deliveries.withColumns({"settlement_year": F.year("order_ts"), "settlement_month": F.month("order_ts")})
    same_order = Window.partitionBy("order_id", *LEDGER_KEY).orderBy("order_id")
    # A number of partitions keeps Spark from merging them: each task sorts its part of the
    # lines and holds a wide row of sums for nearly every line in it.
    marked = keyed.repartition(shuffle_partitions(deliveries.sparkSession), "order_id").withColumn(
        "_first", F.when(F.col("order_id").isNotNull() & (F.row_number().over(same_order) == 1), 1))
    rows = marked.join(totals, "order_id", "left").withColumn("_total", F.coalesce("_total", dec("0.00")))
    total = F.col("_total").cast("decimal(18,2)")

    def floored(share: str, floor: str) -> Column:
        return F.sum(F.greatest((total * dec(share)).cast("decimal(24,4)"), F.lit(floor).cast("decimal(24,4)")))

    tiers = [(share, floor) for _, share, floor in PAYOUT_TIERS] + [PAYOUT_TOP]
    monthly = (
        rows.groupBy(*LEDGER_KEY)
        .agg(
            F.count("_first").alias("orders_count"),
            sum_money(F.col("_total")).alias("orders_total_sum"),
            mean_of(F.sum("rate"), F.count("rate")).cast("decimal(3,2)").alias("rate_avg"),
            sum_money(F.col("tip_sum")).alias("courier_tips_sum"),
            *[floored(*t).alias(f"_pay{i}") for i, t in enumerate(tiers) if per_order_floor],
        )
    )
    payout = tiered(F.col("rate_avg"), F.col("orders_total_sum"))
    if per_order_floor:
        payout = F.when(F.col("rate_avg").isNull(), None)
        for i, (below, _, _) in enumerate(PAYOUT_TIERS):
            payout = payout.when(F.col("rate_avg") < dec(below), F.col(f"_pay{i}"))
        payout = payout.otherwise(F.col(f"_pay{len(PAYOUT_TIERS)}"))
    tips = F.coalesce(F.col("courier_tips_sum"), F.lit(0).cast("decimal(24,2)"))
    out = monthly.withColumn("courier_order_sum", payout).withColumns({
        "order_processing_fee": F.col("orders_total_sum") * dec(PROCESSING_FEE),
        "courier_reward_sum": F.col("courier_order_sum") + tips * dec(TIPS_SHARE),
    })
    # Names are attached to the monthly rows, not to every delivery.
    return out.join(couriers.select("courier_id", "courier_name"), "courier_id").select(
        "courier_id", "courier_name", "settlement_year", "settlement_month", "orders_count", "orders_total_sum",
        "rate_avg", "order_processing_fee", "courier_order_sum", "courier_tips_sum", "courier_reward_sum",
    )


def upsert_ledger(target: DataFrame, fresh: DataFrame) -> DataFrame:
    return keyed_merge(target, fresh, LEDGER_KEY)
