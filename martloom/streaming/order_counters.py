"""Running counters per user and product, and per user and category."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.aggregates import add_counts
from ..operators.merge import new_rows
from ..plans.counters import counted_items, user_category_counters, user_product_counters
from .common import BATCH, dedup_messages, read_before, write_batch

# Fields of a message from the vault layer.
ENRICHED_SCHEMA = (
    "h_order_pk string, h_user_pk string, h_restaurant_pk string, cost decimal(14,2), payment decimal(14,2), "
    "status string, products array<struct<product_id: string>>"
)
ITEMS = "user_id string, product_id string"


def running_counts(messages: DataFrame, sent: str = "sent_at", delay: str = "1 day") -> DataFrame:
    """Orders per user and product, kept in the state store; start it in update mode.

    Only messages that count are remembered, by their order, for `delay` of sending time:
    one delivered again within it is dropped by that state, one sent before it is late and
    dropped by the watermark.  No table of the orders seen is read, so a batch costs what
    it touches, however many came before.
    """
    counting = messages.filter(
        F.col("h_order_pk").isNotNull() & (F.col("status").isNull() | F.col("status").isin("", "CLOSED")))
    once = dedup_messages(counting, "h_order_pk", sent, delay)
    return counted_items(once).groupBy("user_id", "product_id").agg(F.count(F.lit(1)).alias("order_cnt"))


def changed_counts(root: str):
    """Handler for the counters in update mode: a batch writes the new state of the
    counters that it changed; a retried batch replaces its folder."""
    return lambda batch, batch_id: write_batch(batch, f"{root}/counts", batch_id)


def current_counts(spark: SparkSession, root: str) -> DataFrame:
    """The last state of every counter: user_id, product_id, order_cnt."""
    changes = spark.read.parquet(f"{root}/counts")
    return changes.groupBy("user_id", "product_id").agg(F.max_by("order_cnt", BATCH).alias("order_cnt"))


def counter_batch(root: str, directory: DataFrame):
    """Handler for foreachBatch.  A batch adds its own counts as one folder of deltas.
    Orders counted in any earlier batch are skipped, however long ago, by the table of
    their keys, which every batch reads; `running_counts` bounds that by a delay instead.
    A retried batch replaces its folders."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        orders = f"{root}/orders"
        seen_schema = batch.select("h_order_pk").schema
        # Only closed orders are final, so only those are remembered.
        counting = batch.filter(
            F.col("h_order_pk").isNotNull() & (F.col("status").isNull() | F.col("status").isin("", "CLOSED"))
        )
        fresh = new_rows(read_before(spark, orders, batch_id, seen_schema), counting, ["h_order_pk"],
                         [F.to_json(F.struct(*[c for c in batch.columns if c != "h_order_pk"]))]).persist()
        try:
            items = counted_items(fresh)
            write_batch(user_product_counters(items, directory), f"{root}/user_product", batch_id)
            write_batch(user_category_counters(items, directory), f"{root}/user_category", batch_id)
            write_batch(fresh.select("h_order_pk"), orders, batch_id)
        finally:
            fresh.unpersist()

    return handle


def read_counters(spark: SparkSession, root: str, kind: str) -> DataFrame:
    """Counters so far: deltas added up.  kind is product or category."""
    deltas = spark.read.parquet(f"{root}/user_{kind}")
    keys, label = ["user_id", f"{kind}_id"], f"{kind}_name"
    newest = F.max_by(label, F.col("batch_id"))
    return deltas.groupBy(*keys).agg(newest.alias(label), F.sum("order_cnt").cast("bigint").alias("order_cnt"))


def compact(spark: SparkSession, target: DataFrame, deltas: DataFrame, kind: str) -> DataFrame:
    """Fold deltas into a counter table, to be published as its next version."""
    return add_counts(target, deltas, ["user_id", f"{kind}_id"], "order_cnt", [f"{kind}_name"])
