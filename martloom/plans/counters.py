"""Order messages to user counters."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.filters import valid_orders
from ..operators.joins import any_linked, latest_name


def counted_items(messages: DataFrame) -> DataFrame:
    """(user, product) rows of the messages that count; items without an id are left out."""
    rows = valid_orders(messages).select("h_user_pk", F.explode("products").alias("p"))
    return rows.select(F.col("h_user_pk").alias("user_id"), F.col("p.product_id").alias("product_id")).filter(
        F.col("product_id").isNotNull() & (F.col("product_id").cast("string") != "")
    )


def product_directory(products: DataFrame, names: DataFrame, product_category: DataFrame, categories: DataFrame) -> DataFrame:
    """product_id → product key, latest name, one category.  Products without a
    category do not appear, so they are not counted.

    products(h_product_pk, product_id), names(h_product_pk, name, load_dt),
    product_category(h_product_pk, h_category_pk), categories(h_category_pk, category_name).
    """
    named = latest_name(products, names, "h_product_pk", "name", "load_dt").withColumnRenamed("name", "product_name")
    return any_linked(named, product_category, "h_product_pk", "h_category_pk").join(categories, "h_category_pk")


def user_product_counters(items: DataFrame, directory: DataFrame) -> DataFrame:
    counts = items.groupBy("user_id", "product_id").agg(F.count(F.lit(1)).alias("order_cnt"))
    return counts.join(directory.select("product_id", "h_product_pk", "product_name"), "product_id").select(
        "user_id", F.col("h_product_pk").alias("product_id"), "product_name", "order_cnt"
    )


def user_category_counters(items: DataFrame, directory: DataFrame) -> DataFrame:
    # Counted per product first: the look-up then meets each (user, product) once.
    counts = items.groupBy("user_id", "product_id").agg(F.count(F.lit(1)).alias("_n"))
    return (
        counts.join(directory.select("product_id", "h_category_pk", "category_name"), "product_id")
        .groupBy("user_id", F.col("h_category_pk").alias("category_id"), "category_name")
        .agg(F.sum("_n").alias("order_cnt"))
    )
