"""Car service inventory: cars(vin, model, price, date_start, status),
models(id, name, brand), sales(sales_number, car_vin, sales_date, cost)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.joins import first_match
from ..operators.merge import delete_by_key, insert_ignore, rename_key, require_known, update_from
from ..operators.windows import top_k

STATUSES = ("available", "reserve", "sold", "delivery")


def add_cars(cars: DataFrame, new: DataFrame) -> DataFrame:
    return cars.unionByName(new)


def add_models(models: DataFrame, new: DataFrame) -> DataFrame:
    return models.unionByName(new)


def _set_status(cars: DataFrame, vins: DataFrame, status: str) -> DataFrame:
    marks = vins.select(F.col("car_vin").alias("vin")).distinct().withColumn("status", F.lit(status))
    return update_from(cars, marks, ["vin"], ["status"])


def sell(cars: DataFrame, sales: DataFrame, new_sales: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(cars, sales) after the sales; an unknown VIN fails before anything is written."""
    checked = require_known(new_sales, cars.select(F.col("vin").alias("car_vin")), "car_vin", "VIN")
    return _set_status(cars, checked, "sold"), insert_ignore(sales, checked, ["sales_number"])


def revert(cars: DataFrame, sales: DataFrame, gone: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(cars, sales) without the given sales; their cars are available again."""
    checked = require_known(gone.select("sales_number"), sales, "sales_number", "sale")
    dropped = sales.join(checked.distinct(), "sales_number", "left_semi")
    return _set_status(cars, dropped, "available"), delete_by_key(sales, checked, ["sales_number"])


def rename_vin(cars: DataFrame, sales: DataFrame, mapping: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(cars, sales) with VINs replaced through mapping(vin, new_vin)."""
    known = require_known(mapping, cars, "vin", "VIN")
    in_sales = known.select(F.col("vin").alias("car_vin"), F.col("new_vin"))
    return rename_key(cars, known, "vin", "new_vin"), rename_key(sales, in_sales, "car_vin", "new_vin")


def list_cars(cars: DataFrame, status: str) -> DataFrame:
    return cars.filter(F.col("status") == status)


def car_info(cars: DataFrame, models: DataFrame, sales: DataFrame) -> DataFrame:
    """Car with model, brand and its first sale, if any; filter by vin for one car."""
    named = models.select(F.col("id").alias("model"), F.col("name").alias("car_model_name"),
                          F.col("brand").alias("car_model_brand"))
    sold = sales.select(F.col("car_vin").alias("vin"), "sales_number", "sales_date", F.col("cost").alias("sales_cost"))
    rows = cars.join(named, "model").drop("model")
    return first_match(rows, sold, "vin", ["sales_date", "sales_number"], ["sales_date", "sales_cost"])


def top_models(sales: DataFrame, cars: DataFrame, models: DataFrame, k: int = 3) -> DataFrame:
    """Most sold models; of equal counts the one sold first comes first."""
    per_car = sales.groupBy(F.col("car_vin").alias("vin")).agg(
        F.count(F.lit(1)).alias("_n"), F.min(F.struct("sales_date", "sales_number")).alias("_first"))
    rows = per_car.join(cars.select("vin", "model"), "vin").groupBy("model").agg(
        F.sum("_n").alias("sales_number"), F.min("_first").alias("_first"))
    best = top_k(rows, [F.col("sales_number").desc(), F.col("_first"), F.col("model")], k)
    return best.join(models.select(F.col("id").alias("model"), F.col("name").alias("car_model_name"), "brand"), "model")
