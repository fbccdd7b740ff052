"""Restaurant chain: load from raw tables and seven reports or changes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.keys import hash_key
from ..functions.money import mean_of
from ..functions.text import normalise
from ..operators.aggregates import changes, distinct_on, span
from ..operators.windows import best_overall, number_rows, pct_change, top_k, top_n, with_previous

# Raw type words and the type they stand for.
TYPE_WORDS = {
    "кофейня": "coffee_shop",
    "coffee_shop": "coffee_shop",
    "ресторан": "restaurant",
    "restaurant": "restaurant",
    "бар": "bar",
    "bar": "bar",
    "пиццерия": "pizzeria",
    "pizzeria": "pizzeria",
}
# Menu keys, price factor, phone prefix, first phone number.
PIZZA, COFFEE, CAPPUCCINO = "Пицца", "Кофе", "Капучино"
PRICE_FACTOR = "1.2"
PHONE_PREFIX = "8-800-2500-"
FIRST_PHONE = 100


def load_restaurants(raw_sales: DataFrame, raw_menu: DataFrame) -> DataFrame:
    """One row per cafe; of several types the first in order is taken."""
    cafes = distinct_on(raw_sales.select("cafe_name", "type"), ["cafe_name"], ["type"])
    return cafes.join(raw_menu, "cafe_name", "left").select(
        hash_key(F.col("cafe_name")).alias("restaurant_uuid"),
        F.col("cafe_name").alias("name"),
        normalise(F.col("type"), TYPE_WORDS, "restaurant").alias("type"),
        F.coalesce(F.col("menu"), F.lit("{}")).alias("menu"),
    )


def load_managers(raw_sales: DataFrame) -> DataFrame:
    return raw_sales.filter(F.col("manager").isNotNull()).select(
        hash_key(F.col("manager"), F.col("manager_phone")).alias("manager_uuid"),
        F.col("manager").alias("name"), F.col("manager_phone").alias("phone"),
    ).distinct()


def load_work_dates(raw_sales: DataFrame) -> DataFrame:
    """First and last report day of every manager in every cafe."""
    rows = raw_sales.filter(F.col("manager").isNotNull()).select(
        hash_key(F.col("cafe_name")).alias("restaurant_uuid"),
        hash_key(F.col("manager"), F.col("manager_phone")).alias("manager_uuid"),
        F.to_date("report_date").alias("_day"),
    )
    return span(rows, ["restaurant_uuid", "manager_uuid"], "_day", "work_start", "work_end")


def load_sales(raw_sales: DataFrame) -> DataFrame:
    return raw_sales.select(F.to_date("report_date").alias("date"),
                            hash_key(F.col("cafe_name")).alias("restaurant_uuid"), "avg_check")


def _mean_check() -> Column:
    return mean_of(F.sum("avg_check"), F.count("avg_check"))


def best_by_type(sales: DataFrame, restaurants: DataFrame, n: int = 3) -> DataFrame:
    means = sales.groupBy("restaurant_uuid").agg(_mean_check().alias("avg_check"))
    rows = means.join(restaurants.select("restaurant_uuid", F.col("name").alias("restaurant_name"),
                                         F.col("type").alias("restaurant_type")), "restaurant_uuid")
    best = top_n(rows, ["restaurant_type"], [F.col("avg_check").desc(), F.col("restaurant_name")], n)
    return best.select("restaurant_name", "restaurant_type", "avg_check")


def check_dynamics(sales: DataFrame, restaurants: DataFrame, skip_year: int = 2023) -> DataFrame:
    yearly = sales.filter(F.year("date") != skip_year).groupBy(
        "restaurant_uuid", F.year("date").alias("year")
    ).agg(_mean_check().alias("current_avg_check"))
    rows = with_previous(yearly, ["restaurant_uuid"], ["year"], "current_avg_check", "prev_avg_check")
    rows = rows.withColumn("change_percent", pct_change(F.col("current_avg_check"), F.col("prev_avg_check")))
    names = restaurants.select("restaurant_uuid", F.col("name").alias("restaurant_name"),
                               F.col("type").alias("restaurant_type"))
    return rows.join(names, "restaurant_uuid").drop("restaurant_uuid")


def most_manager_changes(work_dates: DataFrame, restaurants: DataFrame, k: int = 3) -> DataFrame:
    rows = changes(work_dates, ["restaurant_uuid"], "manager_uuid", "manager_changes")
    named = rows.join(restaurants.select("restaurant_uuid", F.col("name").alias("restaurant_name")), "restaurant_uuid")
    return top_k(named.select("restaurant_name", "manager_changes"),
                 [F.col("manager_changes").desc(), F.col("restaurant_name")], k)


def menu_items(restaurants: DataFrame, category: str, kind: str = "pizzeria", value_type: str = "int") -> DataFrame:
    """(restaurant_name, dish, price) of one menu category."""
    menu = F.from_json("menu", f"map<string,map<string,{value_type}>>")
    rows = restaurants.filter(F.col("type") == kind)
    return rows.select(F.col("name").alias("restaurant_name"),
                       F.explode(F.try_element_at(menu, F.lit(category))).alias("dish", "price"))


def largest_pizza_menus(restaurants: DataFrame) -> DataFrame:
    counts = menu_items(restaurants, PIZZA).groupBy("restaurant_name").agg(F.count(F.lit(1)).alias("pizza_count"))
    return best_overall(counts, "pizza_count")


def priciest_pizza(restaurants: DataFrame) -> DataFrame:
    return top_n(menu_items(restaurants, PIZZA), ["restaurant_name"], [F.col("price").desc(), F.col("dish")], 1)


def raise_price(restaurants: DataFrame, category: str = COFFEE, dish: str = CAPPUCCINO, kind: str = "coffee_shop",
                factor: str = PRICE_FACTOR) -> DataFrame:
    """New menu text where the dish costs `factor` as much; other rows keep theirs."""
    menu = F.from_json("menu", "map<string,map<string,decimal(18,2)>>")
    dishes = F.try_element_at(menu, F.lit(category))
    has_dish = F.coalesce(F.map_contains_key(dishes, dish), F.lit(False))
    times = F.lit(factor).cast("decimal(10,4)")

    def dearer(d):
        return F.transform_values(
            d, lambda k, p: F.when(k == dish, (p * times).cast("decimal(18,2)")).otherwise(p))

    changed = F.transform_values(menu, lambda c, d: F.when(c == category, dearer(d)).otherwise(d))
    hit = (F.col("type") == kind) & has_dish
    return restaurants.withColumn("menu", F.when(hit, F.to_json(changed)).otherwise(F.col("menu")))


def evolve_phones(managers: DataFrame) -> DataFrame:
    """Replace `phone` by phone_numbers = [new number by name order, old number]."""
    numbered = number_rows(managers, ["name", "manager_uuid"], FIRST_PHONE, "_n")
    new = F.concat(F.lit(PHONE_PREFIX), F.col("_n").cast("string"))
    return numbered.withColumn("phone_numbers", F.array(new, F.col("phone"))).drop("_n", "phone")
