"""Car dealership: a flat sales table to entities, and six reports on them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.keys import hash_key
from ..functions.money import mean_of, price_gross, price_net
from ..functions.text import part_of
from ..operators.aggregates import null_pct, string_agg_distinct


def parse_auto(raw: DataFrame, auto: str = "auto") -> DataFrame:
    """Brand (first word), model (the words after it up to the comma) and colour."""
    car = F.trim(part_of(F.col(auto), ",", 1))
    brand = part_of(car, " ", 1)
    colour = F.trim(part_of(F.col(auto), ",", 2))
    return raw.withColumns({
        "brand_name": brand,
        "model_name": F.trim(F.substr(car, F.length(brand) + 1)),
        "color_name": F.when(colour != "", colour),
    })


def normalise_sales(raw: DataFrame) -> dict[str, DataFrame]:
    """Six tables in third normal form.  Keys are hashes of the natural keys, so the
    sales table is a projection of the raw rows and needs no look-up join."""
    rows = parse_auto(raw)
    country = hash_key(F.col("brand_origin"))
    brand = hash_key(F.col("brand_name"))
    model = hash_key(F.col("brand_name"), F.col("model_name"))
    color = hash_key(F.col("color_name"))
    customer = hash_key(F.col("person_name"), F.col("phone"))

    def when_known(key: Column, *cols: str) -> Column:
        known = F.lit(True)
        for c in cols:
            known = known & F.col(c).isNotNull()
        return F.when(known, key)

    brands = rows.groupBy("brand_name").agg(F.min("brand_origin").alias("brand_origin"))
    models = rows.groupBy("brand_name", "model_name").agg(
        F.min("gasoline_consumption").alias("gasoline_consumption")
    )
    return {
        "countries": rows.filter(F.col("brand_origin").isNotNull()).select(
            country.alias("country_id"), F.col("brand_origin").alias("country_name")).distinct(),
        "brands": brands.select(brand.alias("brand_id"), "brand_name",
                                when_known(country, "brand_origin").alias("country_id")),
        "models": models.select(model.alias("model_id"), brand.alias("brand_id"), "model_name", "gasoline_consumption"),
        "colors": rows.filter(F.col("color_name").isNotNull()).select(color.alias("color_id"), "color_name").distinct(),
        "customers": rows.select(customer.alias("customer_id"), F.col("person_name").alias("name"), "phone").distinct(),
        "sales": rows.select(F.col("id").alias("sale_id"), customer.alias("customer_id"), model.alias("model_id"),
                             when_known(color, "color_name").alias("color_id"), "price",
                             F.col("date").alias("sale_date"), "discount"),
    }


def missing_consumption(models: DataFrame) -> DataFrame:
    return null_pct(models, "gasoline_consumption", "nulls_percentage_gasoline_consumption")


def _net_mean() -> Column:
    net = price_net(F.col("price"), F.col("discount")).cast("decimal(18,6)")
    return F.round(F.avg(net), 2)


def price_by_brand_year(sales: DataFrame, models: DataFrame, brands: DataFrame) -> DataFrame:
    rows = sales.join(models.select("model_id", "brand_id"), "model_id").join(
        brands.select("brand_id", "brand_name"), "brand_id")
    return rows.groupBy("brand_name", F.year("sale_date").alias("year")).agg(_net_mean().alias("price_avg"))


def price_by_month(sales: DataFrame, year: int) -> DataFrame:
    first, after = F.lit(f"{year}-01-01").cast("date"), F.lit(f"{year + 1}-01-01").cast("date")
    rows = sales.filter((F.col("sale_date") >= first) & (F.col("sale_date") < after))
    return rows.groupBy(F.month("sale_date").alias("month"), F.year("sale_date").alias("year")).agg(
        _net_mean().alias("price_avg"))


def cars_of_person(sales: DataFrame, customers: DataFrame, models: DataFrame, brands: DataFrame) -> DataFrame:
    cars = models.join(brands.select("brand_id", "brand_name"), "brand_id").select(
        "model_id", F.concat_ws(" ", "brand_name", "model_name").alias("car"))
    # Each person's distinct models first, then the names.
    bought = sales.select("customer_id", "model_id").distinct()
    rows = bought.join(cars, "model_id").join(customers.select("customer_id", F.col("name").alias("person")), "customer_id")
    return string_agg_distinct(rows, ["person"], "car", "cars")


def price_range_by_country(sales: DataFrame, models: DataFrame, brands: DataFrame, countries: DataFrame) -> DataFrame:
    gross = F.round(price_gross(F.col("price"), F.col("discount")).cast("decimal(18,6)"), 2)
    by_model = sales.groupBy("model_id").agg(F.max(gross).alias("hi"), F.min(gross).alias("lo"))
    rows = by_model.join(models.select("model_id", "brand_id"), "model_id").join(
        brands.select("brand_id", "country_id"), "brand_id").join(countries, "country_id")
    return rows.groupBy(F.col("country_name").alias("brand_origin")).agg(
        F.max("hi").alias("price_max"), F.min("lo").alias("price_min"))


def persons_with_prefix(customers: DataFrame, prefix: str = "+1") -> DataFrame:
    return customers.filter(F.col("phone").startswith(prefix)).agg(F.count(F.lit(1)).alias("persons_from_usa_count"))
