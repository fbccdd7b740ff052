"""Changes of a car inventory, menus of a restaurant chain, the star's fact rows, staged objects."""

from __future__ import annotations

from pyspark.sql import functions as F

from martloom.functions.money import money
from martloom.plans import inventory, restaurants, star
from martloom.plans import ledger as courier

from .registry import query, sql_half_up

_SPLIT = "2000-01-01"


def _at(text: str):
    return F.lit(text).cast("timestamp_ntz")


# --- inventory: orders are cars, their lines are sales ------------------------------

def _cars(t):
    return t.orders.select(
        F.col("o_orderkey").alias("vin"), F.col("o_custkey").alias("model"), F.col("o_totalprice").alias("price"),
        F.when(F.col("o_orderstatus") == "P", "reserve").otherwise("available").alias("status"))


def _sales(t):
    return t.lineitem.groupBy((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("sales_number")).agg(
        F.min("l_orderkey").alias("car_vin"), F.min("l_shipdate").alias("sales_date"),
        F.sum(money(F.col("l_extendedprice"))).alias("cost"))


_CARS = """
cars AS (SELECT o_orderkey AS vin, o_custkey AS model, o_totalprice AS price,
  CASE o_orderstatus WHEN 'P' THEN 'reserve' ELSE 'available' END AS status FROM orders),
sales AS (SELECT l_orderkey * 10 + l_linenumber AS sales_number, min(l_orderkey) AS car_vin, min(l_shipdate) AS sales_date,
  sum(l_extendedprice::DECIMAL(18,2)) AS cost FROM lineitem GROUP BY 1)"""
_SALES_COLUMNS = "sales_number, car_vin, strftime(sales_date, '%Y-%m-%d %H:%M:%S') AS sales_date, cost::DOUBLE AS cost"


def _sell(t):
    """Sales before 2000 are known; all from 1999 on come in, so some of them again."""
    sales = _sales(t)
    return inventory.sell(_cars(t), sales.filter(F.col("sales_date") < _at(_SPLIT)),
                          sales.filter(F.col("sales_date") >= _at("1999-01-01")))


@query(f"""
WITH {_CARS}
SELECT vin, model, price, CASE WHEN vin IN (SELECT car_vin FROM sales WHERE sales_date >= TIMESTAMP '1999-01-01')
  THEN 'sold' ELSE status END AS status FROM cars""")
def sell_cars(t):
    return _sell(t)[0]


@query(f"WITH {_CARS} SELECT {_SALES_COLUMNS} FROM sales")
def sell_sales(t):
    return _sell(t)[1]


def _revert(t):
    sales = _sales(t)
    return inventory.revert(_cars(t), sales, sales.filter(F.col("sales_date") >= _at(_SPLIT)))


@query(f"""
WITH {_CARS}
SELECT vin, model, price, CASE WHEN vin IN (SELECT car_vin FROM sales WHERE sales_date >= TIMESTAMP '{_SPLIT}')
  THEN 'available' ELSE status END AS status FROM cars""")
def revert_cars(t):
    return _revert(t)[0]


@query(f"WITH {_CARS} SELECT {_SALES_COLUMNS} FROM sales WHERE sales_date < TIMESTAMP '{_SPLIT}'")
def revert_sales(t):
    return _revert(t)[1]


def _rename(t):
    """Cars in reserve get a negative number."""
    cars = _cars(t)
    mapping = cars.filter(F.col("status") == "reserve").select("vin", (-1 - F.col("vin")).alias("new_vin"))
    return inventory.rename_vin(cars, _sales(t), mapping)


@query(f"WITH {_CARS} SELECT CASE status WHEN 'reserve' THEN -1 - vin ELSE vin END AS vin, model, price, status FROM cars")
def rename_vin_cars(t):
    return _rename(t)[0]


@query(f"""
WITH {_CARS}
SELECT sales_number, CASE status WHEN 'reserve' THEN -1 - car_vin ELSE car_vin END AS car_vin,
  strftime(sales_date, '%Y-%m-%d %H:%M:%S') AS sales_date, cost::DOUBLE AS cost FROM sales LEFT JOIN cars ON vin = car_vin""")
def rename_vin_sales(t):
    return _rename(t)[1]


@query(f"""
WITH {_CARS}, first AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY car_vin ORDER BY sales_date, sales_number) AS rn
  FROM sales) WHERE rn = 1)
SELECT vin, price, status, c_name AS car_model_name, c_mktsegment AS car_model_brand,
  strftime(sales_date, '%Y-%m-%d %H:%M:%S') AS sales_date, cost::DOUBLE AS sales_cost
FROM cars JOIN customer ON c_custkey = model LEFT JOIN first ON car_vin = vin""")
def car_info(t):
    models = t.customer.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("brand"))
    return inventory.car_info(_cars(t), models, _sales(t))


# --- restaurants: twenty parts make a menu --------------------------------------------

def _places(t):
    """Of the parts of a restaurant, those over size 10 are pizzas and the others coffees;
    the smallest size names its type."""
    dish = F.struct(F.concat_ws(" ", "p_name", "p_partkey").alias("k"), F.floor("p_retailprice").cast("int").alias("v"))
    cappuccino = F.struct(F.lit(restaurants.CAPPUCCINO).alias("k"), F.col("p_size").alias("v"))
    pizza = F.col("p_size") > 10
    menu = t.part.groupBy(F.expr("p_partkey div 20").alias("place")).agg(
        F.map_from_entries(F.collect_list(F.when(pizza, dish))).alias("pizzas"),
        F.array_sort(F.collect_list(F.when(~pizza, dish))).alias("coffees"),
        F.max(cappuccino).alias("cappuccino"))
    coffees = F.map_from_entries(F.when(F.col("place") % 3 == 0, F.array("cappuccino")).otherwise(F.col("coffees")))
    return menu.select(
        "place", F.concat(F.lit("R"), F.col("place")).alias("name"),
        F.when(F.col("place") % 2 == 0, "pizzeria").otherwise("coffee_shop").alias("type"),
        F.to_json(F.map_from_arrays(F.array(F.lit(restaurants.PIZZA), F.lit(restaurants.COFFEE)), F.array("pizzas", coffees))).alias("menu"))


_DISHES = """
d AS (SELECT 'R' || (p_partkey // 20) AS restaurant_name, p_name || ' ' || p_partkey AS dish, floor(p_retailprice)::BIGINT AS price
  FROM part WHERE p_size > 10 AND (p_partkey // 20) % 2 = 0)"""


@query(f"WITH {_DISHES}, c AS (SELECT restaurant_name, count(*) AS pizza_count FROM d GROUP BY 1) "
       "SELECT * FROM c WHERE pizza_count = (SELECT max(pizza_count) FROM c)")
def largest_pizza_menus(t):
    return restaurants.largest_pizza_menus(_places(t))


@query(f"WITH {_DISHES} SELECT restaurant_name, dish, price FROM (SELECT *, row_number() OVER (PARTITION BY restaurant_name "
       "ORDER BY price DESC, dish) AS rn FROM d) WHERE rn = 1")
def priciest_pizza(t):
    return restaurants.priciest_pizza(_places(t))


@query("""
SELECT place, CASE WHEN place % 3 = 0 THEN round(size * CASE WHEN place % 2 = 1 THEN 120 ELSE 100 END) / 100 END::DOUBLE AS price,
  n AS dishes FROM (
  SELECT p_partkey // 20 AS place, max(p_size) AS size, CASE WHEN (p_partkey // 20) % 3 = 0 THEN 1 ELSE 0 END
    + count(*) FILTER (WHERE p_size > 10 OR (p_partkey // 20) % 3 <> 0) AS n FROM part GROUP BY 1)""")
def raise_price(t):
    """Price of the dish after the rise, and how many dishes the menu has."""
    menu = F.from_json("menu", "map<string,map<string,decimal(18,2)>>")
    price = F.try_element_at(F.try_element_at(menu, F.lit(restaurants.COFFEE)), F.lit(restaurants.CAPPUCCINO))
    dishes = F.aggregate(F.map_values(menu), F.lit(0), lambda n, m: n + F.size(m))
    return restaurants.raise_price(_places(t)).select("place", price.alias("price"), dishes.alias("dishes"))


@query(f"""
WITH m AS (SELECT l_suppkey, {sql_half_up('sum(round(l_extendedprice * 100)::HUGEINT)', 'count(*)', 100)} AS avg_check
  FROM lineitem GROUP BY 1)
SELECT restaurant_name, restaurant_type, avg_check FROM (
  SELECT s_name AS restaurant_name, 'T' || (s_nationkey % 4) AS restaurant_type, avg_check, row_number() OVER (
    PARTITION BY s_nationkey % 4 ORDER BY avg_check DESC, s_name) AS rn FROM m JOIN supplier ON s_suppkey = l_suppkey)
WHERE rn <= 3""")
def best_by_type(t):
    sales = t.lineitem.select(F.col("l_suppkey").alias("restaurant_uuid"), money(F.col("l_extendedprice")).alias("avg_check"))
    places = t.supplier.select(F.col("s_suppkey").alias("restaurant_uuid"), F.col("s_name").alias("name"),
                               F.concat(F.lit("T"), F.col("s_nationkey") % 4).alias("type"))
    return restaurants.best_by_type(sales, places)


# --- star -----------------------------------------------------------------------------

@query("""
SELECT sha256(s_name) AS craftsman_id, sha256(c_name) AS customer_id, l_orderkey AS order_id, l_extendedprice AS price
FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN supplier ON s_suppkey = l_suppkey JOIN customer ON c_custkey = o_custkey""")
def star_fact_rows(t):
    """A source in two tables, with names instead of ids."""
    lines = t.lineitem.select("l_suppkey", F.col("l_orderkey").alias("order_id"), F.col("l_extendedprice").alias("price"))
    sellers = t.supplier.select(F.col("s_suppkey").alias("l_suppkey"), F.col("s_name").alias("craftsman_name"))
    orders = t.orders.select("o_custkey", F.col("o_orderkey").alias("order_id"))
    buyers = t.customer.select(F.col("c_custkey").alias("o_custkey"), F.col("c_name").alias("customer_name"))
    wide = star.join_split(lines.join(sellers, "l_suppkey").drop("l_suppkey"), orders.join(buyers, "o_custkey").drop("o_custkey"),
                           ["order_id"])

    def dim(people, who):
        rows = people.select(f"{who}_name", _at("2020-01-01").alias("load_dttm"))
        return star.dimension_rows(rows, f"{who}_id", [f"{who}_name"], [], "load_dttm"), [f"{who}_name"]

    return star.fact_rows(wide, {"craftsman_id": dim(sellers, "craftsman"), "customer_id": dim(buyers, "customer")},
                          ["order_id", "price"])


# --- staged objects -------------------------------------------------------------------

def _staged(t, keep):
    """Two loads: the even events, then the odd ones, so that their times overlap."""
    rows = t.events.select("event_id", F.col("user_id").cast("string").alias("object_id"),
                           F.col("props").alias("object_value"), F.col("ts").alias("load_dttm"))
    first, second = (rows.filter(F.col("event_id") % 2 == k).drop("event_id") for k in (0, 1))
    return courier.stage_objects(courier.stage_objects(first.limit(0), first, keep), second, keep)


def _staged_sql(order: str, load: str) -> str:
    return f"""
SELECT object_id, object_value FROM (
  SELECT user_id::VARCHAR AS object_id, props AS object_value, row_number() OVER (
    PARTITION BY user_id ORDER BY event_id % 2 {load}, ts {order}, props) AS rn FROM events) WHERE rn = 1"""


@query(_staged_sql("", ""))
def stage_first(t):
    return _staged(t, "first").select("object_id", "object_value")


@query(_staged_sql("DESC", "DESC"))
def stage_latest(t):
    return _staged(t, "latest").select("object_id", "object_value")


@query("""
SELECT (l_orderkey * 10 + l_linenumber)::VARCHAR AS delivery_id, l_orderkey::VARCHAR AS order_id, l_suppkey::VARCHAR AS courier_id,
  strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS order_ts, l_linenumber::BIGINT AS rate, l_discount AS tip_sum FROM lineitem""")
def deliveries_from_objects(t):
    value = F.to_json(F.struct(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).cast("string").alias("delivery_id"),
        F.col("l_orderkey").cast("string").alias("order_id"), F.col("l_suppkey").cast("string").alias("courier_id"),
        F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss").alias("delivery_ts"), F.col("l_linenumber").alias("rate"),
        F.col("l_discount").cast("decimal(14,2)").alias("tip_sum")))
    return courier.deliveries_from(t.lineitem.select(F.lit("x").alias("object_id"), value.alias("object_value")))
