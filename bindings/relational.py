"""Joins, aggregations, windows, top-k."""

from __future__ import annotations

from pyspark.sql import functions as F

from martloom.functions.keys import hash_key
from martloom.functions.money import dec, money, ratio, sum_money
from martloom.functions.text import part_of
from martloom.operators import aggregates as agg
from martloom.operators import filters, joins, windows
from martloom.operators.nearest import city_rows, nearest
from martloom.operators.pairs import co_members
from martloom.operators.ranges import count_changes
from martloom.operators.skew import hot_keys, skew_join
from martloom.plans import dealership, inventory, restaurants

from .registry import CITY_CTE, LOCATED_SQL, PLACED_SQL, placed, query, sql_half_up, sql_haversine

PRICE = "l_extendedprice::DECIMAL(18,2)"


@query(f"""
SELECT p_type, s_nationkey::BIGINT AS s_nationkey, count(*) AS n_lines,
       sum({PRICE} * (1 - l_discount::DECIMAL(4,2)))::DOUBLE AS revenue
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
     JOIN supplier ON l_suppkey = s_suppkey
WHERE o_orderpriority <> '5-LOW' GROUP BY p_type, s_nationkey""")
def join_inner_star(t):
    lines = t.lineitem.select("l_orderkey", "l_partkey", "l_suppkey", (
        money(F.col("l_extendedprice")) * (1 - F.col("l_discount").cast("decimal(4,2)"))).alias("net"))
    orders = t.orders.filter(F.col("o_orderpriority") != "5-LOW").select(F.col("o_orderkey").alias("l_orderkey"))
    parts = t.part.select(F.col("p_partkey").alias("l_partkey"), "p_type")
    suppliers = t.supplier.select(F.col("s_suppkey").alias("l_suppkey"), "s_nationkey")
    kept = lines.join(orders, "l_orderkey", "left_semi")
    # Folded to one row per (part, supplier) before the dimensions are attached, so a
    # part or supplier with very many lines reaches the joins already summed up.
    folded = kept.groupBy("l_partkey", "l_suppkey").agg(F.count(F.lit(1)).alias("n"), sum_money(F.col("net"), 4).alias("net"))
    return (
        folded.join(parts, "l_partkey").join(suppliers, "l_suppkey")
        .groupBy("p_type", "s_nationkey")
        .agg(F.sum("n").alias("n_lines"), F.sum("net").alias("revenue"))
    )


@query("SELECT p_partkey, sha256(concat_ws('|', p_name, p_brand, p_type)) AS product_id FROM part")
def join_natural_key(t):
    natural = ["p_name", "p_brand", "p_type"]
    dim = t.part.select(*natural).distinct().withColumn("product_id", hash_key(*[F.col(c) for c in natural]))
    return joins.lookup_keys(t.part.select("p_partkey", *natural), dim, natural).select("p_partkey", "product_id")


@query("""
SELECT p_partkey, word, n FROM part JOIN (
  SELECT split_part(p_name, ' ', 1) AS word, count(*) AS n FROM part GROUP BY 1) ON split_part(p_name, ' ', 1) = word""")
def join_derived_key(t):
    word = part_of(F.col("p_name"), " ", 1).alias("word")
    sizes = t.part.groupBy(word).agg(F.count(F.lit(1)).alias("n"))
    return skew_join(t.part.select("p_partkey", word), sizes, "word").select("p_partkey", "word", "n")


@query("""
SELECT c_custkey, coalesce(n, 0) AS n_open FROM customer LEFT JOIN (
  SELECT o_custkey, count(*) AS n FROM orders WHERE o_orderstatus = 'P' GROUP BY o_custkey) ON c_custkey = o_custkey""")
def coalesce_left_join(t):
    n = t.orders.filter(F.col("o_orderstatus") == "P").groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.count(F.lit(1)).alias("n"))
    return t.customer.select("c_custkey").join(n, "c_custkey", "left").select(
        "c_custkey", F.coalesce("n", F.lit(0)).alias("n_open"))


@query("""
SELECT c_custkey, c_name FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey
  AND o_orderdate >= TIMESTAMP '1995-01-01' AND o_orderdate < TIMESTAMP '1996-01-01')""")
def anti_join(t):
    year = (F.col("o_orderdate") >= F.lit("1995-01-01").cast("timestamp_ntz")) & (
        F.col("o_orderdate") < F.lit("1996-01-01").cast("timestamp_ntz"))
    seen = t.orders.filter(year).select(F.col("o_custkey").alias("c_custkey"))
    return joins.anti_join(t.customer.select("c_custkey", "c_name"), seen, ["c_custkey"])


@query("SELECT n_nationkey::BIGINT AS n_nationkey, n_name FROM nation WHERE n_nationkey NOT IN "
       "(SELECT c_nationkey FROM customer WHERE c_acctbal < -900)")
def not_in_subquery(t):
    seen = t.customer.filter(F.col("c_acctbal") < -900).select(F.col("c_nationkey").alias("n_nationkey"))
    return joins.anti_join(t.nation.select("n_nationkey", "n_name"), seen, ["n_nationkey"], null_aware=True)


@query("""
SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IN (
  SELECT o_custkey FROM orders GROUP BY o_custkey ORDER BY min(o_orderdate), o_custkey LIMIT 10)""")
def semi_top_k(t):
    first = t.orders.groupBy("o_custkey").agg(F.min("o_orderdate").alias("since"))
    return joins.semi_top_k(t.orders.select("o_orderkey", "o_custkey"), first, "o_custkey", ["since", "o_custkey"], 10)


@query(f"WITH {LOCATED_SQL} SELECT event_id, zone_id, round(km, 3) AS km FROM located")
def geo_nearest(t):
    rows = nearest(placed(t.events).select("event_id", "lat", "lon"), city_rows())
    return rows.select("event_id", "zone_id", F.round("distance_km", 3).alias("km"))


@query(f"""
WITH {CITY_CTE}, {PLACED_SQL}
SELECT event_id, zone_id, round(km, 3) AS km FROM (
  SELECT event_id, zone_id, {sql_haversine('lat', 'lon', 'clat', 'clng')} AS km,
         row_number() OVER (PARTITION BY event_id ORDER BY {sql_haversine('lat', 'lon', 'clat', 'clng')}, id) AS rn
  FROM placed JOIN cities ON abs(lat - clat) < 1 AND abs(lon - clng) < 1) WHERE rn = 1""")
def geo_nearest_box(t):
    rows = nearest(placed(t.events).select("event_id", "lat", "lon"), city_rows(), box_deg=1.0)
    return rows.select("event_id", "zone_id", F.round("distance_km", 3).alias("km"))


def _shops(t):
    """Customers as a reference that grows with the data."""
    at = placed(t.customer.select(F.col("c_custkey").alias("event_id"), F.lit(None).alias("ts")))
    return at.select(F.col("event_id").cast("string").alias("zone_id"), "lat", F.col("lon").alias("lng"),
                     F.lit("UTC").alias("timezone"))


@query(f"""WITH {PLACED_SQL}, shops AS (
  SELECT c_custkey, -(10 + ((c_custkey * 7919) % 34000) / 1000.0) AS clat, 113 + ((c_custkey * 104729) % 41000) / 1000.0 AS clng FROM customer)
SELECT event_id, zone_id, round(km, 3) AS km FROM (
  SELECT event_id, c_custkey::VARCHAR AS zone_id, {sql_haversine('lat', 'lon', 'clat', 'clng')} AS km,
         row_number() OVER (PARTITION BY event_id ORDER BY {sql_haversine('lat', 'lon', 'clat', 'clng')}, c_custkey::VARCHAR) AS rn
  FROM placed CROSS JOIN shops) WHERE rn = 1""")
def geo_nearest_customer(t):
    """Each event's nearest customer."""
    rows = nearest(placed(t.events).select("event_id", "lat", "lon"), _shops(t))
    return rows.select("event_id", "zone_id", F.round("distance_km", 3).alias("km"))


@query(f"""WITH {PLACED_SQL}, shops AS (
  SELECT c_custkey, -(10 + ((c_custkey * 7919) % 34000) / 1000.0) AS clat, 113 + ((c_custkey * 104729) % 41000) / 1000.0 AS clng FROM customer)
SELECT event_id, zone_id, round(km, 3) AS km FROM (
  SELECT event_id, c_custkey::VARCHAR AS zone_id, {sql_haversine('lat', 'lon', 'clat', 'clng')} AS km,
         row_number() OVER (PARTITION BY event_id ORDER BY {sql_haversine('lat', 'lon', 'clat', 'clng')}, c_custkey::VARCHAR) AS rn
  FROM placed JOIN shops ON abs(lat - clat) < 0.5 AND abs(lon - clng) < 0.5) WHERE rn = 1""")
def geo_nearest_customer_box(t):
    """Each event's nearest customer less than half a degree away both ways; events without one go."""
    rows = nearest(placed(t.events).select("event_id", "lat", "lon"), _shops(t), box_deg=0.5)
    return rows.select("event_id", "zone_id", F.round("distance_km", 3).alias("km"))


@query("""
SELECT DISTINCT a.l_partkey AS part_left, b.l_partkey AS part_right FROM lineitem a JOIN lineitem b
  ON a.l_orderkey = b.l_orderkey AND a.l_partkey < b.l_partkey""")
def co_member_pairs(t):
    return co_members(t.lineitem, ["l_orderkey"], "l_partkey", "part_left", "part_right")


@query("""
SELECT o_orderkey, coalesce(q, 0)::DOUBLE AS quantity FROM orders LEFT JOIN (
  SELECT l_orderkey, sum(l_quantity::DECIMAL(18,2)) AS q FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey""")
def preaggregate_join(t):
    lines = t.lineitem.select(F.col("l_orderkey").alias("o_orderkey"), money(F.col("l_quantity")).alias("q"))
    return joins.sum_then_join(t.orders.select("o_orderkey"), lines, "o_orderkey", "q", "quantity")


@query("""
SELECT o_orderkey, c_name, c_mktsegment, f.l_shipdate::DATE::VARCHAR AS first_ship, f.l_extendedprice AS first_price
FROM orders JOIN customer ON o_custkey = c_custkey LEFT JOIN (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey
    ORDER BY l_shipdate, l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS rn FROM lineitem) WHERE rn = 1
) f ON f.l_orderkey = o_orderkey""")
def entity_full_info(t):
    cars = t.orders.select("o_orderkey", F.col("o_custkey").alias("c_custkey"))
    named = skew_join(cars, t.customer.select("c_custkey", "c_name", "c_mktsegment"), "c_custkey", "inner",
                      hot_keys(t.orders.withColumnRenamed("o_custkey", "c_custkey"), "c_custkey"))
    lines = t.lineitem.select(
        F.col("l_orderkey").alias("o_orderkey"), "l_shipdate", "l_linenumber", "l_partkey", "l_suppkey",
        F.to_date("l_shipdate").alias("first_ship"), F.col("l_extendedprice").alias("first_price"))
    order = ["l_shipdate", "l_linenumber", "l_partkey", "l_suppkey", "first_price"]
    return joins.first_match(named, lines, "o_orderkey", order, ["first_ship", "first_price"]).drop("c_custkey")


@query("""
SELECT c_custkey, coalesce(p, 'unknown') AS name FROM customer LEFT JOIN (
  SELECT o_custkey, o_orderpriority AS p, row_number() OVER (PARTITION BY o_custkey
    ORDER BY o_orderdate DESC, o_orderpriority DESC) AS rn FROM orders) s
  ON o_custkey = c_custkey AND rn = 1""")
def latest_satellite(t):
    versions = t.orders.select(
        F.col("o_custkey").alias("c_custkey"), F.col("o_orderpriority").alias("name"), F.col("o_orderdate").alias("load_dt"))
    return joins.latest_name(t.customer.select("c_custkey"), versions, "c_custkey", "name", "load_dt")


@query("SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IN "
       "(SELECT o_custkey FROM orders WHERE o_orderdate > TIMESTAMP '2001-06-01')")
def affected_keys(t):
    changed = filters.changed_since(t.orders, ["o_orderdate"], "2001-06-01").select("o_custkey")
    return joins.affected(t.orders.select("o_orderkey", "o_custkey"), changed, ["o_custkey"])


# --- aggregations ---------------------------------------------------------------

@query(f"""
SELECT l_returnflag, l_linestatus, sum(l_quantity::DECIMAL(18,2))::DOUBLE AS sum_qty, sum({PRICE})::DOUBLE AS sum_price,
  sum({PRICE} * (1 - l_discount::DECIMAL(4,2)))::DOUBLE AS sum_net, min(l_quantity) AS min_qty, max(l_quantity) AS max_qty,
  sum({PRICE})::DOUBLE / count(*) AS avg_price, count(*) AS n FROM lineitem GROUP BY 1, 2""")
def agg_basic(t):
    price, disc = money(F.col("l_extendedprice")), F.col("l_discount").cast("decimal(4,2)")
    n = F.count(F.lit(1))
    return t.lineitem.groupBy("l_returnflag", "l_linestatus").agg(
        sum_money(F.col("l_quantity")).alias("sum_qty"), sum_money(F.col("l_extendedprice")).alias("sum_price"),
        sum_money(price * (1 - disc), 4).alias("sum_net"), F.min("l_quantity").alias("min_qty"),
        F.max("l_quantity").alias("max_qty"), ratio(sum_money(F.col("l_extendedprice")), n).alias("avg_price"), n.alias("n"))


def _car_sales(t):
    """Lines as car sales: part = model, brand = brand, discount in percent."""
    sales = t.lineitem.select(
        F.col("l_partkey").alias("model_id"), F.col("l_orderkey"), money(F.col("l_extendedprice")).alias("price"),
        (F.col("l_discount").cast("decimal(4,2)") * 100).alias("discount"), F.to_date("l_shipdate").alias("sale_date"))
    models = t.part.select(F.col("p_partkey").alias("model_id"), F.col("p_brand").alias("brand_id"),
                           F.col("p_type").alias("model_name"))
    brands = t.part.select(F.col("p_brand").alias("brand_id"), F.col("p_brand").alias("brand_name")).distinct()
    return sales, models, brands


_NET = "round(l_extendedprice * 100)::HUGEINT * (100 - round(l_discount * 100)::HUGEINT)"


@query(f"""
SELECT p_brand AS brand_name, year(l_shipdate) AS year, {sql_half_up(f'sum({_NET})', 'count(*) * 100', 100)} AS price_avg
FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2""")
def agg_year_brand(t):
    return dealership.price_by_brand_year(*_car_sales(t))


@query(f"""
SELECT month(l_shipdate) AS month, year(l_shipdate) AS year, {sql_half_up(f'sum({_NET})', 'count(*) * 100', 100)} AS price_avg
FROM lineitem WHERE year(l_shipdate) = 1997 GROUP BY 1, 2""")
def agg_month(t):
    return dealership.price_by_month(_car_sales(t)[0], 1997)


@query(f"""
SELECT {sql_half_up("10000 * count(*) FILTER (WHERE event_type = 'error')", "count(*)", 100)}
  AS nulls_percentage_gasoline_consumption FROM events""")
def null_percentage(t):
    rows = t.events.select(F.nullif(F.col("event_type"), F.lit("error")).alias("gasoline_consumption"))
    return dealership.missing_consumption(rows)


@query("""
SELECT o_orderpriority, sum(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END)::BIGINT AS done,
  sum(CASE WHEN o_orderstatus = 'O' THEN 1 ELSE 0 END)::BIGINT AS in_progress,
  sum(CASE WHEN o_orderstatus <> 'F' THEN o_totalprice::DECIMAL(18,2) ELSE 0 END)::DOUBLE AS open_amount
FROM orders GROUP BY 1""")
def status_counts(t):
    status = F.col("o_orderstatus")
    return t.orders.groupBy("o_orderpriority").agg(
        agg.sum_if(status == "F", F.lit(1)).alias("done"), agg.sum_if(status == "O", F.lit(1)).alias("in_progress"),
        agg.sum_if(status != "F", money(F.col("o_totalprice")), dec("0.00")).alias("open_amount"))


@query("""
SELECT ts::DATE::VARCHAR AS day, count(*) FILTER (WHERE event_type = 'purchase') AS purchases,
  count(*) FILTER (WHERE event_type = 'click') AS clicks, count(*) FILTER (WHERE event_type = 'signup') AS signups
FROM events GROUP BY 1""")
def event_type_pivot(t):
    kind = F.col("event_type")
    return t.events.groupBy(F.to_date("ts").alias("day")).agg(
        agg.count_if(kind == "purchase").alias("purchases"), agg.count_if(kind == "click").alias("clicks"),
        agg.count_if(kind == "signup").alias("signups"))


@query("SELECT strftime(o_orderdate, '%Y-%m') AS period, count(DISTINCT o_custkey) AS buyers FROM orders GROUP BY 1")
def distinct_buyers(t):
    return agg.by_period(t.orders, "o_orderdate").groupBy("period").agg(F.count_distinct("o_custkey").alias("buyers"))


@query("SELECT o_orderpriority, count(*)::DOUBLE / count(DISTINCT o_custkey) AS per_account FROM orders GROUP BY 1")
def per_account_ratio(t):
    return t.orders.groupBy("o_orderpriority").agg(
        ratio(F.count(F.lit(1)), F.count_distinct("o_custkey")).alias("per_account"))


@query("""
SELECT l_returnflag, l_linestatus, median(round(l_extendedprice * 100)::BIGINT)::DOUBLE AS median_cents
FROM lineitem GROUP BY ALL""")
def median_price(t):
    """Few groups of very many different prices: the middle is found by counts over ranges."""
    cents = F.round(F.col("l_extendedprice") * 100).cast("bigint").alias("cents")
    return agg.median_over_ranges(t.lineitem.select("l_returnflag", "l_linestatus", cents), ["l_returnflag", "l_linestatus"],
                                         "cents", "median_cents")


@query("""
WITH v AS (SELECT l_returnflag, l_suppkey::VARCHAR AS s, row_number() OVER (PARTITION BY l_returnflag ORDER BY l_suppkey::VARCHAR) AS n
  FROM (SELECT DISTINCT l_returnflag, l_suppkey FROM lineitem))
SELECT l_returnflag, (n - 1) // 50 AS chunk, string_agg(s, ', ' ORDER BY s) AS suppliers FROM v GROUP BY ALL""")
def string_agg_in_chunks(t):
    """All suppliers of each return flag, fifty to a text."""
    rows = t.lineitem.select("l_returnflag", F.col("l_suppkey").cast("string").alias("s"))
    return agg.string_agg_chunks(rows, ["l_returnflag"], "s", "suppliers", 50)


@query("""
SELECT o_orderpriority, median(date_diff('day', o_orderdate::DATE, l_shipdate::DATE))::DOUBLE AS median
FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY 1""")
def median_days(t):
    orders = t.orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_orderdate", "o_orderpriority")
    lines = t.lineitem.select("l_orderkey", "l_shipdate").join(orders, "l_orderkey")
    days = lines.select("o_orderpriority", F.datediff("l_shipdate", "o_orderdate").alias("days"))
    return agg.median_by(days, ["o_orderpriority"], "days")


@query("""
SELECT person, string_agg(car, ', ' ORDER BY car) AS cars FROM (
  SELECT DISTINCT c_name AS person, p_brand || ' ' || p_type AS car FROM lineitem JOIN orders ON l_orderkey = o_orderkey
    JOIN customer ON o_custkey = c_custkey JOIN part ON l_partkey = p_partkey) GROUP BY person""")
def string_agg(t):
    sales, models, brands = _car_sales(t)
    buyers = t.orders.select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("customer_id"))
    bought = sales.select("l_orderkey", "model_id").join(buyers, "l_orderkey")
    customers = t.customer.select(F.col("c_custkey").alias("customer_id"), F.col("c_name").alias("name"))
    return dealership.cars_of_person(bought, customers, models, brands)


@query("""
SELECT user_id, string_agg(event_type, ',' ORDER BY event_type) AS kinds FROM (
  SELECT DISTINCT user_id, event_type FROM events) GROUP BY 1""")
def visited_set(t):
    rows = t.events.groupBy("user_id").agg(agg.set_of("event_type").alias("kinds"))
    return rows.select("user_id", F.array_join("kinds", ",").alias("kinds"))


@query("SELECT o_custkey, max(o_orderpriority) AS priority FROM orders GROUP BY 1")
def dim_max_attr(t):
    return t.orders.groupBy("o_custkey").agg(F.max("o_orderpriority").alias("priority"))


@query("SELECT o_custkey, count(o_orderkey) - 1 AS changes FROM orders GROUP BY 1")
def change_count(t):
    return agg.changes(t.orders, ["o_custkey"], "o_orderkey")


@query("""
SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, l_partkey, l_suppkey FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
    ORDER BY l_shipdate, l_partkey, l_suppkey) AS rn FROM lineitem) WHERE rn = 1""")
def dedup_first(t):
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate")
    return agg.dedup_first(rows, ["l_orderkey", "l_linenumber"], ["l_shipdate", "l_partkey", "l_suppkey"]).drop("l_shipdate")


@query("SELECT DISTINCT ON (o_custkey) o_custkey, o_orderkey, o_orderstatus FROM orders "
       "ORDER BY o_custkey, o_orderdate, o_orderkey")
def distinct_on(t):
    rows = t.orders.select("o_custkey", "o_orderkey", "o_orderstatus", "o_orderdate")
    return agg.distinct_on(rows, ["o_custkey"], ["o_orderdate", "o_orderkey"]).drop("o_orderdate")


@query("""
SELECT o_custkey, o_orderpriority, min(o_orderdate)::DATE::VARCHAR AS first_date, max(o_orderdate)::DATE::VARCHAR AS last_date
FROM orders GROUP BY 1, 2""")
def date_span(t):
    rows = t.orders.select("o_custkey", "o_orderpriority", F.to_date("o_orderdate").alias("day"))
    return agg.span(rows, ["o_custkey", "o_orderpriority"], "day")


@query("""
SELECT p_brand AS brand, count(*) AS sales_number, lower(p_brand) AS car_model_name
FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY p_brand
ORDER BY count(*) DESC, min((l_shipdate, l_orderkey)), p_brand LIMIT 3""")
def top_models(t):
    sales = t.lineitem.select(F.col("l_orderkey").alias("sales_number"), F.col("l_partkey").alias("car_vin"),
                              F.col("l_shipdate").alias("sales_date"))
    cars = t.part.select(F.col("p_partkey").alias("vin"), F.col("p_brand").alias("model"))
    models = t.part.select(F.col("p_brand").alias("id"), F.lower("p_brand").alias("name"),
                           F.col("p_brand").alias("brand")).distinct()
    return inventory.top_models(sales, cars, models, 3).select("brand", "sales_number", "car_model_name")


@query("SELECT l_suppkey, l_returnflag, max(l_linestatus) AS label, count(*) AS n FROM lineitem GROUP BY 1, 2")
def counters_merge(t):
    def counted(rows):
        return rows.groupBy("l_suppkey", "l_returnflag").agg(
            F.max("l_linestatus").alias("label"), F.count(F.lit(1)).alias("n"))

    split = F.lit("1999-01-01").cast("timestamp_ntz")
    early, late = t.lineitem.filter(F.col("l_shipdate") < split), t.lineitem.filter(F.col("l_shipdate") >= split)
    names = t.lineitem.groupBy("l_suppkey", "l_returnflag").agg(F.max("l_linestatus").alias("label"))
    newest = counted(late).drop("label").join(names, ["l_suppkey", "l_returnflag"])
    return agg.add_counts(counted(early), newest, ["l_suppkey", "l_returnflag"], "n", ["label"])


# --- windows and top-k ------------------------------------------------------------

@query(f"""
SELECT s_nationkey::BIGINT AS s_nationkey, s_name, revenue::DOUBLE AS revenue FROM (
  SELECT s_nationkey, s_name, revenue, row_number() OVER (PARTITION BY s_nationkey ORDER BY revenue DESC, s_name) AS rn
  FROM (SELECT l_suppkey, sum({PRICE}) AS revenue FROM lineitem GROUP BY 1) JOIN supplier ON l_suppkey = s_suppkey)
WHERE rn <= 3""")
def top3_per_group(t):
    revenue = t.lineitem.groupBy(F.col("l_suppkey").alias("s_suppkey")).agg(sum_money(F.col("l_extendedprice")).alias("revenue"))
    rows = revenue.join(t.supplier.select("s_suppkey", "s_name", "s_nationkey"), "s_suppkey").drop("s_suppkey")
    return windows.top_n(rows, ["s_nationkey"], [F.col("revenue").desc(), F.col("s_name")], 3)


@query("""
SELECT p_type, p_name, n FROM (SELECT p_type, p_name, count(*) AS n,
  row_number() OVER (PARTITION BY p_type ORDER BY count(*) DESC, p_name) AS rn FROM part GROUP BY 1, 2) WHERE rn = 1""")
def top1_per_group(t):
    counts = t.part.groupBy("p_type", "p_name").agg(F.count(F.lit(1)).alias("n"))
    return windows.top_n(counts, ["p_type"], [F.col("n").desc(), F.col("p_name")], 1)


@query("""
SELECT user_id, event_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC)
  AS rn FROM events) WHERE rn = 1""")
def latest_event(t):
    rows = t.events.select("user_id", "event_id", "event_type", "ts")
    return windows.latest(rows, ["user_id"], ["ts", "event_id"]).drop("ts")


@query("""
SELECT event_id, user_id, (row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) = 1)::BIGINT AS is_registration
FROM events""")
def first_event_flag(t):
    rows = t.events.select("event_id", "user_id", "ts")
    return windows.flag_first(rows, "user_id", "event_id", ["ts", "event_id"], "is_registration").drop("ts")


@query("""
SELECT l_suppkey, p_type, n FROM (SELECT l_suppkey, p_type, count(*) AS n,
  rank() OVER (PARTITION BY l_suppkey ORDER BY count(*) DESC) AS rk
  FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2) WHERE rk = 1""")
def rank_ties(t):
    folded = t.lineitem.groupBy("l_suppkey", F.col("l_partkey").alias("p_partkey")).agg(F.count(F.lit(1)).alias("n"))
    counts = folded.join(t.part.select("p_partkey", "p_type"), "p_partkey").groupBy("l_suppkey", "p_type").agg(
        F.sum("n").alias("n"))
    return windows.rank_top(counts, ["l_suppkey"], [F.col("n").desc()], 1)


@query("""
SELECT l_suppkey, n FROM (SELECT l_suppkey, count(DISTINCT l_partkey) AS n,
  dense_rank() OVER (ORDER BY count(DISTINCT l_partkey) DESC) AS rk FROM lineitem GROUP BY 1) WHERE rk = 1""")
def dense_rank_top(t):
    counts = t.lineitem.groupBy("l_suppkey").agg(F.count_distinct("l_partkey").alias("n"))
    return windows.best_overall(counts, "n")


@query(f"""
WITH y AS (SELECT o_orderpriority, year(o_orderdate) AS year,
  (2 * sum(round(o_totalprice * 100)::HUGEINT) + count(*)) // (2 * count(*)) AS cents FROM orders GROUP BY 1, 2),
l AS (SELECT *, lag(cents) OVER (PARTITION BY o_orderpriority ORDER BY year) AS prev FROM y)
SELECT o_orderpriority AS restaurant_name, 'P' AS restaurant_type, year, cents::DOUBLE / 100 AS current_avg_check,
  prev::DOUBLE / 100 AS prev_avg_check, {sql_half_up('(cents - prev) * 10000', 'prev', 100)} AS change_percent FROM l""")
def yoy_change(t):
    sales = t.orders.select(F.col("o_orderpriority").alias("restaurant_uuid"), F.to_date("o_orderdate").alias("date"),
                            money(F.col("o_totalprice")).alias("avg_check"))
    places = t.orders.select(F.col("o_orderpriority").alias("restaurant_uuid"), F.col("o_orderpriority").alias("name"),
                             F.lit("P").alias("type")).distinct()
    return restaurants.check_dynamics(sales, places)


@query(f"""
WITH {LOCATED_SQL}
SELECT user_id, sum(CASE WHEN zone_id <> prev THEN 1 ELSE 0 END)::BIGINT AS travel_count FROM (
  SELECT user_id, zone_id, lag(zone_id) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prev FROM located) GROUP BY 1""")
def travel_count(t):
    rows = nearest(placed(t.events).select("event_id", "user_id", "ts", "lat", "lon"), city_rows())
    return count_changes(rows, ["user_id"], ["ts", "event_id"], "zone_id", "travel_count")


@query("""
SELECT event_id, user_id, coalesce(event_type <> lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id), false)::BIGINT
  AS is_change FROM events""")
def change_flags(t):
    rows = t.events.select("event_id", "user_id", "ts", "event_type")
    return windows.flag_change(rows, ["user_id"], ["ts", "event_id"], "event_type").select("event_id", "user_id", "is_change")


_ISLANDS = """
d AS (SELECT DISTINCT user_id, {state} AS state, ts::DATE AS day FROM {src}),
r AS (SELECT *, day - (row_number() OVER (PARTITION BY user_id, state ORDER BY day))::INTEGER AS run FROM d),
i AS (SELECT user_id, state, count(*) AS days, min(day) AS start_date, max(day) AS end_date FROM r GROUP BY user_id, state, run)"""


@query("WITH " + _ISLANDS.format(state="event_type", src="events") + """
SELECT user_id, state AS event_type, days, start_date::VARCHAR AS start_date, end_date::VARCHAR AS end_date FROM i""")
def islands_days(t):
    return windows.islands(t.events, ["user_id", "event_type"], "ts")


@query(f"WITH {LOCATED_SQL}, " + _ISLANDS.format(state="zone_id", src="located") + """
SELECT user_id, state AS zone_id, days, start_date::VARCHAR AS start_date, end_date::VARCHAR AS end_date FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY end_date DESC, days DESC, state) AS rn FROM i WHERE days >= 2)
WHERE rn = 1""")
def home_city(t):
    rows = nearest(placed(t.events).select("event_id", "user_id", "ts", "lat", "lon"), city_rows())
    return windows.home_state(rows, "user_id", "zone_id", "ts", 2)


@query("SELECT s_suppkey, s_name, row_number() OVER (ORDER BY s_name, s_suppkey) + 99 AS number FROM supplier")
def numbered_rows(t):
    return windows.number_rows(t.supplier.select("s_suppkey", "s_name"), ["s_name", "s_suppkey"], 100)


@query("""
SELECT s_suppkey, '8-800-2500-' || (row_number() OVER (ORDER BY s_name, sha256(s_suppkey::VARCHAR)) + 99) || ',+7-' || s_nationkey
  AS phones FROM supplier""")
def array_pair(t):
    managers = t.supplier.select("s_suppkey", hash_key(F.col("s_suppkey")).alias("manager_uuid"), F.col("s_name").alias("name"),
                                 F.concat(F.lit("+7-"), F.col("s_nationkey")).alias("phone"))
    evolved = restaurants.evolve_phones(managers)
    return evolved.select("s_suppkey", F.array_join("phone_numbers", ",").alias("phones"))
