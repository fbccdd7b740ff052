"""Data marts."""

from __future__ import annotations

from pyspark.sql import functions as F

from martloom.functions.keys import hash_key
from martloom.functions.money import money
from martloom.operators.nearest import city_rows, nearest
from martloom.operators.skew import skew_join
from martloom.functions.geo import CITIES
from martloom.plans import conversion, counters, currency, geography, report_store, reports, sales
from martloom.plans import ledger as courier
from martloom.plans.star import unify_sources as unify
from martloom.session import checkpointed

from .registry import AS_OF, CITY_CTE, LOCATED_SQL, placed, query, sql_half_up, sql_haversine
from .streams import _root


# --- craft market reports -------------------------------------------------------

def _market(t):
    """Order lines as a craft market: (fact, customers, craftsmen, products)."""
    status = F.when(F.col("o_orderstatus") == "F", "done").when(F.col("o_orderstatus") == "O", "in progress").otherwise("delivery")
    orders = t.orders.select(
        F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("customer_id"),
        F.to_date("o_orderdate").alias("order_created_date"), status.alias("order_status"),
        F.col("o_orderdate").alias("load_dttm"))
    lines = t.lineitem.select(
        F.col("l_orderkey").alias("order_id"), F.col("l_partkey").alias("product_id"),
        F.col("l_suppkey").alias("craftsman_id"), F.to_date("l_shipdate").alias("_shipped"))
    # An order in delivery has no completion date yet.
    fact = lines.join(orders, "order_id").withColumn(
        "order_completion_date", F.when(F.col("order_status") != "delivery", F.col("_shipped"))).drop("_shipped")

    def people(df, key, name, nation, who, step):
        k = F.col(key)
        return df.select(
            k.alias(f"{who}_id"), F.col(name).alias(f"{who}_name"),
            F.concat(F.lit("Nation "), F.col(nation)).alias(f"{who}_address"),
            F.date_add(F.lit("1950-01-01").cast("date"), (k * step % 18000).cast("int")).alias(f"{who}_birthday"),
            F.concat(F.lower(name), F.lit("@example.com")).alias(f"{who}_email"),
            F.lit("1995-01-01").cast("timestamp_ntz").alias("load_dttm"))

    customers = people(t.customer, "c_custkey", "c_name", "c_nationkey", "customer", 37)
    craftsmen = people(t.supplier, "s_suppkey", "s_name", "s_nationkey", "craftsman", 41)
    products = t.part.select(
        F.col("p_partkey").alias("product_id"), F.col("p_name").alias("product_name"),
        F.col("p_brand").alias("product_description"), F.col("p_type").alias("product_type"),
        money(F.col("p_retailprice")).alias("product_price"), F.lit("1995-01-01").cast("timestamp_ntz").alias("load_dttm"))
    return fact, customers, craftsmen, products


def _market_sql(owner, okey, ocol, oname, onation, otable, ostep, pcol, ptable, pkey, pstep, partner, with_partner):
    age = (f"date_part('year', age(TIMESTAMP '{AS_OF}', (DATE '1950-01-01' + (({pkey} * {pstep}) % 18000)::INTEGER)"
           "::TIMESTAMP))::BIGINT")
    top_partner = f", tp.partner AS top_{partner}_id" if with_partner else ""
    join_partner = "JOIN tp ON tp.owner = m.owner AND tp.rn = 1" if with_partner else ""
    return f"""
WITH f AS (
  SELECT {ocol} AS owner, {pcol} AS partner, l_partkey, o_orderkey, strftime(o_orderdate, '%Y-%m') AS report_period,
    o_orderstatus AS st, {age} AS age, round(p_retailprice * 100)::BIGINT AS cents, p_type,
    CASE WHEN o_orderstatus IN ('F', 'O') THEN date_diff('day', o_orderdate::DATE, l_shipdate::DATE) END AS days
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey JOIN {ptable} ON {pcol} = {pkey}),
m AS (
  SELECT owner, report_period, sum(cents) AS cents, count(*) AS n, sum(age) AS ages, median(days)::DOUBLE AS med,
    count(*) FILTER (WHERE st = 'O') AS p, count(*) FILTER (WHERE st = 'F') AS d,
    count(*) FILTER (WHERE st NOT IN ('F', 'O')) AS v FROM f GROUP BY 1, 2),
tc AS (SELECT owner, p_type, row_number() OVER (PARTITION BY owner ORDER BY count(*) DESC, p_type) AS rn FROM f GROUP BY 1, 2),
tp AS (SELECT owner, partner, row_number() OVER (PARTITION BY owner ORDER BY count(*) DESC, partner) AS rn FROM f GROUP BY 1, 2)
SELECT m.owner AS {owner}_id, {oname} AS {owner}_name, 'Nation ' || {onation} AS {owner}_address,
  (DATE '1950-01-01' + (({okey} * {ostep}) % 18000)::INTEGER)::VARCHAR AS {owner}_birthday,
  lower({oname}) || '@example.com' AS {owner}_email, report_period,
  {sql_half_up('cents * 9', '10', 100)} AS {owner}_money, {sql_half_up('cents', '10', 100)} AS platform_money,
  n AS count_order, {sql_half_up('cents', 'n', 100)} AS avg_price_order,
  {sql_half_up('ages * 100', 'n', 100)} AS avg_age_{partner}, med AS median_time_order_completed,
  tc.p_type AS top_product_category{top_partner},
  0::BIGINT AS count_order_created, p AS count_order_in_progress, v AS count_order_delivery, d AS count_order_done,
  p + v AS count_order_not_done
FROM m JOIN tc ON tc.owner = m.owner AND tc.rn = 1 {join_partner} JOIN {otable} ON {okey} = m.owner"""


CUSTOMER_SQL = _market_sql("customer", "c_custkey", "o_custkey", "c_name", "c_nationkey", "customer", 37,
                           "l_suppkey", "supplier", "s_suppkey", 41, "craftsman", True)
CRAFTSMAN_SQL = _market_sql("craftsman", "s_suppkey", "l_suppkey", "s_name", "s_nationkey", "supplier", 41,
                            "o_custkey", "customer", "c_custkey", 37, "customer", False)


@query(CUSTOMER_SQL)
def monthly_report(t):
    fact, customers, craftsmen, products = _market(t)
    return reports.customer_report(fact, customers, craftsmen, products, AS_OF)


@query(CRAFTSMAN_SQL)
def supplier_report(t):
    fact, customers, craftsmen, products = _market(t)
    return reports.craftsman_report(fact, customers, craftsmen, products, AS_OF)


@query(CUSTOMER_SQL)
def monthly_report_incremental(t):
    fact, customers, craftsmen, products = _market(t)
    mark = "2001-06-01"
    before = fact.filter(F.col("load_dttm") <= F.lit(mark).cast("timestamp_ntz"))
    mart = reports.customer_report(before, customers, craftsmen, products, AS_OF)
    return reports.refresh_report(mart, reports.customer_report, fact, customers, craftsmen, products,
                                  "customer_id", mark, AS_OF)


@query(CUSTOMER_SQL)
def monthly_report_stored(t):
    """The stored fact table and report up to a day, then the lines after it: only the parts
    of their customers are read and replaced."""
    fact, customers, craftsmen, products = _market(t)
    mark, parts, root = "2001-07-15", 32, _root(t)
    late = F.col("load_dttm") > F.lit(mark).cast("timestamp_ntz")
    fact = checkpointed(fact)
    report_store.store_facts(fact.filter(~late), f"{root}/fact", "customer_id", parts)
    before = reports.customer_report(fact.filter(~late), customers, craftsmen, products, AS_OF)
    report_store.store_report(before, f"{root}/mart", "customer_id", parts)
    report_store.append_facts(fact.filter(late), f"{root}/fact", "customer_id", parts)
    report_store.refresh_stored(t.spark, f"{root}/fact", f"{root}/mart", reports.customer_report, customers, craftsmen,
                                products, "customer_id", mark, AS_OF, parts)
    return t.spark.read.parquet(f"{root}/mart").drop("part")


# --- sources and sales ------------------------------------------------------------

@query("SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber::BIGINT AS l_linenumber, l_extendedprice AS price, "
       "CASE l_returnflag WHEN 'R' THEN 'returned' WHEN 'A' THEN NULL ELSE l_linestatus END AS note, "
       "CASE l_returnflag WHEN 'R' THEN 'third' WHEN 'A' THEN 'second' ELSE "
       "CASE l_linestatus WHEN 'O' THEN 'first' ELSE 'external' END END AS source FROM lineitem")
def unify_sources(t):
    """Four delivery feeds with different columns and names back to one table."""
    flag, status = F.col("l_returnflag"), F.col("l_linestatus")
    keys = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]
    price = F.col("l_extendedprice").alias("price")
    first = t.lineitem.filter((flag == "N") & (status == "O")).select(*keys, price, status.alias("note"))
    second = t.lineitem.filter(flag == "A").select(price, *reversed(keys))
    third = t.lineitem.filter(flag == "R").select(F.lit("returned").alias("note"), *keys, price)
    external = t.lineitem.filter((flag == "N") & (status != "O")).select(status.alias("note"), price, *keys)
    named = [df.withColumn("source", F.lit(n)) for df, n in
             ((first, "first"), (second, "second"), (third, "third"), (external, "external"))]
    return unify(named, [*keys, "price", "note", "source"])


def _sales_log(t):
    status = F.when(F.col("l_returnflag") == "R", "refunded").when(F.col("l_returnflag") == "A", "shipped")
    lines = t.lineitem.select(
        F.col("l_orderkey"), F.col("l_shipdate").alias("date_time"), F.col("l_partkey").alias("item_id"),
        F.col("l_suppkey").alias("city_id"), F.col("l_quantity").cast("bigint").alias("quantity"),
        money(F.col("l_extendedprice")).alias("payment_amount"), status.alias("status"))
    buyers = t.orders.select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("customer_id"))
    return lines.join(buyers, "l_orderkey").drop("l_orderkey")


_SALES = """
s AS (SELECT strftime(l_shipdate, '%Y%m%d')::BIGINT AS date_id, l_shipdate::DATE AS day, l_partkey AS item_id,
  o_custkey AS customer_id, l_suppkey AS city_id, l_quantity::BIGINT AS quantity,
  CASE WHEN l_returnflag = 'R' THEN -l_extendedprice::DECIMAL(18,2) ELSE l_extendedprice::DECIMAL(18,2) END AS payment_amount,
  CASE WHEN l_returnflag = 'R' THEN 'refunded' ELSE 'shipped' END AS status
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""


@query(f"WITH {_SALES} SELECT date_id, item_id, customer_id, city_id, quantity, payment_amount::DOUBLE AS payment_amount, "
       "status FROM s")
def signed_sales(t):
    return sales.sales_fact(_sales_log(t))


def _retention_sql(where: str) -> str:
    return f"""
WITH {_SALES}, w AS (
  SELECT date_trunc('week', day)::DATE AS period_start, item_id, customer_id, status, sum(payment_amount) AS rev, count(*) AS n
  FROM s WHERE {where} GROUP BY 1, 2, 3, 4)
SELECT period_start::VARCHAR AS period_start, item_id,
  count(DISTINCT CASE WHEN n = 1 AND status <> 'refunded' THEN customer_id END) AS new_customers_count,
  count(DISTINCT CASE WHEN n > 1 AND status <> 'refunded' THEN customer_id END) AS returning_customers_count,
  count(DISTINCT CASE WHEN status = 'refunded' THEN customer_id END) AS refunded_customer_count,
  sum(CASE WHEN n = 1 AND status <> 'refunded' THEN rev ELSE 0 END)::DOUBLE AS new_customers_revenue,
  sum(CASE WHEN n > 1 AND status <> 'refunded' THEN rev ELSE 0 END)::DOUBLE AS returning_customers_revenue,
  sum(CASE WHEN status = 'refunded' THEN rev ELSE 0 END)::DOUBLE AS customers_refunded,
  week(period_start) AS period_id, 'weekly' AS period_name
FROM w GROUP BY period_start, item_id"""


@query(_retention_sql("true"))
def retention_weekly(t):
    return sales.retention(sales.sales_fact(_sales_log(t)))


@query(_retention_sql("day BETWEEN DATE '1998-06-03' - INTERVAL 6 DAY AND DATE '1998-06-03'"))
def retention_trailing(t):
    return sales.retention(sales.sales_fact(_sales_log(t)), "1998-06-03")


# --- courier ledger ---------------------------------------------------------------

def _ledger_sql(per_order: bool) -> str:
    def pay(share, floor):
        if per_order:
            return f"sum(greatest(total * {share}, {floor}))"
        return f"greatest(sum(total) * {share}, {floor})"

    return f"""
WITH o AS (SELECT l_orderkey, sum(l_extendedprice::DECIMAL(18,2)) AS total FROM lineitem GROUP BY 1),
d AS (SELECT l.l_suppkey, year(l_shipdate) AS y, month(l_shipdate) AS m, l.l_orderkey, total,
  500 - round(l_tax * 2000)::BIGINT AS rate, (l_discount * 100)::DECIMAL(14,2) AS tip
  FROM lineitem l JOIN o ON o.l_orderkey = l.l_orderkey),
g AS (SELECT l_suppkey, y, m, count(DISTINCT l_orderkey) AS n, sum(total) AS total,
  (2 * sum(rate) + count(*)) // (2 * count(*)) AS r, sum(tip) AS tips,
  {pay('0.05', 100)} AS p1, {pay('0.07', 150)} AS p2, {pay('0.08', 175)} AS p3, {pay('0.10', 200)} AS p4 FROM d GROUP BY 1, 2, 3),
p AS (SELECT *, CASE WHEN r < 400 THEN p1 WHEN r < 450 THEN p2 WHEN r < 490 THEN p3 ELSE p4 END AS pay FROM g)
SELECT l_suppkey AS courier_id, s_name AS courier_name, y AS settlement_year, m AS settlement_month, n AS orders_count,
  total::DOUBLE AS orders_total_sum, r::DOUBLE / 100 AS rate_avg, (total * 0.25)::DOUBLE AS order_processing_fee,
  pay::DECIMAL(28,4)::DOUBLE AS courier_order_sum, tips::DOUBLE AS courier_tips_sum,
  (pay::DECIMAL(28,4) + tips::DECIMAL(24,2) * 0.95)::DECIMAL(30,4)::DOUBLE AS courier_reward_sum
FROM p JOIN supplier ON l_suppkey = s_suppkey"""


def _deliveries(t):
    rate = (5 - F.col("l_tax").cast("decimal(4,2)") * 20).cast("decimal(5,2)")
    deliveries = t.lineitem.select(
        F.col("l_orderkey").alias("order_id"), F.col("l_suppkey").alias("courier_id"), F.col("l_shipdate").alias("order_ts"),
        rate.alias("rate"), (F.col("l_discount").cast("decimal(4,2)") * 100).cast("decimal(14,2)").alias("tip_sum"))
    couriers = t.supplier.select(F.col("s_suppkey").alias("courier_id"), F.col("s_name").alias("courier_name"))
    totals = t.lineitem.select(F.col("l_orderkey").alias("order_id"), money(F.col("l_extendedprice")).alias("total_sum"))
    return deliveries, couriers, totals


@query(_ledger_sql(False))
def ledger(t):
    return courier.ledger(*_deliveries(t))


@query(_ledger_sql(True))
def ledger_per_order_floor(t):
    return courier.ledger(*_deliveries(t), per_order_floor=True)


@query(_ledger_sql(False))
def ledger_upsert(t):
    deliveries, couriers, totals = _deliveries(t)
    stored = courier.ledger(deliveries.filter(F.col("order_ts") < F.lit("2000-01-10").cast("timestamp_ntz")), couriers, totals)
    fresh = courier.ledger(deliveries.filter(F.col("order_ts") >= F.lit("2000-01-01").cast("timestamp_ntz")), couriers, totals)
    return courier.upsert_ledger(stored, fresh)


# --- groups -----------------------------------------------------------------------

def _groups(t):
    """Nations as groups, customers as members, orders as messages."""
    load_dt = F.lit("2024-01-01").cast("timestamp_ntz")
    groups = t.nation.select(
        F.col("n_nationkey").alias("group_id"), hash_key(F.col("n_nationkey")).alias("hk_group_id"),
        F.date_add(F.lit("2000-01-01").cast("date"), (F.col("n_nationkey") * 7 % 25).cast("int")).alias("registration_dt"))
    users = t.customer.select(F.col("c_custkey").alias("user_id"), hash_key(F.col("c_custkey")).alias("hk_user_id"))
    log = t.customer.select(
        F.col("c_nationkey").alias("group_id"), F.col("c_custkey").alias("user_id"),
        F.lit(None).cast("bigint").alias("user_id_from"),
        F.when(F.col("c_acctbal") < 0, "create").otherwise("add").alias("event"), load_dt.alias("event_dt"))
    links = conversion.activity_links(log, users, groups, None, load_dt)
    history = conversion.auth_history(log, links)
    messages = t.orders
    user_messages = messages.select(hash_key(F.col("o_orderkey")).alias("hk_message_id"),
                                    hash_key(F.col("o_custkey")).alias("hk_user_id"))
    members = t.customer.select(F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey"))
    group_messages = messages.select("o_orderkey", "o_custkey").join(members, "o_custkey").select(
        hash_key(F.col("o_orderkey")).alias("hk_message_id"), hash_key(F.col("c_nationkey")).alias("hk_group_id"))
    return groups, links, history, group_messages, user_messages


_GROUPS = """
oldest AS (SELECT n_nationkey FROM nation ORDER BY DATE '2000-01-01' + ((n_nationkey * 7) % 25)::INTEGER LIMIT 10),
added AS (SELECT c_nationkey AS g, count(DISTINCT c_custkey) AS a FROM customer WHERE c_acctbal >= 0 GROUP BY 1),
writing AS (SELECT c_nationkey AS g, count(DISTINCT o_custkey) AS w FROM orders JOIN customer ON o_custkey = c_custkey
  GROUP BY 1)"""


@query(f"""
WITH {_GROUPS}
SELECT sha256(added.g::VARCHAR) AS hk_group_id, a AS cnt_added_users, coalesce(w, 0) AS cnt_users_in_group_with_messages,
  coalesce(w, 0)::DOUBLE / a AS group_conversion
FROM added JOIN oldest ON n_nationkey = g LEFT JOIN writing ON writing.g = added.g""")
def group_conversion(t):
    groups, links, history, group_messages, user_messages = _groups(t)
    return conversion.group_conversion(conversion.added_users(history, links, groups, 10),
                                       conversion.writing_users(group_messages, user_messages))


@query(f"WITH {_GROUPS} SELECT sha256(g::VARCHAR) AS hk_group_id, a AS cnt_added_users FROM added "
       "ORDER BY a DESC, sha256(g::VARCHAR) LIMIT 10")
def top_k_changes(t):
    groups, links, history, _, _ = _groups(t)
    return conversion.most_added(conversion.added_users(history, links, groups, None), 10)


@query(f"WITH {_GROUPS} SELECT sha256(g::VARCHAR) AS hk_group_id, w AS cnt_users_in_group_with_messages FROM writing "
       "ORDER BY w, sha256(g::VARCHAR) LIMIT 10")
def bottom_k_groups(t):
    _, _, _, group_messages, user_messages = _groups(t)
    return conversion.least_writing(conversion.writing_users(group_messages, user_messages), 10)


# --- geography --------------------------------------------------------------------

@query(f"""
WITH {LOCATED_SQL},
c AS (SELECT user_id, zone_id, ts, tz, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM located),
l AS (SELECT user_id, zone_id, lag(zone_id) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prev FROM located),
m AS (SELECT user_id, sum(CASE WHEN zone_id <> prev THEN 1 ELSE 0 END)::BIGINT AS n FROM l GROUP BY 1),
v AS (SELECT user_id, count(*) AS k, string_agg(zone_id, ',' ORDER BY zone_id) AS zones
  FROM (SELECT DISTINCT user_id, zone_id FROM located) GROUP BY 1),
d AS (SELECT DISTINCT user_id, zone_id, ts::DATE AS day FROM located),
r AS (SELECT *, day - (row_number() OVER (PARTITION BY user_id, zone_id ORDER BY day))::INTEGER AS run FROM d),
i AS (SELECT user_id, zone_id, count(*) AS days, max(day) AS e FROM r GROUP BY user_id, zone_id, run HAVING count(*) >= 2),
h AS (SELECT user_id, zone_id, row_number() OVER (PARTITION BY user_id ORDER BY e DESC, days DESC, zone_id) AS rn FROM i)
SELECT c.user_id, c.zone_id AS current_city, strftime((c.ts AT TIME ZONE 'UTC') AT TIME ZONE c.tz, '%Y-%m-%d %H:%M:%S') AS local_time,
  k AS cities_visited, zones AS travel_array, h.zone_id AS home_city, coalesce(n, 0) AS travel_count
FROM c JOIN m ON m.user_id = c.user_id JOIN v ON v.user_id = c.user_id LEFT JOIN h ON h.user_id = c.user_id AND h.rn = 1
WHERE c.rn = 1""")
def user_geo(t):
    mart = geography.user_geography(placed(t.events), city_rows(), min_days=2)
    return mart.withColumns({"travel_array": F.array_join("travel_array", ","),
                             "local_time": F.date_format("local_time", "yyyy-MM-dd HH:mm:ss")})


def _activity(t):
    kind = F.when(F.col("event_type") == "purchase", "message").when(F.col("event_type") == "click", "reaction").when(
        F.col("event_type") == "signup", "subscription").otherwise(F.col("event_type"))
    rows = placed(t.events).select("event_id", "user_id", "event_time", kind.alias("event_type"), "lat", "lon")
    return nearest(rows, city_rows())


_ZONES = """z AS (SELECT date_trunc('month', ts)::DATE AS month, date_trunc('week', ts)::DATE AS week, zone_id, event_type,
  row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n FROM located)"""
_ZONE_COUNTS = """count(*) FILTER (WHERE event_type = 'purchase') AS {p}_message,
  count(*) FILTER (WHERE event_type = 'click') AS {p}_reaction, count(*) FILTER (WHERE event_type = 'signup') AS {p}_subscription,
  count(*) FILTER (WHERE n = 1) AS {p}_user"""


@query(f"WITH {LOCATED_SQL}, {_ZONES} SELECT month::VARCHAR AS month, week::VARCHAR AS week, zone_id, "
       f"{_ZONE_COUNTS.format(p='week')} FROM z GROUP BY z.month, z.week, zone_id")
def zone_weekly(t):
    return geography.zone_weekly(_activity(t))


@query(f"WITH {LOCATED_SQL}, {_ZONES} SELECT month::VARCHAR AS month, zone_id, "
       f"{_ZONE_COUNTS.format(p='month')} FROM z GROUP BY z.month, zone_id")
def zone_monthly(t):
    return geography.zone_monthly(geography.zone_weekly(_activity(t)))


@query(f"""
WITH {LOCATED_SQL}, {_ZONES},
w AS (SELECT month, week, zone_id, {_ZONE_COUNTS.format(p='week')} FROM z GROUP BY 1, 2, 3),
m AS (SELECT month, zone_id, {_ZONE_COUNTS.format(p='month')} FROM z GROUP BY 1, 2)
SELECT w.month::VARCHAR AS month, w.week::VARCHAR AS week, w.* EXCLUDE (month, week), m.* EXCLUDE (month, zone_id)
FROM w JOIN m ON m.month = w.month AND m.zone_id = w.zone_id""")
def zone_activity(t):
    return geography.zone_activity(_activity(t))


@query(f"""
WITH {CITY_CTE},
e AS (SELECT event_id, ts, user_id, event_type, clat + ((event_id * 7919) % 1000) / 1000.0 - 0.5 AS lat,
  clng + ((event_id * 104729) % 1000) / 1000.0 - 0.5 AS lon FROM events JOIN cities ON id = 1 + user_id % 24),
s AS (SELECT DISTINCT user_id, (event_id * 31) % 40 AS channel FROM events WHERE event_type = 'signup'),
p AS (SELECT user_id, lat, lon FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn
  FROM e) WHERE rn = 1),
g AS (SELECT user_id, lat, lon, zone_id FROM (SELECT p.*, c.zone_id, row_number() OVER (PARTITION BY user_id ORDER BY
  {sql_haversine('p.lat', 'p.lon', 'c.clat', 'c.clng')}, c.id) AS rn
  FROM p JOIN cities c ON abs(p.lat - c.clat) < 1 AND abs(p.lon - c.clng) < 1) WHERE rn = 1),
w AS (SELECT DISTINCT least(user_id, (user_id * 7 + event_id) % 1000) AS a, greatest(user_id, (user_id * 7 + event_id) % 1000) AS b
  FROM events WHERE event_type = 'purchase')
SELECT DISTINCT x.user_id AS user_left, y.user_id AS user_right, x.zone_id, '2024-02-01 00:00:00' AS processed_dttm
FROM s sx JOIN s sy ON sx.channel = sy.channel AND sx.user_id < sy.user_id
JOIN g x ON x.user_id = sx.user_id JOIN g y ON y.user_id = sy.user_id AND y.zone_id = x.zone_id
WHERE {sql_haversine('x.lat', 'x.lon', 'y.lat', 'y.lon')} <= 50
  AND NOT EXISTS (SELECT 1 FROM w WHERE w.a = x.user_id AND w.b = y.user_id)""")
def friend_recommendation(t):
    e = t.events
    at = (F.col("user_id") % 24 + 1).cast("int")
    home_lat = F.element_at(F.array(*[F.lit(c[2]) for c in CITIES]), at)
    home_lon = F.element_at(F.array(*[F.lit(c[3]) for c in CITIES]), at)
    places = e.select(
        "event_id", "user_id", F.col("ts").alias("event_time"),
        (home_lat + (F.col("event_id") * 7919 % 1000) / 1000.0 - 0.5).alias("lat"),
        (home_lon + (F.col("event_id") * 104729 % 1000) / 1000.0 - 0.5).alias("lon"))
    subscriptions = e.filter(F.col("event_type") == "signup").select(
        "user_id", (F.col("event_id") * 31 % 40).alias("channel_id"))
    interactions = e.filter(F.col("event_type") == "purchase").select(
        F.col("user_id").alias("a"), ((F.col("user_id") * 7 + F.col("event_id")) % 1000).alias("b"))
    processed = F.lit("2024-02-01").cast("timestamp_ntz")
    return geography.friend_recommendations(subscriptions, places, interactions, city_rows(), processed)


# --- counters and currency ----------------------------------------------------------

def _messages(t):
    """Order lines as messages with one product each; F = closed, O = no status, P = open."""
    orders = t.orders.select(
        F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("h_user_pk"),
        F.when(F.col("o_orderstatus") == "F", "CLOSED").when(F.col("o_orderstatus") == "P", "OPEN").alias("status"))
    lines = t.lineitem.select("l_orderkey", F.array(F.struct(F.col("l_partkey").alias("product_id"))).alias("products"))
    messages = lines.join(orders, "l_orderkey")
    pk = hash_key(F.col("p_partkey"))
    products = t.part.select(pk.alias("h_product_pk"), F.col("p_partkey").alias("product_id"))
    renamed = t.part.filter(F.col("p_size") > 25).select(
        pk.alias("h_product_pk"), F.upper("p_name").alias("name"), F.lit("2024-02-01").cast("timestamp_ntz").alias("load_dt"))
    names = t.part.filter(F.col("p_type") != "PROMO").select(
        pk.alias("h_product_pk"), F.col("p_name").alias("name"), F.lit("2024-01-01").cast("timestamp_ntz").alias("load_dt")
    ).unionByName(renamed)
    links = t.part.filter(F.col("p_brand") != "Brand#7").select(
        pk.alias("h_product_pk"), hash_key(F.col("p_brand")).alias("h_category_pk"))
    categories = t.part.select(hash_key(F.col("p_brand")).alias("h_category_pk"), F.col("p_brand").alias("category_name")).distinct()
    return counters.counted_items(messages), counters.product_directory(products, names, links, categories)


_COUNTED = """
i AS (SELECT o_custkey AS user_id, p_partkey, p_brand,
  CASE WHEN p_size > 25 THEN upper(p_name) WHEN p_type <> 'PROMO' THEN p_name ELSE 'unknown' END AS product_name
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
  WHERE o_orderstatus <> 'P' AND p_brand <> 'Brand#7')"""


@query(f"WITH {_COUNTED} SELECT user_id, sha256(p_partkey::VARCHAR) AS product_id, product_name, count(*) AS order_cnt "
       "FROM i GROUP BY user_id, p_partkey, product_name")
def user_product_counters(t):
    return counters.user_product_counters(*_messages(t))


@query(f"WITH {_COUNTED} SELECT user_id, sha256(p_brand) AS category_id, p_brand AS category_name, count(*) AS order_cnt "
       "FROM i GROUP BY user_id, p_brand")
def user_category_counters(t):
    return counters.user_category_counters(*_messages(t))


@query("""
WITH x AS (SELECT o_orderdate::DATE AS d, c_nationkey AS c, o_custkey AS a, round(o_totalprice * 100)::HUGEINT AS cents, o_orderstatus AS s
  FROM orders JOIN customer ON o_custkey = c_custkey)
SELECT d::VARCHAR AS date_update, c::BIGINT AS currency_from,
  (sum(cents) * (10000 + c * 137 + month(d) * 11))::DOUBLE / 10000000 AS amount_total, count(*) AS cnt_transactions,
  count(*)::DOUBLE / count(DISTINCT a) AS avg_transactions_per_account, count(DISTINCT a) AS cnt_accounts_make_transactions
FROM x WHERE s = 'F' AND a > 0 AND day(d) <> 1 GROUP BY d, c""")
def currency_daily_metrics(t):
    accounts = t.customer.select(F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("currency_code"))
    moves = skew_join(t.orders, accounts, "o_custkey")
    transactions = moves.select(
        F.col("o_orderdate").alias("transaction_dt"), F.col("o_custkey").alias("account_number_from"), "currency_code",
        F.when(F.col("o_orderstatus") == "F", "done").otherwise("queued").alias("status"), money(F.col("o_totalprice")).alias("amount"))
    # Quotes in two target currencies; none on the first day of a month.
    quoted = transactions.select(F.to_date("transaction_dt").alias("date_update"), "currency_code").distinct()
    rate = (F.lit(10000) + F.col("currency_code") * 137 + F.month("date_update") * 11).cast("decimal(10,0)") / 100000
    currencies = quoted.filter(F.dayofmonth("date_update") != 1).select(
        "date_update", "currency_code", F.explode(F.array(F.lit(420), F.lit(430))).alias("currency_code_with"),
        rate.cast("decimal(10,5)").alias("currency_with_div"))
    return currency.daily_metrics(transactions, currencies, 420)
