"""Scans, filters, projections and scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from martloom.functions import dates, documents, geo, keys, money, text
from martloom.operators import filters
from martloom.operators.merge import replace_rows

from .registry import AS_OF, PLACED_SQL, placed, query, sql_half_up, sql_haversine


@query("SELECT event_id, user_id, event_type, value FROM events "
       "WHERE ts >= TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-11'")
def scan_events_day(t):
    return t.events.filter(dates.on_day(F.col("ts"), "2024-01-10")).select("event_id", "user_id", "event_type", "value")


@query("SELECT o_orderkey, o_custkey, o_totalprice FROM orders "
       "WHERE o_orderdate::DATE = DATE '1997-05-28' AND o_orderstatus = 'F'")
def slice_done_day(t):
    rows = t.orders.filter(dates.on_day(F.col("o_orderdate"), "1997-05-28") & (F.col("o_orderstatus") == "F"))
    return rows.select("o_orderkey", "o_custkey", "o_totalprice")


@query("SELECT o_orderkey, o_custkey, o_orderstatus FROM orders ORDER BY o_orderkey LIMIT 10")
def preview_limit(t):
    return filters.preview(t.orders.select("o_orderkey", "o_custkey", "o_orderstatus"), ["o_orderkey"], 10)


@query("SELECT o_orderkey, json_object('o_orderkey', o_orderkey, 'o_custkey', o_custkey, "
       "'o_orderstatus', o_orderstatus)::VARCHAR AS value FROM orders")
def to_json_payload(t):
    return t.orders.select("o_orderkey", documents.pack_json("o_orderkey", "o_custkey", "o_orderstatus").alias("value"))


@query("""
SELECT o_orderkey, o_orderdate::DATE::VARCHAR AS day,
       CASE WHEN o_orderdate::DATE = DATE '1997-05-28' THEN o_totalprice * 2 ELSE o_totalprice END AS amount
FROM orders""")
def slice_replace(t):
    stored = t.orders.select("o_orderkey", F.to_date("o_orderdate").alias("day"), F.col("o_totalprice").alias("amount"))
    that_day = F.col("day") == F.lit("1997-05-28").cast("date")
    fresh = stored.withColumn("amount", F.col("amount") * 2)
    return replace_rows(stored, fresh, that_day)


@query("SELECT event_id, (props::JSON ->> '$.k')::BIGINT AS k FROM events")
def json_expand(t):
    return t.events.select("event_id", documents.parse_json(F.col("props"), "k int").alias("data")).select(
        "event_id", "data.*")


@query("SELECT event_id, event_type, value FROM (SELECT event_id, nullif(event_type, 'error') AS event_type, "
       "CASE WHEN value < 400 THEN value END AS value FROM events) WHERE event_type IS NOT NULL AND value IS NOT NULL")
def filter_notnull(t):
    rows = t.events.select("event_id", F.nullif(F.col("event_type"), F.lit("error")).alias("event_type"),
                           F.when(F.col("value") < 400, F.col("value")).alias("value"))
    return filters.require(rows, "event_type", "value")


@query("SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderstatus = 'O' AND o_totalprice > 100000 "
       "AND o_orderpriority <> '5-LOW'")
def filter_basic(t):
    keep = (F.col("o_orderstatus") == "O") & (F.col("o_totalprice") > 100000) & (F.col("o_orderpriority") != "5-LOW")
    return t.orders.filter(keep).select("o_orderkey", "o_orderstatus", "o_totalprice")


@query("SELECT count(*) AS n FROM part WHERE p_brand LIKE 'Brand#1%'")
def filter_prefix(t):
    return t.part.filter(F.col("p_brand").startswith("Brand#1")).agg(F.count(F.lit(1)).alias("n"))


@query("""
SELECT event_id FROM (
  SELECT event_id, date_diff('second', TIMESTAMP '1970-01-01', ts) AS s,
         date_diff('second', TIMESTAMP '1970-01-01', ts) + floor(value * 3600)::BIGINT AS e FROM events)
WHERE s <= date_diff('second', TIMESTAMP '1970-01-01', TIMESTAMP '2024-01-15')
  AND e >= date_diff('second', TIMESTAMP '1970-01-01', TIMESTAMP '2024-01-15')""")
def active_interval(t):
    start = dates.epoch(F.col("ts"))
    end = start + F.floor(F.col("value") * 3600)
    at = dates.epoch(F.lit("2024-01-15").cast("timestamp_ntz"))
    return t.events.filter(dates.active_at(start, end, at)).select("event_id")


@query("SELECT event_id, user_id, ts::DATE::VARCHAR AS day FROM events "
       "WHERE ts::DATE BETWEEN DATE '2024-01-15' - INTERVAL 6 DAY AND DATE '2024-01-15'")
def trailing_week(t):
    return t.events.filter(dates.trailing_days(F.col("ts"), "2024-01-15", 7)).select(
        "event_id", "user_id", dates.day(F.col("ts")).alias("day"))


@query("SELECT o_orderkey FROM orders WHERE o_orderdate > TIMESTAMP '2001-01-01' "
       "UNION SELECT l_orderkey FROM lineitem WHERE l_shipdate > TIMESTAMP '2001-01-01'")
def changed_since(t):
    mark = "2001-01-01"
    orders = filters.changed_since(t.orders, ["o_orderdate"], mark).select("o_orderkey")
    lines = filters.changed_since(t.lineitem, ["l_shipdate"], mark).select(F.col("l_orderkey").alias("o_orderkey"))
    return orders.unionByName(lines).distinct()


@query("""
SELECT c_custkey, CASE lower(c_mktsegment) WHEN 'building' THEN 'construction' WHEN 'machinery' THEN 'industry'
  WHEN 'automobile' THEN 'industry' ELSE 'retail' END AS kind FROM customer""")
def case_normalise(t):
    words = {"building": "construction", "machinery": "industry", "automobile": "industry"}
    return t.customer.select("c_custkey", text.normalise(F.col("c_mktsegment"), words, "retail").alias("kind"))


@query("SELECT DISTINCT p_brand, p_type FROM part")
def distinct_pairs(t):
    return t.part.select("p_brand", "p_type").distinct()


@query("SELECT event_id, (json_exists(props::JSON, '$.k'))::BIGINT AS has_k, "
       "(json_exists(props::JSON, '$.z'))::BIGINT AS has_z FROM events")
def json_has_key(t):
    return t.events.select("event_id", documents.has_key(F.col("props"), "k").cast("bigint").alias("has_k"),
                           documents.has_key(F.col("props"), "z").cast("bigint").alias("has_z"))


@query("""
SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'CLOSED' WHEN 'P' THEN 'OPEN' END AS status FROM orders
WHERE o_orderstatus <> 'P' AND o_orderpriority <> '5-LOW' AND o_custkey <> 0""")
def valid_messages(t):
    item = F.struct(F.col("o_orderpriority").alias("product_id"))
    messages = t.orders.select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") == "F", "CLOSED").when(F.col("o_orderstatus") == "P", "OPEN").alias("status"),
        F.nullif(F.col("o_custkey").cast("string"), F.lit("0")).alias("h_user_pk"),
        F.filter(F.array(item), lambda p: p["product_id"] != "5-LOW").alias("products"),
    )
    return filters.valid_orders(messages).select("o_orderkey", "status")


# --- scalar functions ---------------------------------------------------------

@query("SELECT p_partkey, split_part(p_name, ' ', 1) AS first_word, split_part(p_name, ' ', 2) AS second_word, "
       "split_part(p_name, ' ', 3) AS third_word FROM part")
def str_split_part(t):
    return t.part.select("p_partkey", *[text.part_of(F.col("p_name"), " ", i).alias(n) for i, n in
                                        ((1, "first_word"), (2, "second_word"), (3, "third_word"))])


@query("SELECT r_regionkey::BIGINT AS r_regionkey, trim(lower('  ' || r_name || ' ')) AS name FROM region")
def str_trim_lower(t):
    padded = F.concat(F.lit("  "), F.col("r_name"), F.lit(" "))
    return t.region.select("r_regionkey", text.clean(padded).alias("name"))


@query("SELECT s_suppkey, s_name || ' / ' || s_nationkey AS label FROM supplier")
def str_concat(t):
    return t.supplier.select("s_suppkey", text.join_text(F.col("s_name"), F.col("s_nationkey"), sep=" / ").alias("label"))


@query("SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, l_partkey, "
       "(l_extendedprice::DECIMAL(18,2) * (1 - l_discount::DECIMAL(4,2)))::DOUBLE AS net FROM lineitem")
def price_net(t):
    net = money.price_net(money.money(F.col("l_extendedprice")), F.col("l_discount").cast("decimal(4,2)") * 100)
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", net.cast("decimal(18,4)").alias("net"))


@query(f"""
SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, l_partkey,
  {sql_half_up("round(l_extendedprice * 100)::HUGEINT * 100", "100 - round(l_discount * 100)::HUGEINT", 100)} AS gross
FROM lineitem""")
def price_gross(t):
    gross = money.price_gross(money.money(F.col("l_extendedprice")), F.col("l_discount").cast("decimal(4,2)") * 100)
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", F.round(gross, 2).alias("gross"))


@query("SELECT o_orderkey, strftime(o_orderdate, '%Y%m%d')::BIGINT AS date_id, o_orderdate::DATE::VARCHAR AS day FROM orders")
def int_date_parse(t):
    rows = t.orders.select("o_orderkey", dates.date_to_int(F.col("o_orderdate")).alias("date_id"))
    return rows.withColumn("day", dates.int_to_date(F.col("date_id")))


@query(f"""
SELECT s_suppkey, date_part('year', age(TIMESTAMP '{AS_OF}',
  (DATE '1950-01-01' + ((s_suppkey * 37) % 18000)::INTEGER)::TIMESTAMP))::BIGINT AS age FROM supplier""")
def age_years(t):
    birthday = F.date_add(F.lit("1950-01-01").cast("date"), (F.col("s_suppkey") * 37 % 18000).cast("int"))
    return t.supplier.select("s_suppkey", dates.age_years(birthday, AS_OF).alias("age"))


@query("SELECT event_id, date_diff('second', TIMESTAMP '1970-01-01', ts) AS seconds FROM events")
def epoch_seconds(t):
    return t.events.select("event_id", dates.epoch(F.col("ts")).alias("seconds"))


@query(f"""
WITH {PLACED_SQL}
SELECT event_id, round({sql_haversine('lat', 'lon', '-33.865::DOUBLE', '151.2094::DOUBLE')}, 3) AS km FROM placed""")
def haversine_km(t):
    km = geo.haversine(F.col("lat"), F.col("lon"), F.lit(-33.865), F.lit(151.2094))
    return placed(t.events).select("event_id", F.round(km, 3).alias("km"))


@query("SELECT l_orderkey, least(l_partkey, l_suppkey) AS low, greatest(l_partkey, l_suppkey) AS high FROM lineitem")
def ordered_pair(t):
    low, high = keys.ordered_pair(F.col("l_partkey"), F.col("l_suppkey"))
    return t.lineitem.select("l_orderkey", low.alias("low"), high.alias("high"))


@query("SELECT c_custkey, sha256(concat_ws('|', c_custkey, c_name, c_mktsegment)) AS hk FROM customer")
def hash_key(t):
    cols = [F.col(c) for c in ("c_custkey", "c_name", "c_mktsegment")]
    return t.customer.select("c_custkey", keys.hash_key(*cols).alias("hk"))


@query("SELECT event_id, (props::JSON ->> '$.k')::BIGINT AS k, props::JSON ->> '$.none' AS nothing FROM events")
def json_path(t):
    return t.events.select("event_id", documents.json_get(F.col("props"), "$.k", "bigint").alias("k"),
                           documents.json_get(F.col("props"), "$.none").alias("nothing"))


@query("SELECT event_id, 'k' AS key, (props::JSON ->> '$.k') AS value FROM events")
def json_each(t):
    return documents.json_each(t.events.select("event_id", "props"), "props").select("event_id", "key", "value")


@query("SELECT event_id, CASE WHEN event_type = 'purchase' THEN '{\"k\":' || ((props::JSON ->> '$.k')::BIGINT * 2) || '}' "
       "ELSE props END AS props FROM events")
def json_set(t):
    doubled = documents.json_set(F.col("props"), "k", lambda v: v * 2, "int")
    from martloom.operators.merge import update_where

    return update_where(t.events.select("event_id", "event_type", "props"), F.col("event_type") == "purchase",
                        {"props": doubled}).select("event_id", "props")


@query("""
SELECT l_orderkey, l_partkey, l_linenumber::BIGINT AS l_linenumber, unnest(['discount', 'price', 'tax']) AS kind,
       unnest([l_discount, l_extendedprice, l_tax]) AS amount FROM lineitem""")
def explode_items(t):
    amounts = F.array(*[F.struct(F.lit(k).alias("kind"), F.col(c).alias("amount")) for k, c in
                        (("discount", "l_discount"), ("price", "l_extendedprice"), ("tax", "l_tax"))])
    rows = t.lineitem.select("l_orderkey", "l_partkey", "l_linenumber", amounts.alias("items"))
    return documents.explode_items(rows, "items").select("l_orderkey", "l_partkey", "l_linenumber", "item.*")


@query("""
WITH s AS (SELECT s_suppkey, (340 + s_nationkey * 7)::DECIMAL(18,2) / 100 AS rate, s_acctbal::DECIMAL(18,2) AS total
           FROM supplier)
SELECT s_suppkey, (CASE WHEN rate < 4.0 THEN greatest(total * 0.05, 100) WHEN rate < 4.5 THEN greatest(total * 0.07, 150)
  WHEN rate < 4.9 THEN greatest(total * 0.08, 175) ELSE greatest(total * 0.10, 200) END)::DECIMAL(28,4)::DOUBLE AS payout
FROM s""")
def tiered_payout(t):
    rate = ((F.lit(340) + F.col("s_nationkey") * 7).cast("decimal(6,0)") / 100).cast("decimal(4,2)")
    return t.supplier.select("s_suppkey", money.tiered(rate, money.money(F.col("s_acctbal"))).alias("payout"))
