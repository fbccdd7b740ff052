"""Keyed table changes, star and vault loads."""

from __future__ import annotations

from pyspark.sql import functions as F

from martloom.functions.keys import hash_key
from martloom.functions.money import money
from martloom.operators import merge, vault
from martloom.operators.windows import top_n
from martloom.plans import dealership, sales, star
from martloom.sinks import parted

from .registry import query
from .streams import _root

_T1, _T2 = "2020-01-01", "2021-01-01"


def _at(text: str):
    return F.lit(text).cast("timestamp_ntz")


@query(f"""
WITH s AS (SELECT c_name, lower(c_mktsegment) AS segment, c_acctbal + 1 AS balance FROM customer WHERE c_acctbal >= 2000)
SELECT sha256(c.c_name) AS customer_id, c.c_name, coalesce(s.segment, c_mktsegment) AS segment, coalesce(s.balance, c_acctbal) AS balance,
  CASE WHEN s.c_name IS NULL THEN '{_T1} 00:00:00' ELSE '{_T2} 00:00:00' END AS load_dttm
FROM customer c LEFT JOIN s ON s.c_name = c.c_name WHERE c_acctbal < 5000 OR s.c_name IS NOT NULL""")
def merge_dimension(t):
    """Stored: customers under 5000.  Increment: customers from 2000, with changed attributes."""
    stored = t.customer.filter(F.col("c_acctbal") < 5000).select(
        "c_name", F.col("c_mktsegment").alias("segment"), F.col("c_acctbal").alias("balance"), _at(_T1).alias("load_dttm"))
    wide = t.customer.filter(F.col("c_acctbal") >= 2000).select(
        "c_name", F.lower("c_mktsegment").alias("segment"), (F.col("c_acctbal") + 1).alias("balance"), _at(_T2).alias("load_dttm"))
    target = star.dimension_rows(stored, "customer_id", ["c_name"], ["segment", "balance"], "load_dttm")
    return star.merge_dimension(target, wide, "customer_id", ["c_name"], ["segment", "balance"])


_LINE = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]


@query(f"""
WITH l AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_partkey, l_suppkey, l_linenumber
  ORDER BY l_extendedprice, l_shipdate) AS rn FROM lineitem WHERE l_shipdate < TIMESTAMP '1999-01-01') WHERE rn = 1),
s AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_partkey, l_suppkey, l_linenumber
  ORDER BY l_extendedprice * 2, l_shipdate) AS rn FROM lineitem WHERE l_shipdate >= TIMESTAMP '1997-01-01') WHERE rn = 1)
SELECT coalesce(s.l_orderkey, l.l_orderkey) AS l_orderkey, coalesce(s.l_partkey, l.l_partkey) AS l_partkey,
  coalesce(s.l_suppkey, l.l_suppkey) AS l_suppkey, coalesce(s.l_linenumber, l.l_linenumber)::BIGINT AS l_linenumber,
  CASE WHEN s.l_orderkey IS NULL THEN l.l_extendedprice ELSE s.l_extendedprice * 2 END AS price,
  CASE WHEN s.l_orderkey IS NULL THEN '{_T1} 00:00:00' ELSE '{_T2} 00:00:00' END AS load_dttm
FROM l FULL JOIN s ON s.l_orderkey = l.l_orderkey AND s.l_partkey = l.l_partkey AND s.l_suppkey = l.l_suppkey
  AND s.l_linenumber = l.l_linenumber""")
def merge_fact(t):
    """Stored: lines shipped before 1999.  Increment: lines shipped from 1997, at twice the price."""
    def load(rows, factor, at):
        return rows.select(*_LINE, (F.col("l_extendedprice") * factor).alias("price"), _at(at).alias("load_dttm"))

    old = load(t.lineitem.filter(F.col("l_shipdate") < _at("1999-01-01")), 1, _T1)
    new = load(t.lineitem.filter(F.col("l_shipdate") >= _at("1997-01-01")), 2, _T2)
    return star.merge_fact(top_n(old, _LINE, ["price"], 1), new, _LINE)


_UNIQUE = """SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, min(l_extendedprice) AS price
  FROM lineitem, (SELECT max(l_orderkey) AS top FROM lineitem) WHERE {} GROUP BY ALL"""


@query(f"""
WITH l AS ({_UNIQUE.format('l_orderkey * 20 <= top * 19')}), s AS ({_UNIQUE.format('l_orderkey * 10 >= top * 9')})
SELECT coalesce(s.l_orderkey, l.l_orderkey) AS l_orderkey, coalesce(s.l_partkey, l.l_partkey) AS l_partkey,
  coalesce(s.l_suppkey, l.l_suppkey) AS l_suppkey, coalesce(s.l_linenumber, l.l_linenumber)::BIGINT AS l_linenumber,
  coalesce(s.price * 2, l.price) AS price,
  CASE WHEN s.l_orderkey IS NULL THEN '{_T1} 00:00:00' ELSE '{_T2} 00:00:00' END AS load_dttm
FROM l FULL JOIN s ON s.l_orderkey = l.l_orderkey AND s.l_partkey = l.l_partkey AND s.l_suppkey = l.l_suppkey
  AND s.l_linenumber = l.l_linenumber""")
def merge_fact_touched(t):
    """Stored by ranges of the order: all but the newest twentieth of the orders.  Increment: the
    newest tenth, at twice the price.  Only the parts of that tenth are read and replaced."""
    lines = t.lineitem.groupBy(*_LINE).agg(F.min("l_extendedprice").alias("price"))
    top = t.lineitem.agg(F.max("l_orderkey")).first()[0] or 0
    part, path = parted.by_range("l_orderkey", top // 64 + 1), f"{_root(t)}/fact"
    old = lines.filter(F.col("l_orderkey") * 20 <= top * 19).withColumn("load_dttm", _at(_T1))
    new = lines.filter(F.col("l_orderkey") * 10 >= top * 9).withColumns({"price": F.col("price") * 2, "load_dttm": _at(_T2)})
    parted.write_parted(old, path, part)
    parted.merge_into(path, new, _LINE, part, check=False)
    return t.spark.read.parquet(path).drop(parted.PART)


@query(f"""
WITH top AS (SELECT max(c_custkey) AS top FROM customer)
SELECT c_custkey, c_name, CASE WHEN c_custkey * 5 >= top * 4 THEN lower(c_mktsegment) ELSE c_mktsegment END AS segment,
  c_acctbal AS balance, '{_T1} 00:00:00' AS load_dttm FROM customer, top WHERE c_custkey * 10 < top * 9
UNION ALL SELECT c_custkey, c_name, lower(c_mktsegment), c_acctbal + 1, '{_T2} 00:00:00' FROM customer, top
  WHERE c_custkey * 10 >= top * 9""")
def merge_dimension_touched(t):
    """Stored: customers but the newest tenth.  Increment: the newest fifth, of which known ones
    take a new segment and keep their balance and load time."""
    top = t.customer.agg(F.max("c_custkey")).first()[0] or 0
    rows = t.customer.select("c_custkey", "c_name", F.col("c_mktsegment").alias("segment"), F.col("c_acctbal").alias("balance"))
    part, path = parted.by_range("c_custkey", top // 32 + 1), f"{_root(t)}/customers"
    parted.write_parted(rows.filter(F.col("c_custkey") * 10 < top * 9).withColumn("load_dttm", _at(_T1)), path, part)
    new = rows.filter(F.col("c_custkey") * 5 >= top * 4).withColumns(
        {"segment": F.lower("segment"), "balance": F.col("balance") + 1, "load_dttm": _at(_T2)})
    parted.merge_into(path, new, ["c_custkey"], part, update_cols=["segment"])
    return t.spark.read.parquet(path).drop(parted.PART)


@query("""
WITH a AS (SELECT p_name, min(p_partkey) AS p_partkey FROM part WHERE p_size <= 5 GROUP BY 1)
SELECT p_name, p_partkey, 'stored' AS origin FROM a
UNION ALL SELECT p_name, min(p_partkey), 'increment' FROM part WHERE p_name NOT IN (SELECT p_name FROM a) GROUP BY 1""")
def insert_ignore(t):
    stored = t.part.filter(F.col("p_size") <= 5).groupBy("p_name").agg(F.min("p_partkey").alias("p_partkey"))
    incoming = t.part.select("p_name", "p_partkey", F.lit("increment").alias("origin"))
    return merge.insert_ignore(stored.withColumn("origin", F.lit("stored")), incoming, ["p_name"], ["p_partkey"])


@query("SELECT sha256(o_custkey::VARCHAR) AS h_user_pk, o_custkey, min(o_orderdate)::VARCHAR AS since, "
       "'2024-01-01 00:00:00' AS load_dt, 'orders' AS load_src FROM orders GROUP BY o_custkey")
def hub_load(t):
    rows = t.orders.select("o_custkey", F.col("o_orderdate").alias("since"))
    return vault.hub(rows, "o_custkey", "h_user_pk", _at("2024-01-01"), "orders", ["since"])


@query("""
SELECT sha256(concat_ws('|', sha256(o::VARCHAR), sha256(p::VARCHAR))) AS hk_order_product_pk, sha256(o::VARCHAR) AS h_order_pk,
  sha256(p::VARCHAR) AS h_product_pk, '2024-01-01 00:00:00' AS load_dt, 'orders' AS load_src
FROM (SELECT DISTINCT l_orderkey AS o, l_partkey AS p FROM lineitem)""")
def link_load(t):
    """Links of the lines shipped from 1999 on, added to those of the lines before."""
    rows = t.lineitem.select("l_orderkey", "l_partkey", "l_shipdate")
    split = _at("1999-01-01")

    def links(part, target=None):
        return vault.link(part, "hk_order_product_pk", {"h_order_pk": "l_orderkey", "h_product_pk": "l_partkey"},
                          _at("2024-01-01"), "orders", target)

    stored = links(rows.filter(F.col("l_shipdate") < split))
    return stored.unionByName(links(rows.filter(F.col("l_shipdate") >= split), stored))


_SAT = """
v AS (SELECT DISTINCT sha256(o_custkey::VARCHAR) AS h_user_pk, o_orderpriority AS priority, o_orderdate AS d,
  sha256(o_orderpriority) AS hashdiff FROM orders),
l AS (SELECT *, lag(hashdiff) OVER (PARTITION BY h_user_pk ORDER BY d, hashdiff) AS prev FROM v)
SELECT h_user_pk, priority, strftime(d, '%Y-%m-%d %H:%M:%S') AS load_dt, hashdiff FROM l WHERE prev IS NULL OR prev <> hashdiff"""


def _versions(t):
    return t.orders.select(hash_key(F.col("o_custkey")).alias("h_user_pk"), F.col("o_orderpriority").alias("priority"),
                           F.col("o_orderdate").alias("load_dt"))


@query("WITH " + _SAT)
def satellite_load(t):
    return vault.changes(vault.satellite(_versions(t), "h_user_pk", ["priority"], "load_dt"), "h_user_pk", "load_dt")


def _two_loads(first, second):
    stored = vault.satellite(first, "h_user_pk", ["priority"], "load_dt")
    more = vault.satellite(second, "h_user_pk", ["priority"], "load_dt", stored)
    return vault.changes(stored.unionByName(more), "h_user_pk", "load_dt")


@query("WITH " + _SAT)
def satellite_increment(t):
    """Two loads, the second on top of the first, equal one load of everything."""
    rows, split = _versions(t), _at("1999-01-01")
    return _two_loads(rows.filter(F.col("load_dt") < split), rows.filter(F.col("load_dt") >= split))


@query("WITH " + _SAT)
def satellite_late(t):
    """Every other month arrives only after all the others: the result is that of one load."""
    rows, late = _versions(t), F.month("load_dt") % 2 == 0
    return _two_loads(rows.filter(~late), rows.filter(late))


@query("""
SELECT o_custkey AS customer_id, 'Customer' AS first_name, o_custkey::VARCHAR AS last_name, max(month(o_orderdate)) AS city_id
FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0) GROUP BY o_custkey""")
def dim_new_rows(t):
    log = t.orders.select(
        F.col("o_custkey").alias("customer_id"), F.lit("Customer").alias("first_name"),
        F.col("o_custkey").cast("string").alias("last_name"), F.month("o_orderdate").alias("city_id"))
    known = t.customer.filter(F.col("c_acctbal") < 0).select(F.col("c_custkey").alias("customer_id"))
    return sales.new_customers(known, log)


@query("""
SELECT c_custkey, c_name, coalesce(s.total, c_acctbal::DECIMAL(18,2))::DOUBLE AS c_acctbal FROM customer LEFT JOIN (
  SELECT o_custkey, sum(o_totalprice::DECIMAL(18,2)) AS total FROM orders GROUP BY 1) s ON o_custkey = c_custkey""")
def update_from(t):
    totals = t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.sum(money(F.col("o_totalprice"))).cast("decimal(24,2)").alias("c_acctbal"))
    target = t.customer.select("c_custkey", "c_name", F.col("c_acctbal").cast("decimal(24,2)").alias("c_acctbal"))
    return merge.update_from(target, totals, ["c_custkey"], ["c_acctbal"])


@query("SELECT o_orderkey, CASE WHEN o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R') THEN 'returned' "
       "ELSE o_orderstatus END AS status FROM orders")
def apply_status(t):
    marks = t.lineitem.filter(F.col("l_returnflag") == "R").select(F.col("l_orderkey").alias("o_orderkey")).distinct()
    target = t.orders.select("o_orderkey", F.col("o_orderstatus").alias("status"))
    return merge.update_from(target, marks.withColumn("status", F.lit("returned")), ["o_orderkey"], ["status"])


@query("""
SELECT CASE WHEN s_nationkey = 3 THEN s_suppkey + 1000000000 ELSE l_suppkey END AS l_suppkey, count(*) AS n
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1""")
def rename_key(t):
    mapping = t.supplier.filter(F.col("s_nationkey") == 3).select(
        F.col("s_suppkey").alias("l_suppkey"), (F.col("s_suppkey") + 1000000000).alias("new_key"))
    lines = t.lineitem.groupBy("l_suppkey").agg(F.count(F.lit(1)).alias("n"))
    return merge.rename_key(lines, mapping, "l_suppkey", "new_key")


@query("SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')")
def delete_by_key(t):
    gone = t.lineitem.filter(F.col("l_returnflag") == "R").select(F.col("l_orderkey").alias("o_orderkey"))
    return merge.delete_by_key(t.orders.select("o_orderkey", "o_custkey"), gone, ["o_orderkey"])


def _raw_parts(t):
    """Parts as flat car sales: brand + two-word model, colour."""
    return t.part.select(
        F.col("p_partkey").alias("id"),
        F.concat(F.col("p_brand"), F.lit(" "), F.col("p_name"), F.lit(", "), F.lower("p_type")).alias("auto"),
        F.when(F.col("p_size") > 10, F.col("p_size")).alias("gasoline_consumption"),
        money(F.col("p_retailprice")).alias("price"), F.lit("2022-01-01").cast("date").alias("date"),
        F.col("p_type").alias("person_name"), F.concat(F.lit("+"), F.col("p_size")).alias("phone"),
        F.lit(0).alias("discount"), F.nullif(F.col("p_type"), F.lit("PROMO")).alias("brand_origin"))


@query("""
SELECT p_partkey AS sale_id, sha256(concat_ws('|', p_type, '+' || p_size)) AS customer_id,
  sha256(concat_ws('|', p_brand, p_name)) AS model_id, sha256(lower(p_type)) AS color_id, p_retailprice AS price FROM part""")
def normalise_entities(t):
    return dealership.normalise_sales(_raw_parts(t))["sales"].select("sale_id", "customer_id", "model_id", "color_id", "price")


@query("""
SELECT sha256(concat_ws('|', p_brand, p_name)) AS model_id, sha256(p_brand) AS brand_id, p_name AS model_name,
  min(CASE WHEN p_size > 10 THEN p_size END)::BIGINT AS gasoline_consumption FROM part GROUP BY p_brand, p_name""")
def normalise_models(t):
    return dealership.normalise_sales(_raw_parts(t))["models"]


@query("SELECT DISTINCT sha256(p_type) AS country_id, p_type AS country_name FROM part WHERE p_type <> 'PROMO'")
def normalise_countries(t):
    return dealership.normalise_sales(_raw_parts(t))["countries"]


@query("""
SELECT sha256(p_brand) AS brand_id, p_brand AS brand_name, sha256(min(nullif(p_type, 'PROMO'))) AS country_id
FROM part GROUP BY p_brand""")
def normalise_brands(t):
    return dealership.normalise_sales(_raw_parts(t))["brands"]


@query("SELECT DISTINCT sha256(lower(p_type)) AS color_id, lower(p_type) AS color_name FROM part")
def normalise_colors(t):
    return dealership.normalise_sales(_raw_parts(t))["colors"]


@query("SELECT DISTINCT sha256(concat_ws('|', p_type, '+' || p_size)) AS customer_id, p_type AS name, '+' || p_size AS phone FROM part")
def normalise_customers(t):
    return dealership.normalise_sales(_raw_parts(t))["customers"]


@query("SELECT p_brand AS brand_origin, max(cents)::DOUBLE / 100 AS price_max, min(cents)::DOUBLE / 100 AS price_min FROM ("
       "SELECT p_brand, (2 * round(l_extendedprice * 100)::HUGEINT * 100 + (100 - round(l_discount * 100)::HUGEINT)) "
       "// (2 * (100 - round(l_discount * 100)::HUGEINT)) AS cents FROM lineitem JOIN part ON l_partkey = p_partkey) GROUP BY 1")
def price_range(t):
    lines = t.lineitem.select(F.col("l_partkey").alias("model_id"), money(F.col("l_extendedprice")).alias("price"),
                              (F.col("l_discount").cast("decimal(4,2)") * 100).alias("discount"))
    models = t.part.select(F.col("p_partkey").alias("model_id"), F.col("p_brand").alias("brand_id"))
    brands = t.part.select(F.col("p_brand").alias("brand_id"), F.col("p_brand").alias("country_id")).distinct()
    countries = brands.select("country_id", F.col("country_id").alias("country_name"))
    return dealership.price_range_by_country(lines, models, brands, countries)
