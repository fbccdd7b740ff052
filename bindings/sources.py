"""Sources and sinks of files: the tables are written in each format and read back.

Everything goes under the session's checkpoint folder, a new one for every run.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from martloom.sinks import tables
from martloom.sources import files

from .registry import query
from .streams import _root


def _csv(rows, path: str, sep: str = ",", header: bool = True) -> None:
    rows.write.mode("append").option("header", header).option("sep", sep).option("nullValue", "null").csv(path)


@query("""SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN NULL ELSE c_name END AS c_name, c_mktsegment
FROM customer""")
def csv_null_token(t):
    """Delimited text with a header and `null` for missing values."""
    path = f"{_root(t)}/csv"
    _csv(t.customer.select("c_custkey", F.when(F.col("c_acctbal") >= 0, F.col("c_name")).alias("c_name"), "c_mktsegment"), path)
    return files.read_csv(t.spark, path, "c_custkey bigint, c_name string, c_mktsegment string")


@query("SELECT s_nationkey::BIGINT AS s_nationkey, count(*) AS suppliers, min(s_suppkey) AS first_key FROM supplier GROUP BY s_nationkey")
def csv_inferred(t):
    """Semicolons, types inferred: the grouping runs on whole numbers."""
    path = f"{_root(t)}/csv"
    _csv(t.supplier.select("s_suppkey", "s_name", "s_nationkey"), path, ";")
    return files.read_csv(t.spark, path, sep=";", infer=True).groupBy("s_nationkey").agg(
        F.count(F.lit(1)).alias("suppliers"), F.min("s_suppkey").alias("first_key"))


@query("""SELECT o_orderkey, o_custkey, CASE WHEN o_orderdate < TIMESTAMP '1995-01-01' THEN 'shipped'
  WHEN o_orderdate < TIMESTAMP '1997-01-01' THEN o_orderstatus END AS status FROM orders""")
def csv_increment_drift(t):
    """Increments with three headers: without status, with it, and with unknown columns in another order."""
    path = f"{_root(t)}/increments"
    early, late = F.col("o_orderdate") < "1995-01-01", F.col("o_orderdate") >= "1997-01-01"
    row_id = F.col("o_orderkey").alias("id")
    _csv(t.orders.filter(early).select(row_id, "o_orderkey", "o_custkey"), path)
    _csv(t.orders.filter(~early & ~late).select(row_id, F.col("o_orderstatus").alias("status"), "o_custkey", "o_orderkey"), path)
    _csv(t.orders.filter(late).select(F.lit("x").alias("a"), F.lit("y").alias("b"), F.lit("z").alias("c"), "o_custkey",
                                      F.lit(None).cast("string").alias("status"), F.lit(1).alias("d"), "o_orderkey"), path)
    read = files.read_increment(t.spark, path, {"o_orderkey": "bigint", "o_custkey": "bigint", "status": "string"},
                                defaults={"status": "shipped"})
    return read.withColumn("status", F.when(F.col("status") != "null", F.col("status")))


@query("""SELECT o_custkey AS group_id, o_orderkey AS user_id, CASE WHEN o_orderstatus = 'F' THEN o_custkey END AS user_id_from,
  o_orderpriority AS event, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS event_dt FROM orders""")
def csv_group_log(t):
    """The group log: user_id_from is empty for most rows and was written as a float."""
    path = f"{_root(t)}/log"
    rows = t.orders.select(
        F.col("o_custkey").alias("group_id"), F.col("o_orderkey").alias("user_id"),
        F.when(F.col("o_orderstatus") == "F", F.col("o_custkey").cast("double")).alias("user_id_from"),
        F.col("o_orderpriority").alias("event"), F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("datetime"))
    rows.write.option("header", True).csv(path)
    return files.read_group_log(t.spark, path)


@query("SELECT p_partkey, p_name, p_size::BIGINT AS p_size FROM part")
def records_headerless(t):
    """Record files without a header."""
    path = f"{_root(t)}/records"
    _csv(t.part.select("p_partkey", "p_name", "p_size"), path, ";", header=False)
    return files.read_records(t.spark, path, "p_partkey bigint, p_name string, p_size int")


@query("""SELECT n_regionkey::BIGINT AS region, count(*) AS nations, min(n_name) AS first_name FROM nation GROUP BY 1""")
def pages_landed(t):
    """A response of each region is an array of its nations, landed as a file for each region."""
    path = f"{_root(t)}/pages"
    body = F.to_json(F.array_sort(F.collect_list(F.struct("n_name", "n_regionkey"))))
    rows = t.nation.groupBy(F.col("n_regionkey").cast("string").alias("category")).agg(body.alias("body"))
    files.land_raw_text(rows, path)
    return files.read_pages(t.spark, path, "n_name string, n_regionkey bigint").groupBy(F.col("n_regionkey").alias("region")).agg(
        F.count(F.lit(1)).alias("nations"), F.min("n_name").alias("first_name"))


@query("SELECT count(*) AS n, min(o_orderkey) AS first_key, max(o_orderkey) AS last_key FROM orders "
       "WHERE o_orderdate >= TIMESTAMP '1995-03-09' AND o_orderdate < TIMESTAMP '1995-03-10'")
def day_file_read(t):
    """One day's file out of a tree of day files; the other days are not listed."""
    root = _root(t)
    tables.write_table(t.orders.withColumn("day", F.to_date("o_orderdate")).filter("year(o_orderdate) = 1995").select("o_orderkey", "day"),
                       f"{root}/log", partition_by=["day"])
    day = files.day_file(f"{root}/log/day=%Y-%m-%d", "1995-03-09")
    return t.spark.read.schema("o_orderkey bigint").parquet(day).agg(
        F.count(F.lit(1)).alias("n"), F.min("o_orderkey").alias("first_key"), F.max("o_orderkey").alias("last_key"))


@query("""SELECT c_nationkey::BIGINT AS c_nationkey, count(*) AS orders, sum(o_totalprice::DECIMAL(18, 2))::DOUBLE AS total
FROM orders JOIN customer ON c_custkey = o_custkey GROUP BY c_nationkey""")
def bucketed_join(t):
    """Orders and customers written in the same buckets of the customer key: the join moves no rows."""
    return tables.bucketed_pair(
        t.orders.select(F.col("o_custkey").alias("custkey"), F.col("o_totalprice").cast("decimal(18,2)").alias("price")),
        t.customer.select(F.col("c_custkey").alias("custkey"), "c_nationkey"), "custkey", _root(t)).groupBy("c_nationkey").agg(
        F.count(F.lit(1)).alias("orders"), F.sum("price").cast("decimal(24,2)").alias("total"))
