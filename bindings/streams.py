"""Streaming jobs run over the tables as a file stream until it is worked off.

The tables written by a job go under the session's checkpoint folder, a new one for
every run, and the result is read back from there.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.functions.dates import epoch
from martloom.functions.keys import hash_key
from martloom.operators import vault
from martloom.plans import counters
from martloom.session import checkpointed, ensure_checkpoint_dir, shuffles_dropped
from martloom.sources.files import list_files
from martloom.sources.streams import parse_stream
from martloom.streaming import campaigns, common, order_counters, order_vault

from .registry import query


def _stream(t, name: str) -> DataFrame:
    return t.spark.readStream.schema(getattr(t, name).schema).option("maxFilesPerTrigger", 1000).parquet(
        f"{t.folder}/{name}.parque[t]")  # a pattern, as the table may be one file


def _root(t) -> str:
    return f"{ensure_checkpoint_dir(t.spark)}/run-{uuid.uuid4().hex}"


def _messages(rows: DataFrame, *fields) -> DataFrame:
    return rows.select(F.to_json(F.struct(*fields)).alias("value"))


def _deliver(messages: DataFrame, root: str, slot: Column, slots: int, again: int) -> str:
    """The messages as deliveries, one after the other in a folder, and one of them again."""
    with shuffles_dropped(messages.sparkSession):
        for delivery in [*range(slots), again]:
            messages.filter(slot == delivery).select("value").write.mode("append").option("compression", "zstd").parquet(
                f"{root}/inbox")
    return f"{root}/inbox"


def _inbox(t, inbox: str, batches: int) -> DataFrame:
    """The inbox as a stream of about so many bounded batches."""
    most = max(1, len(list_files(t.spark, f"{inbox}/*.parquet")) // batches)
    return t.spark.readStream.schema("value string").option("maxFilesPerTrigger", most).parquet(inbox)


_AT = "date_diff('second', TIMESTAMP '1970-01-01', TIMESTAMP '1998-01-01')"
_START = "date_diff('second', TIMESTAMP '1970-01-01', o_orderdate)"


@query(f"""
SELECT o_custkey::VARCHAR AS restaurant_id, o_orderkey::VARCHAR AS adv_campaign_id, c_name AS client_id,
  {_AT} AS trigger_datetime_created, NULL::VARCHAR AS feedback
FROM orders JOIN customer ON c_custkey = o_custkey WHERE {_START} <= {_AT} AND {_START} + 2592000 >= {_AT}""")
def stream_campaigns(t):
    """Every order is a campaign of 30 days; its customer is the subscriber."""
    root, schema = _run_campaigns(t)
    return common.read_before(t.spark, f"{root}/feedback", None, schema).select(
        "restaurant_id", "adv_campaign_id", "client_id", "trigger_datetime_created", "feedback")


@query(f"""
SELECT o_custkey::VARCHAR AS restaurant_id, o_orderkey::VARCHAR AS adv_campaign_id, c_name AS client_id,
  {_AT} AS trigger_datetime_created, {_START} AS adv_campaign_datetime_start
FROM orders JOIN customer ON c_custkey = o_custkey WHERE {_START} <= {_AT} AND {_START} + 2592000 >= {_AT}""")
def stream_campaign_messages(t):
    """The other sink of the same stream: the messages sent out, read as JSON."""
    root, _ = _run_campaigns(t)
    sent = common.read_before(t.spark, f"{root}/messages", None, t.spark.createDataFrame([], "value string").schema)
    fields = ("restaurant_id string, adv_campaign_id string, client_id string, trigger_datetime_created bigint, "
              "adv_campaign_datetime_start bigint")
    return sent.select(F.from_json("value", fields).alias("m")).select("m.*")


def _run_campaigns(t):
    """The folder of the campaigns' two sinks, and the columns of the first."""
    start = epoch(F.col("o_orderdate"))
    texts = _messages(
        _stream(t, "orders"), F.col("o_custkey").cast("string").alias("restaurant_id"),
        F.col("o_orderkey").cast("string").alias("adv_campaign_id"), start.alias("adv_campaign_datetime_start"),
        (start + 30 * 86400).alias("adv_campaign_datetime_end"))
    subscribers = t.customer.select(F.col("c_name").alias("client_id"), F.col("c_custkey").cast("string").alias("restaurant_id"))
    at = epoch(F.lit("1998-01-01").cast("timestamp_ntz"))
    matched = campaigns.match_subscribers(parse_stream(texts, campaigns.CAMPAIGN_SCHEMA), subscribers, at)
    root = _root(t)
    handle = common.fan_out(common.folder_sink(f"{root}/feedback", campaigns.feedback_rows),
                            common.folder_sink(f"{root}/messages", campaigns.notification_messages))
    common.start(matched, handle, f"{root}/progress").awaitTermination()
    return root, campaigns.feedback_rows(campaigns.match_subscribers(
        t.spark.createDataFrame([], campaigns.CAMPAIGN_SCHEMA), subscribers, at)).schema


@query("""
SELECT o_custkey::VARCHAR AS user_id, sha256(o_orderpriority) AS product_id, o_orderpriority AS product_name, count(*) AS order_cnt
FROM orders WHERE o_orderstatus <> 'P' GROUP BY o_custkey, o_orderpriority""")
def stream_counters(t):
    """Orders as messages with their priority as the product; F = closed, O = no status, P = open."""
    texts = _order_messages(_stream(t, "orders"))
    kinds = t.orders.select(F.col("o_orderpriority").alias("product_id")).distinct()
    pk = hash_key(F.col("product_id")).alias("h_product_pk")
    names = kinds.select(pk, F.col("product_id").alias("name"), F.lit(1).alias("load_dt"))
    links = kinds.select(pk, pk.alias("h_category_pk"))
    categories = kinds.select(pk.alias("h_category_pk"), F.col("product_id").alias("category_name"))
    directory = counters.product_directory(kinds.select(pk, "product_id"), names, links, categories)
    root = _root(t)
    stream = parse_stream(texts, order_counters.ENRICHED_SCHEMA)
    common.start(stream, order_counters.counter_batch(root, directory), f"{root}/progress").awaitTermination()
    return order_counters.read_counters(t.spark, root, "product")


def _order_messages(orders: DataFrame, *more: Column) -> DataFrame:
    status = F.when(F.col("o_orderstatus") == "F", "CLOSED").when(F.col("o_orderstatus") == "P", "OPEN")
    return _messages(
        orders, hash_key(F.col("o_orderkey")).alias("h_order_pk"),
        F.col("o_custkey").cast("string").alias("h_user_pk"), status.alias("status"),
        F.array(F.struct(F.col("o_orderpriority").alias("product_id"))).alias("products"), *more)


@query("""
SELECT o_custkey::VARCHAR AS user_id, o_orderpriority AS product_id, count(*) AS order_cnt
FROM orders WHERE o_orderstatus <> 'P' GROUP BY o_custkey, o_orderpriority""")
def stream_state_counters(t):
    """Counters in Spark's own state: four deliveries in bounded batches, one of them
    delivered again, the job stopped after two batches and started again."""
    root, slot = _root(t), F.col("o_orderkey") % 4
    sent = F.timestamp_add("HOUR", slot.cast("int"), F.lit("2024-01-01").cast("timestamp"))
    texts = _order_messages(t.orders, sent.alias("sent_at"))
    inbox = _deliver(texts, root, F.hour(F.to_timestamp(F.get_json_object("value", "$.sent_at"))), 4, 1)

    def counts():
        messages = parse_stream(_inbox(t, inbox, 5), f"{order_counters.ENRICHED_SCHEMA}, sent_at timestamp")
        return order_counters.running_counts(messages)

    handle = order_counters.changed_counts(root)
    with common.state_store(t.spark):
        common.run_batches(counts(), handle, f"{root}/progress", 2, mode="update")
        common.start(counts(), handle, f"{root}/progress", mode="update").awaitTermination()
    return order_counters.current_counts(t.spark, root)


@query("""
WITH v AS (SELECT DISTINCT sha256(o_custkey::VARCHAR) AS pk, c_name AS username, o_custkey::VARCHAR AS userlogin, o_orderdate AS d
  FROM orders JOIN customer ON c_custkey = o_custkey)
SELECT pk AS h_user_pk, username, userlogin, strftime(min(d), '%Y-%m-%d %H:%M:%S') AS load_dt,
  sha256(concat_ws('|', username, userlogin)) AS hashdiff FROM v GROUP BY ALL""")
def stream_vault(t):
    """Orders as messages into the vault; the satellite of user names is read back."""
    root = _run_vault(t, F.col("o_orderstatus"), F.col("o_orderstatus"))
    with shuffles_dropped(t.spark):  # the shuffle into ranges, when they are stored
        return vault.changes(_vault_table(t, root, "s_user_names"), "h_user_pk", "load_dt")


def _sha(*columns: str) -> str:
    parts = [f"sha256({c}::VARCHAR)" for c in columns]
    return parts[0] if len(parts) == 1 else f"sha256(concat_ws('|', {', '.join(parts)}))"


# Table -> its key, and what else makes a row of it.
_VAULT_KEYS = {
    "h_order": (_sha("o_orderkey"), "1"), "h_user": (_sha("o_custkey"), "1"), "h_restaurant": (_sha("o_orderpriority"), "1"),
    "h_product": (_sha("o_orderpriority"), "1"), "h_category": (_sha("o_orderstatus"), "1"),
    "l_order_user": (_sha("o_orderkey", "o_custkey"), "1"), "l_order_product": (_sha("o_orderkey", "o_orderpriority"), "1"),
    "l_product_restaurant": (_sha("o_orderpriority", "o_orderpriority"), "1"),
    "l_product_category": (_sha("o_orderpriority", "o_orderstatus"), "1"),
    "s_order_cost": (_sha("o_orderkey"), "(o_orderdate, o_totalprice)"),
    "s_order_status": (_sha("o_orderkey"), "(o_orderdate, o_orderstatus)"), "s_user_names": (_sha("o_custkey"), "o_orderdate"),
    "s_restaurant_names": (_sha("o_orderpriority"), "o_orderdate"), "s_product_names": (_sha("o_orderpriority"), "o_orderdate"),
}


_VAULT_SQL = " UNION ALL ".join(
    f"SELECT '{table}' AS table_name, count(*) AS n_rows, count(DISTINCT k) AS n_keys, min(k) AS first_key, max(k) AS last_key "
    f"FROM (SELECT DISTINCT {key} AS k, {more} AS m FROM orders JOIN customer ON c_custkey = o_custkey)"
    for table, (key, more) in _VAULT_KEYS.items())


@query(_VAULT_SQL)
def stream_vault_tables(t):
    """Rows and keys of all tables of the vault."""
    return _vault_summary(t, _run_vault(t, F.col("o_orderstatus"), F.col("o_orderstatus")))


def _vault_summary(t, root: str) -> DataFrame:
    keys = {**{table: key for table, (_, key) in order_vault.HUBS.items()},
            **{table: key for table, (key, _) in order_vault.LINKS.items()},
            **{table: key for table, (key, _, _) in order_vault.SATELLITES.items()}}
    def summary(table: str, key: str) -> DataFrame:
        # Keys are hashes in lower-case digits: their 32 bytes are as different and in the same order.
        k = F.unhex(key)
        found = _vault_table(t, root, table).agg(
            F.count(F.lit(1)).alias("n_rows"), F.count_distinct(k).alias("n_keys"),
            *[F.lower(F.hex(end(k))).alias(f"{name}_key") for name, end in (("first", F.min), ("last", F.max))])
        return checkpointed(found.withColumn("table_name", F.lit(table)))

    with shuffles_dropped(t.spark):  # table by table, as the keys of all tables together are several times the orders
        return reduce(DataFrame.unionByName, [summary(*of) for of in keys.items()])


@query(_VAULT_SQL)
def stream_vault_restart(t):
    """The vault in bounded batches, stopped after two and started again, with one delivery
    twice: the same tables as in one batch."""
    root = _root(t)
    texts = _vault_messages(t, t.orders, F.col("o_orderstatus"), F.col("o_orderstatus"))
    inbox = _deliver(texts, root, F.get_json_object("value", "$.object_id").cast("bigint") % 3, 3, 0)

    def messages():
        return parse_stream(_inbox(t, inbox, 3), order_vault.ORDER_SCHEMA)

    handle = order_vault.vault_batch(root)
    common.run_batches(messages(), handle, f"{root}/progress", 2)
    common.start(messages(), handle, f"{root}/progress").awaitTermination()
    return _vault_summary(t, root)


@query("""
SELECT sha256(o_custkey::VARCHAR) AS user_id, sha256(left(o_orderpriority, 1)) AS category_id,
  left(o_orderpriority, 1) AS category_name, count(*) AS order_cnt
FROM orders JOIN customer ON c_custkey = o_custkey WHERE o_orderstatus <> 'P' GROUP BY ALL""")
def stream_chain(t):
    """Orders into the vault, the vault's messages and directory into the counters by category."""
    status = F.when(F.col("o_orderstatus") == "F", "CLOSED").when(F.col("o_orderstatus") == "P", "OPEN")
    root = _run_vault(t, status, F.substring("o_orderpriority", 1, 1))
    directory = counters.product_directory(*[
        _vault_table(t, root, name).select(*columns) for name, columns in (
            ("h_product", ["h_product_pk", "product_id"]), ("s_product_names", ["h_product_pk", "name", "load_dt"]),
            ("l_product_category", ["h_product_pk", "h_category_pk"]), ("h_category", ["h_category_pk", "category_name"]))])
    sent = t.spark.readStream.schema("value string").parquet(f"{root}/{order_vault.MESSAGES}/{common.BATCH}=*")
    stream = parse_stream(sent, order_counters.ENRICHED_SCHEMA)
    handle = order_counters.counter_batch(f"{root}/counted", directory)
    common.start(stream, handle, f"{root}/counted-progress").awaitTermination()
    return order_counters.read_counters(t.spark, f"{root}/counted", "category")


def _vault_messages(t, orders: DataFrame, status: Column, category: Column) -> DataFrame:
    users = t.customer.select(F.col("c_custkey").alias("o_custkey"), F.col("c_name"))
    product = F.struct(F.col("o_orderpriority").alias("id"), F.upper("o_orderpriority").alias("name"),
                       category.alias("category"))
    payload = F.struct(
        F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("date"), F.col("o_totalprice").alias("cost"),
        F.col("o_totalprice").alias("payment"), status.alias("status"),
        F.struct(F.col("o_custkey").cast("string").alias("id"), F.col("c_name").alias("name")).alias("user"),
        F.struct(F.col("o_orderpriority").alias("id"), F.col("o_orderpriority").alias("name")).alias("restaurant"),
        F.array(product).alias("products"))
    return _messages(orders.join(users, "o_custkey"), F.col("o_orderkey").cast("string").alias("object_id"),
                     payload.alias("payload"))


def _run_vault(t, status: Column, category: Column) -> str:
    """The folder of a vault that has worked off the orders."""
    root = _root(t)
    stream = parse_stream(_vault_messages(t, _stream(t, "orders"), status, category), order_vault.ORDER_SCHEMA)
    common.start(stream, order_vault.vault_batch(root), f"{root}/progress").awaitTermination()
    return root


def _vault_table(t, root: str, name: str) -> DataFrame:
    return t.spark.read.parquet(f"{root}/{name}").drop(common.BATCH)
