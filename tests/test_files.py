"""Readers and writers."""

import datetime as dt
import glob
import os

import pytest
from pyspark.sql import functions as F

from martloom.session import ensure_checkpoint_dir
from martloom.sinks import tables
from martloom.sources import files, jdbc, streams
from tests.helpers import frame, plan, rows


def _write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)
    return str(path)


def test_csv_with_null_token_and_inferred(spark, tmp_path):
    path = _write(f"{tmp_path}/a.csv", "id,origin\n1,null\n2,Korea\n")
    assert rows(files.read_csv(spark, path, "id int, origin string")) == [(1, None), (2, "Korea")]
    geo = _write(f"{tmp_path}/g.csv", "id;city;lat\n1;Perth;-31.9\n")
    assert rows(files.read_csv(spark, geo, sep=";", infer=True)) == [(1, "Perth", -31.9)]
    with pytest.raises(ValueError):
        files.read_csv(spark, path)


def test_increment_without_status(spark, tmp_path):
    fields = {"uniq_id": "string", "quantity": "int", "status": "string"}
    old = _write(f"{tmp_path}/old.csv", "id,uniq_id,quantity\n1,a,3\n")
    new = _write(f"{tmp_path}/new.csv", "id,status,uniq_id,quantity\n1,refunded,b,4\n")
    read = [files.read_increment(spark, p, fields, defaults={"status": "shipped"}) for p in (old, new)]
    assert rows(read[0].unionByName(read[1])) == [("a", 3, "shipped"), ("b", 4, "refunded")]


def test_increments_of_one_folder_drift(spark, tmp_path):
    fields = {"uniq_id": "string", "quantity": "int", "status": "string", "amount": "double"}
    _write(f"{tmp_path}/in/a.csv", "id,uniq_id,quantity,amount\n1,a,3,20\n2,status,4,30\n")
    _write(f"{tmp_path}/in/b.csv", 'amount,"status",uniq_id,id,quantity\n40,refunded,b,1,5\n')
    _write(f"{tmp_path}/in/c.csv", "id,uniq_id,quantity,amount\n3,c,6,50\n")
    got = files.read_increment(spark, f"{tmp_path}/in", fields, defaults={"status": "shipped"})
    assert rows(got) == [("a", 3, "shipped", 20.0), ("b", 5, "refunded", 40.0), ("c", 6, "shipped", 50.0), ("status", 4, "shipped", 30.0)]


def test_no_file_of_an_increment_is_lost(spark, tmp_path):
    fields = {"uniq_id": "string", "city": "string", "amount": "int"}
    _write(f"{tmp_path}/in/1.csv", "a,b,c,d,city,amount,id\n1,2,3,4,Perth,7,x\n")  # mostly unknown names
    _write(f"{tmp_path}/in/2.csv", '\ufeffamount,"uniq_id"\n8,"u,2"\n9,u3\n')
    _write(f"{tmp_path}/in/3.csv", "uniq_id,city,amount\n")  # a header only
    _write(f"{tmp_path}/in/4.csv", "")
    got = files.read_increment(spark, f"{tmp_path}/in", fields, defaults={"city": "?"})
    assert rows(got) == [("u,2", "?", 8), ("u3", "?", 9), (None, "Perth", 7)]
    _write(f"{tmp_path}/in/5.csv", "uniq_id;city;amount\nv;w;1\n")
    with pytest.raises(ValueError, match="5.csv"):
        files.read_increment(spark, f"{tmp_path}/in", fields)
    assert rows(files.read_increment(spark, f"{tmp_path}/in/5.csv", fields, sep=";")) == [("v", "w", 1)]


def test_day_file():
    assert files.day_file("s3a://bucket/%Y/%m/group_log-%Y-%m-%d.csv", "2024-03-09") == "s3a://bucket/2024/03/group_log-2024-03-09.csv"


def test_responses_land_as_text(spark, tmp_path):
    files.land_raw_text(frame(spark, "category string, body string", ("people", "{}"), ("films", "[1]")), f"{tmp_path}/raw")
    assert rows(spark.read.text(f"{tmp_path}/raw"), "category", "value") == [("films", "[1]"), ("people", "{}")]


def test_group_log_and_records(spark, tmp_path):
    log = _write(f"{tmp_path}/log.csv", "group_id,user_id,user_id_from,event,datetime\n1,2,,add,2024-01-01 10:00:00\n1,3,4.0,leave,\n")
    got = files.read_group_log(spark, log)
    assert rows(got) == [(1, 2, None, "add", dt.datetime(2024, 1, 1, 10)), (1, 3, 4, "leave", None)]
    models = _write(f"{tmp_path}/models.txt", "1;Kia;Optima\n2;Mazda;3\n")
    assert rows(files.read_records(spark, models, "id int, brand string, name string")) == [(1, "Kia", "Optima"), (2, "Mazda", "3")]


def test_event_days_prune_partitions(spark, tmp_path):
    df = frame(spark, "date string, event struct<user: int, message: string>", ("2024-01-01", (1, "x")), ("2024-01-02", (2, "y")))
    tables.write_table(df, f"{tmp_path}/events", partition_by=["date"], sort_by=["event"])
    day = files.read_events(spark, f"{tmp_path}/events", ["2024-01-02"]).select("event.user")
    assert rows(day) == [(2,)]
    assert "PartitionFilters: [isnotnull(date" in plan(day) or "PartitionFilters: [date" in plan(day)
    assert "message" not in plan(day).split("ReadSchema")[1]


def test_landed_pages_and_raw_text(spark, tmp_path):
    _write(f"{tmp_path}/p/1.json", '[{"_id": "1", "name": "Al"},\n {"_id": "2", "name": "Bo"}]')
    _write(f"{tmp_path}/p/2.json", '[{"_id": "3", "name": "Cy"}]')
    assert files.read_pages(spark, f"{tmp_path}/p", "_id string, name string").count() == 3
    _write(f"{tmp_path}/raw/people.txt", '{"results":\n []}')
    assert rows(files.read_raw_text(spark, f"{tmp_path}/raw")) == [("people", '{"results":\n []}')]


def test_publish_keeps_readers_on_one_version(spark, tmp_path):
    table = f"{tmp_path}/mart"
    assert tables.current_version(spark, table) is None
    with pytest.raises(FileNotFoundError):
        tables.read_version(spark, table)
    tables.publish(spark.range(3), table)
    before = tables.read_version(spark, table)
    assert tables.publish(before.filter("id > 0"), table) == 1  # reads the version it replaces
    assert before.count() == 3 and tables.read_version(spark, table).count() == 2
    assert tables.publish(spark.range(5), table, version=1) == 1
    assert tables.read_version(spark, table).count() == 5


def test_watermark_table(spark, tmp_path):
    table, at = f"{tmp_path}/mark", dt.datetime(2024, 1, 1, 10, 0, 0, 5)
    assert tables.get_watermark(spark, table) is None
    tables.set_watermark(spark, table, at)
    assert tables.get_watermark(spark, table) == at


def test_replace_slice_twice_is_once(spark, tmp_path):
    path = f"{tmp_path}/facts"
    both = frame(spark, "v int, day string", (1, "2024-01-01"), (2, "2024-01-02"))
    tables.write_table(both, path, partition_by=["day"])
    fresh = frame(spark, "v int, day string", (9, "2024-01-02"), (8, "2024-01-03"))
    for _ in range(2):
        tables.replace_slice(fresh, path, "day", "2024-01-02")
        assert rows(spark.read.parquet(path), "v") == [(1,), (9,)]


def test_replace_slice_with_nothing_empties_the_day(spark, tmp_path):
    path = f"{tmp_path}/facts"
    both = frame(spark, "v int, day string", (1, "2024-01-01"), (2, "2024-01-02"))
    tables.write_table(both, path, partition_by=["day"])
    tables.replace_slice(both.limit(0), path, "day", "2024-01-01")
    assert rows(spark.read.parquet(path), "v", "day") in ([(2, dt.date(2024, 1, 2))], [(2, "2024-01-02")])


def test_append_views_stage_and_buckets(spark, tmp_path):
    path = f"{tmp_path}/log"
    for _ in range(2):
        tables.write_table(spark.range(2), path, mode="append")
    df = spark.read.parquet(path)
    tables.register_view(df, "log_view")
    assert spark.sql("select count(*) from log_view").first()[0] == 4
    staged = tables.stage(df)
    assert staged.is_cached
    staged.unpersist()
    spark.sql(f"create database if not exists lake location '{tmp_path}/lake'")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name in ("a", "b"):
            tables.write_bucketed(spark.range(100).toDF("k"), f"lake.{name}", "k", 4, ["k"])
        joined = spark.table("lake.a").join(spark.table("lake.b"), "k")
        assert "Exchange" not in plan(joined) and joined.count() == 100
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.sql("drop database lake cascade")


def test_checkpoint_dir_is_kept(spark):
    assert ensure_checkpoint_dir(spark) == ensure_checkpoint_dir(spark)


DERBY = "org.apache.derby.iapi.jdbc.AutoloadedDriver"


def test_jdbc_in_process(spark, tmp_path):
    """Embedded Derby: a database inside this process, no server and no port."""
    if not glob.glob(os.path.join(os.path.dirname(__import__("pyspark").__file__), "jars", "derby-*.jar")):
        pytest.skip("no embedded database on the class path")
    url, opts = f"jdbc:derby:{tmp_path}/db;create=true", {"driver": DERBY}
    df = frame(spark, "id int, status string, at timestamp", (1, "done", dt.datetime(2024, 1, 1, 23)),
               (2, "queued", dt.datetime(2024, 1, 1, 5)), (3, "done", dt.datetime(2024, 1, 2)))
    jdbc.write_jdbc(df, url, "tx", createTableColumnTypes="status VARCHAR(20)", **opts)
    jdbc.write_jdbc(df.filter("id = 3").withColumn("id", F.lit(None).cast("int")), url, "tx", **opts)
    assert jdbc.read_jdbc(spark, url, "tx", **opts).count() == 4
    day = jdbc.read_jdbc_slice(spark, url, "tx", "at", "2024-01-01", F.col("status") == "done", **opts)
    assert rows(day, "ID") == [(1,)]
    assert "PushedFilters" in plan(day) and "status" in plan(day).split("PushedFilters")[1].lower()


def test_kafka_needs_its_connector(spark):
    with pytest.raises(Exception, match="kafka"):
        streams.read_stream_kafka(spark, {"kafka.bootstrap.servers": "none", "subscribe": "t"})


def test_bucketed_tables_join_without_a_shuffle(spark, tmp_path):
    left = spark.range(1000).select((F.col("id") % 97).alias("k"), "id")
    right = spark.range(97).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    joined = tables.bucketed_pair(left, right, "k", f"{tmp_path}/pair-1", 4)
    assert "Exchange" not in plan(joined)
    assert "SortMergeJoin" in plan(joined)
    assert rows(joined.groupBy().agg(F.sum("v"))) == rows(left.join(right, "k").groupBy().agg(F.sum("v")))
    assert len(glob.glob(f"{tmp_path}/pair-1/left/*.parquet")) <= 4
