"""Stored tables of which a change reads and replaces only its parts."""

import datetime as dt
import glob
import os

from pyspark.sql import functions as F

from martloom.plans import report_store
from martloom.sinks import parted
from tests.helpers import frame, plan, rows


def _files(path):
    return {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{path}/**/*.parquet", recursive=True)}


def test_merge_touches_only_its_parts(spark, tmp_path):
    path, part = f"{tmp_path}/t", parted.by_range("k", 10)
    old = frame(spark, "k long, a string, b int", *[(k, f"a{k}", k) for k in range(50)], (None, "none", -1))
    parted.write_parted(old, path, part)
    before = _files(path)
    new = frame(spark, "k long, a string, b int", (12, "new", 1), (77, "more", 2), (15, None, 3))
    merged, parts = parted.touched(path, new, ["k"], part, ["a"])
    assert parts == [1, 7] and "PartitionFilters: [" in plan(merged) and "part#" in plan(merged).split("PartitionFilters: [")[1][:60]
    assert parted.merge_into(path, new, ["k"], part, ["a"]) == [1, 7]
    want = {k: (f"a{k}", k) for k in range(50)} | {12: ("new", 12), 15: (None, 15), 77: ("more", 2), None: ("none", -1)}
    assert {r.k: (r.a, r.b) for r in spark.read.parquet(path).collect()} == want
    after = _files(path)
    assert {f: t for f, t in before.items() if "part=1/" not in f}.items() <= after.items()
    assert not {f for f in before if "part=1/" in f} & set(after)
    # Again, and with nothing: the same table.
    parted.merge_into(path, new, ["k"], part, ["a"])
    assert parted.merge_into(path, new.limit(0), ["k"], part) == []
    assert {r.k: (r.a, r.b) for r in spark.read.parquet(path).collect()} == want


def test_hashed_parts_take_every_key(spark, tmp_path):
    part = parted.by_hash(["k", "j"], 7)
    df = frame(spark, "k string, j int, v int", *[(f"k{i}", i, i) for i in range(30)])
    parted.write_parted(df, f"{tmp_path}/t", part)
    parted.merge_into(f"{tmp_path}/t", df.withColumn("v", F.col("v") + 1), ["k", "j"], part)
    assert rows(spark.read.parquet(f"{tmp_path}/t"), "k", "j", "v") == rows(df.withColumn("v", F.col("v") + 1))


def _lines(spark, *data):
    schema = ("order_id long, product_id long, craftsman_id long, customer_id long, order_created_date date, "
              "order_completion_date date, order_status string, load_dttm timestamp_ntz")
    day = lambda d: dt.date(2024, 1, d)
    return frame(spark, schema, *[(o, p, 1, c, day(d), None, "done", dt.datetime(2024, 1, d)) for o, p, c, d in data])


def test_new_lines_name_their_owners_without_old_files(spark, tmp_path):
    facts = f"{tmp_path}/facts"
    report_store.store_facts(_lines(spark, (1, 1, 1, 1), (2, 2, 2, 1), (3, 1, 3, 2)), facts, "customer_id", 4)
    report_store.append_facts(_lines(spark, (4, 2, 2, 9)), facts, "customer_id", 4)
    fresh = report_store.new_lines(spark, facts, "2024-01-05")
    assert rows(fresh, "order_id") == [(4,)] and "load_day" in plan(fresh).split("PartitionFilters: [")[1][:200]
    at = dt.datetime(2024, 1, 1)
    dim = lambda key, *ids: frame(spark, f"{key} long, load_dttm timestamp_ntz", *[(i, at) for i in ids])
    dims = {"customer_id": dim("customer_id", 1, 2, 3), "craftsman_id": dim("craftsman_id", 1), "product_id": dim("product_id", 1, 2)}
    found = report_store.owners_of_changes(spark, facts, dims, "customer_id", "2024-01-05")
    assert rows(found) == [(2,)]
    dims["product_id"] = frame(spark, "product_id long, load_dttm timestamp_ntz", (1, dt.datetime(2024, 1, 8)), (2, at))
    assert rows(report_store.owners_of_changes(spark, facts, dims, "customer_id", "2024-01-05")) == [(1,), (2,), (3,)]


def test_a_stored_fact_table_has_few_files_however_many_load_days(spark, tmp_path):
    facts = f"{tmp_path}/facts"
    lines = spark.range(4_000).selectExpr(
        "id AS order_id", "id % 50 AS customer_id", "timestamp_ntz '2022-01-01 12:00:00' + make_interval(0, 0, 0, cast(id % 700 AS int)) AS load_dttm")
    old = F.col("load_dttm") < F.lit("2023-11-01").cast("timestamp_ntz")
    report_store.store_facts(lines.filter(old), facts, "customer_id", 4)
    report_store.append_facts(lines.filter(~old).repartition(8), facts, "customer_id", 4)
    assert len(_files(facts)) <= 4 * 3  # two years at first, one that goes on
    assert {r.order_id for r in spark.read.parquet(facts).collect()} == set(range(4_000))
    fresh = report_store.new_lines(spark, facts, "2023-11-30 12:00:00")
    assert {r.order_id for r in fresh.collect()} == {i for i in range(4_000) if i % 700 == 699}
