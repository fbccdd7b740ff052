import datetime as dt
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import Window

from martloom.functions.geo import CITIES, haversine
from martloom.operators import aggregates, cells, filters, joins, merge, nearest, pairs, progress, ranges, skew, vault, windows
from tests.helpers import frame, plan, rows


# --- merge ----------------------------------------------------------------------

def test_keyed_merge_updates_inserts_keeps(spark):
    t = frame(spark, "k int, a string, b int", (1, "x", 1), (2, "y", 2))
    s = frame(spark, "k int, a string, b int", (2, None, 20), (3, "z", 30))
    assert rows(merge.keyed_merge(t, s, ["k"])) == [(1, "x", 1), (2, None, 20), (3, "z", 30)]
    assert rows(merge.keyed_merge(t, s, ["k"], ["b"])) == [(1, "x", 1), (2, "y", 20), (3, "z", 30)]
    once = merge.keyed_merge(t, s, ["k"])
    assert rows(merge.keyed_merge(once, s, ["k"])) == rows(once)


def test_keyed_merge_rejects_a_repeated_source_key(spark):
    t = frame(spark, "k int, a string", (1, "x"))
    s = frame(spark, "k int, a string", (1, "p"), (1, "q"))
    with pytest.raises(Exception, match="repeated key"):
        merge.keyed_merge(t, s, ["k"]).collect()


def test_insert_ignore_is_idempotent(spark):
    t = frame(spark, "k int, a string", (1, "old"))
    s = frame(spark, "k int, a string", (1, "new"), (2, "b"), (2, "a"))
    once = merge.insert_ignore(t, s, ["k"], ["a"])
    assert rows(once) == [(1, "old"), (2, "a")]
    assert rows(merge.insert_ignore(once, s, ["k"], ["a"])) == rows(once)


def test_update_delete_rename_replace(spark):
    t = frame(spark, "k int, a string", (1, "x"), (2, "y"))
    assert rows(merge.update_from(t, frame(spark, "k int, a string", (2, None), (9, "q")), ["k"], ["a"])) == [(1, "x"), (2, None)]
    assert rows(merge.update_where(t, F.col("k") == 1, {"a": F.lit("z")})) == [(1, "z"), (2, "y")]
    assert rows(merge.delete_by_key(t, frame(spark, "k int", (1,), (1,)), ["k"])) == [(2, "y")]
    assert rows(merge.rename_key(t, frame(spark, "k int, n int", (2, 7)), "k", "n")) == [(1, "x"), (7, "y")]
    again = merge.replace_rows(t, frame(spark, "k int, a string", (2, "new")), F.col("k") == 2)
    assert rows(again) == [(1, "x"), (2, "new")]
    assert rows(merge.replace_rows(again, frame(spark, "k int, a string", (2, "new")), F.col("k") == 2)) == rows(again)


# --- joins and filters ------------------------------------------------------------

def test_not_in_with_null_is_empty(spark):
    df = frame(spark, "k int", (1,), (2,), (None,))
    seen = frame(spark, "k int", (1,), (None,))
    assert rows(joins.anti_join(df, seen, ["k"])) == [(2,), (None,)]
    assert rows(joins.anti_join(df, seen, ["k"], null_aware=True)) == []
    assert rows(joins.anti_join(df, seen.dropna(), ["k"], null_aware=True)) == [(2,)]
    assert rows(joins.anti_join(df, seen.limit(0), ["k"], null_aware=True)) == [(1,), (2,), (None,)]


def test_missing_status_passes_but_open_does_not(spark):
    df = frame(spark, "id int, h_user_pk string, status string, products array<string>",
               (1, "u", "CLOSED", ["p"]), (2, "u", None, ["p"]), (3, "u", "OPEN", ["p"]), (4, None, None, ["p"]),
               (5, "u", None, []), (6, "u", None, None), (7, "", "CLOSED", ["p"]))
    assert rows(filters.valid_orders(df), "id") == [(1,), (2,)]


def test_small_join_shapes(spark):
    left = frame(spark, "k int, ts timestamp_ntz", (1, dt.datetime(2024, 1, 1, 9)), (1, dt.datetime(2024, 1, 2, 9)))
    quotes = frame(spark, "k int, at timestamp_ntz, rate int", (1, dt.datetime(2024, 1, 1), 5))
    assert rows(joins.join_on_day(left, quotes, "k", "ts", "at"), "k", "rate") == [(1, 5)]
    detail = frame(spark, "k int, v int", (1, 2), (1, 3))
    assert rows(joins.sum_then_join(frame(spark, "k int", (1,), (2,)), detail, "k", "v", "t")) == [(1, 5), (2, 0)]
    names = frame(spark, "k int, name string, load_dt int", (1, "old", 1), (1, "new", 2))
    assert rows(joins.latest_name(frame(spark, "k int", (1,), (2,)), names, "k", "name", "load_dt")) == [(1, "new"), (2, "unknown")]
    links = frame(spark, "k int, c string", (1, "b"), (1, "a"))
    assert rows(joins.any_linked(frame(spark, "k int", (1,), (2,)), links, "k", "c")) == [(1, "a")]


def test_changed_since_any_column(spark):
    df = frame(spark, "k int, a timestamp_ntz, b timestamp_ntz", (1, dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 1)),
               (2, dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 3)), (3, dt.datetime(2024, 1, 3), None))
    assert rows(filters.changed_since(df, ["a", "b"], dt.datetime(2024, 1, 2)), "k") == [(2,), (3,)]
    assert filters.changed_since(df, ["a"], None).count() == 3


def test_watermark_stays_without_a_delta(spark):
    empty = spark.createDataFrame([], "load_dttm timestamp_ntz")
    mark = dt.datetime(2024, 1, 1)
    assert progress.advance(mark, progress.newest({"a": empty})) == mark
    newer = frame(spark, "load_dttm timestamp_ntz", (dt.datetime(2024, 2, 1),))
    assert progress.advance(mark, progress.newest({"a": empty, "b": newer})) == dt.datetime(2024, 2, 1)


# --- skew -------------------------------------------------------------------------

@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows under key 7."""
    return spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 1000).cast("bigint").alias("k"), "id").cache()


def test_hot_keys_are_found(spark, skewed):
    assert skew.hot_keys(skewed, "k") == [7]
    assert skew.hot_keys(spark.range(10_000).toDF("k"), "k") == []


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_skew_join_equals_plain_join(spark, skewed, how):
    dim = spark.range(0, 500).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    got, want = skew.skew_join(skewed, dim, "k", how), skewed.join(dim, "k", how)
    assert got.exceptAll(want.select(*got.columns)).isEmpty() and got.count() == want.count()


def _walk(spark, n=4000, users=5):
    rng = random.Random(3)
    data = [(i, 0 if rng.random() < 0.4 else rng.randrange(users),
             dt.datetime(2024, 1, 1) + dt.timedelta(minutes=rng.randrange(20_000)),
             rng.choice(["a", "b", None])) for i in range(n)]
    return spark.createDataFrame(data, "id int, u int, ts timestamp_ntz, z string")


def test_lag_over_ranges_equals_lag(spark, many_parts):
    df = _walk(spark).unionByName(_walk(spark).withColumns({"u": F.lit(None).cast("int"), "id": F.col("id") + 100_000}))
    want = df.withColumn("p", F.lag("z").over(Window.partitionBy("u").orderBy("ts", "id")))
    assert rows(ranges.previous_value(df, ["u"], ["ts", "id"], "z", "p"), "id", "p") == rows(want, "id", "p")
    assert ranges.previous_value(df.limit(0), ["u"], ["ts", "id"], "z").count() == 0


def test_a_key_with_all_rows_in_one_hour_is_split(spark, many_parts):
    df = spark.range(8000).select("id", F.lit(7).alias("u"), F.lit("2024-01-01 10:00:00").cast("timestamp_ntz").alias("ts"),
                                  (F.col("id") % 3).alias("z"))
    parts = ranges.in_ranges(df, ["u", "ts", "id"]).groupBy(ranges.PART).count()
    assert parts.count() >= 4 and parts.agg(F.max("count")).first()[0] < 4000
    want = df.withColumn("p", F.lag("z").over(Window.partitionBy("u").orderBy("ts", "id")))
    assert rows(ranges.previous_value(df, ["u"], ["ts", "id"], "z", "p"), "id", "p") == rows(want, "id", "p")


def test_running_values_over_ranges(spark, many_parts):
    df = _walk(spark).unionByName(_walk(spark).withColumns({"u": F.lit(None).cast("int"), "id": F.col("id") + 100_000}))
    parts = ranges.in_ranges(df, ["u", "ts", "id"])
    upto = Window.partitionBy("u").orderBy("ts", "id").rowsBetween(Window.unboundedPreceding, 0)
    want = df.select("id", F.sum("id").over(upto).alias("s"), F.sum(F.lit(1)).over(upto).alias("n"))
    got = ranges.running(parts, ["u"], ["u", "ts", "id"], {"s": F.col("id"), "n": F.lit(1)})
    assert rows(got, "id", "s", "n") == rows(want)
    overall = Window.orderBy("u", "ts", "id").rowsBetween(Window.unboundedPreceding, 0)
    want = df.select("id", F.last("z", ignorenulls=True).over(overall).alias("seen"))
    assert rows(ranges.last_seen(parts, ["u", "ts", "id"], {"seen": F.col("z")}), "id", "seen") == rows(want)


def test_median_over_ranges(spark, many_parts):
    rng = random.Random(3)
    data = [(rng.choice(["hot", "hot", "hot", "b", None]), None if rng.random() < 0.05 else rng.randrange(10**6)) for _ in range(3001)]
    data += [("nulls", None), ("one", 5), ("two", 4), ("two", 7), *[("same", 9)] * 10]
    df = frame(spark, "k string, v long", *data).repartition(4)
    want = df.groupBy("k").agg(F.median("v").alias("m"))
    assert rows(aggregates.median_over_ranges(df, ["k"], "v", "m")) == rows(want)
    assert rows(aggregates.median_over_ranges(df.limit(0), ["k"], "v", "m")) == []


def test_text_in_chunks(spark, many_parts):
    df = frame(spark, "k string, v string", *[("a", f"{i:03}") for i in range(25)] * 2, ("a", None), ("b", "x"), (None, "y"))
    got = aggregates.string_agg_chunks(df, ["k"], "v", "t", 10, ",")
    texts = {(r.k, r.chunk): r.t for r in got.collect()}
    assert set(texts) == {("a", 0), ("a", 1), ("a", 2), ("b", 0), (None, 0)}
    assert ",".join(texts["a", i] for i in range(3)) == ",".join(f"{i:03}" for i in range(25))


def test_change_count_equals_lag(spark, many_parts):
    df = _walk(spark).dropna()
    p = F.lag("z").over(Window.partitionBy("u").orderBy("ts", "id"))
    want = df.withColumn("c", F.when(p != F.col("z"), 1).otherwise(0)).groupBy("u").agg(F.sum("c").alias("n"))
    assert rows(ranges.count_changes(df, ["u"], ["ts", "id"], "z", "n")) == rows(want)
    flags = windows.flag_change(df, ["u"], ["ts", "id"], "z")
    assert rows(flags.groupBy("u").agg(F.sum("is_change").alias("n"))) == rows(want)


# --- windows and aggregates ---------------------------------------------------------

def test_top_n_limits_groups_before_the_shuffle(spark, skewed):
    text = plan(windows.top_n(skewed, ["k"], ["id"], 1))
    assert text.count("WindowGroupLimit") == 2 and "Partial" in text


def test_islands_two_cities_in_one_day_keep_both_runs(spark):
    days = [(1, "a", dt.date(2024, 1, 1) + dt.timedelta(days=i)) for i in range(28)] + [(1, "b", dt.date(2024, 1, 5))]
    df = frame(spark, "u int, z string, d date", *days)
    assert rows(windows.islands(df, ["u", "z"], "d"), "z", "days") == [("a", 28), ("b", 1)]


@pytest.mark.parametrize("days,home", [(26, []), (27, [("a",)]), (28, [("a",)])])
def test_home_needs_27_days(spark, days, home):
    df = frame(spark, "u int, z string, d date", *[(1, "a", dt.date(2024, 1, 1) + dt.timedelta(days=i)) for i in range(days)])
    assert rows(windows.home_state(df, "u", "z", "d"), "z") == home


def test_numbers_are_consecutive(spark):
    df = spark.range(1000).select((F.col("id") * 37 % 1000).alias("k"))
    got = windows.number_rows(df, ["k"], 100, "n", partitions=7)
    assert rows(got.select(F.min("n"), F.max("n"), F.count_distinct("n"), F.count_if(F.col("n") != F.col("k") + 100))) == [
        (100, 1099, 1000, 0)]


def test_pct_change_without_or_with_zero_before(spark):
    df = frame(spark, "a int, b int", (110, 100), (1, None), (1, 0)).select(
        *[F.col(c).cast("decimal(9,2)").alias(c) for c in "ab"])
    got = [r[0] for r in df.select(windows.pct_change(F.col("a"), F.col("b"))).collect()]
    assert [None if v is None else float(v) for v in got] == [10.0, None, None]


def test_median_matches_percentile(spark):
    rng = random.Random(1)
    data = [(rng.randrange(6), rng.choice([None, *range(20)])) for _ in range(400)] + [(9, None)]
    df = spark.createDataFrame(data, "k int, v int")
    assert rows(aggregates.median_by(df, ["k"], "v")) == rows(df.groupBy("k").agg(F.median("v").alias("median")))


def test_counters_over_halves_equal_the_whole(spark):
    df = spark.range(100).select((F.col("id") % 7).alias("k"), F.col("id"))
    def counted(part):
        return part.groupBy("k").agg(F.count("*").alias("n"))

    halves = aggregates.add_counts(counted(df.filter("id < 50")), counted(df.filter("id >= 50")), ["k"], "n")
    assert rows(halves) == rows(counted(df))


def test_null_percentage_keeps_the_fraction(spark):
    df = frame(spark, "v int", (1,), (None,), (3,))
    assert float(aggregates.null_pct(df, "v").first()[0]) == 33.33


def test_string_agg_is_sorted_and_distinct(spark):
    df = frame(spark, "k int, v string", (1, "b"), (1, "a"), (1, "b"), (1, None))
    assert rows(aggregates.string_agg_distinct(df, ["k"], "v", "s")) == [(1, "a, b")]


# --- nearest and pairs ----------------------------------------------------------------

def _points(spark, n=300):
    rng = random.Random(5)
    return spark.createDataFrame([(i, rng.uniform(-45, -10), rng.uniform(112, 155)) for i in range(n)],
                                 "id int, lat double, lon double")


def _brute(df, ref, box=None):
    joined = df.crossJoin(ref).withColumn("d", haversine(F.col("lat"), F.col("lon"), F.col("rlat"), F.col("rlng")))
    if box:
        joined = joined.filter((F.abs(F.col("lat") - F.col("rlat")) < box) & (F.abs(F.col("lon") - F.col("rlng")) < box))
    return joined.groupBy("id").agg(F.min_by("zone_id", "d").alias("zone_id"))


@pytest.mark.parametrize("box", [None, 1.0, 4.0])
@pytest.mark.parametrize("limit", [nearest.MAX_INLINE, 5])
def test_nearest_small_and_large_reference(spark, monkeypatch, box, limit):
    monkeypatch.setattr(nearest, "inline_reference", lambda ref: None) if limit == 5 else None
    points = _points(spark)
    ref = spark.createDataFrame([(c[1].lower(), c[2], c[3], c[4]) for c in CITIES], "zone_id string, lat double, lng double, timezone string")
    brute = _brute(points, ref.select("zone_id", F.col("lat").alias("rlat"), F.col("lng").alias("rlng")), box)
    got = nearest.nearest(points, ref, box_deg=box)
    assert rows(got, "id", "zone_id") == rows(brute, "id", "zone_id")


def test_nearest_far_from_every_reference_point(spark, monkeypatch):
    monkeypatch.setattr(nearest, "inline_reference", lambda ref: None)
    points = frame(spark, "id int, lat double, lon double", (1, 60.0, -30.0), (2, 89.0, 10.0), (3, -89.0, -170.0))
    ref = spark.createDataFrame([(c[1].lower(), c[2], c[3], c[4]) for c in CITIES], "zone_id string, lat double, lng double, timezone string")
    brute = _brute(points, ref.select("zone_id", F.col("lat").alias("rlat"), F.col("lng").alias("rlng")))
    assert rows(nearest.nearest(points, ref), "id", "zone_id") == rows(brute, "id", "zone_id")


@pytest.mark.parametrize("box", [None, 30.0])
def test_nearest_has_one_contract_for_every_reference_size(spark, box):
    points = frame(spark, "id int, lat double, lon double", (1, -20.0, 120.0), (1, -20.0, 120.0), (2, None, 120.0),
                   (3, -20.0, None), (4, 60.0, -100.0), (5, -33.3, 140.7))
    answers = []
    for n in (nearest.MAX_INLINE - 1, nearest.MAX_INLINE, nearest.MAX_INLINE + 1):
        ref = spark.createDataFrame([(f"z{i:03}", *((-40.0 + 3 * i, 115.0 + 3 * i) if i < 10 else (80.0 + i * 0.01, -170.0)), "UTC") for i in range(n)],
                                    "zone_id string, lat double, lng double, timezone string")
        got = nearest.nearest(points, ref, box_deg=box)
        answers.append(rows(got.select("id", "zone_id", F.round("distance_km", 6))))
    assert answers[0] == answers[1] == answers[2]
    assert [r[0] for r in answers[0]] == ([1, 1, 2, 3, 4, 5] if box is None else [1, 1, 5])
    assert {r[0] for r in answers[0] if r[1] is None} == ({2, 3} if box is None else set())


@pytest.mark.parametrize("leaf_rows", [4, 256])
@pytest.mark.parametrize("box", [None, 0.7, 8.0])
def test_nearest_among_dense_points(spark, monkeypatch, box, leaf_rows):
    monkeypatch.setattr(cells, "LEAF_ROWS", leaf_rows)
    rng = random.Random(3)
    towns = [(-33.8, 151.2, 1e-4), (10.0, 179.99, 0.3), (89.9, 0.0, 0.2), (0.0, 0.0, 5.0)]
    at = [(lat + rng.gauss(0, s), lon + rng.gauss(0, s)) for lat, lon, s in towns for _ in range(80)]
    spots = [(f"z{i:03}", *p, "UTC") for i, p in enumerate(at)] + [("a", *at[0], "UTC"), ("a", *at[0], "CET"), ("n", None, 1.0, "UTC")]
    ref = spark.createDataFrame(spots, "zone_id string, lat double, lng double, timezone string")
    points = [(lat + rng.gauss(0, 2 * s), lon + rng.gauss(0, 2 * s)) for lat, lon, s in towns for _ in range(30)]
    points = spark.createDataFrame([(i, *p) for i, p in enumerate([*points, at[0]])], "id int, lat double, lon double")
    brute = _brute(points, ref.filter("zone_id not like 'z000'").select("zone_id", F.col("lat").alias("rlat"), F.col("lng").alias("rlng")), box)
    got = nearest.nearest(points, ref, box_deg=box)
    assert rows(got, "id", "zone_id") == rows(brute.filter("zone_id is not null"), "id", "zone_id")
    assert got.filter("id = 120").select("zone_id", "timezone", "distance_km").collect() == [("a", "CET", 0.0)]


@pytest.mark.parametrize("box", [None, 5.0])
def test_nearest_looks_at_few_cells_of_a_dense_reference(spark, monkeypatch, box):
    monkeypatch.setattr(cells, "LEAF_ROWS", 8)
    rng, reached, descend = random.Random(6), [], nearest.descend

    def kept(*args):
        reached.append(descend(*args))
        return reached[-1]

    monkeypatch.setattr(nearest, "descend", kept)
    at = [(rng.uniform(-20, -10), rng.uniform(120, 130)) for _ in range(1200)]
    ref = spark.createDataFrame([(f"z{i:04}", *p, "UTC") for i, p in enumerate(at)], "zone_id string, lat double, lng double, timezone string")
    points = spark.createDataFrame([(i, rng.uniform(-20, -10), rng.uniform(120, 130)) for i in range(300)], "id int, lat double, lon double")
    got = nearest.nearest(points, ref, box_deg=box)
    brute = _brute(points, ref.select("zone_id", F.col("lat").alias("rlat"), F.col("lng").alias("rlng")), box)
    assert rows(got, "id", "zone_id") == rows(brute, "id", "zone_id")
    assert reached[0].count() < 8 * 300  # without a bound from the own cell 10 to 12 for each place


def test_no_cell_holds_more_points_than_its_bound(spark):
    rng = random.Random(4)
    points = spark.createDataFrame([(rng.gauss(0, 10.0 ** -rng.randrange(7)), rng.gauss(0, 1e-5)) for _ in range(2000)], "x double, y double")
    leaves, splits = cells.split_cells(points, ["x", "y"], 16.0, 8)
    assert len(splits) > 3 and rows(leaves.select("x", "y")) == rows(points)
    assert leaves.groupBy("_cell").count().filter("count > 8").isEmpty()


@pytest.mark.parametrize("block", [3, 2000])
def test_pairs_within_equal_brute_force(spark, block):
    rng = random.Random(9)
    people = [(i, rng.randrange(2), rng.gauss(0, 0.5), 179.9 + rng.gauss(0, 0.5)) for i in range(120)]
    people = [(i, g, a, o - 360 if o > 180 else o) for i, g, a, o in people]
    df = spark.createDataFrame(people, "u int, g int, lat double, lon double")
    a, b = df.alias("a"), df.alias("b")
    brute = a.join(b, (F.col("a.g") == F.col("b.g")) & (F.col("a.u") < F.col("b.u"))).filter(
        haversine(F.col("a.lat"), F.col("a.lon"), F.col("b.lat"), F.col("b.lon")) <= 50)
    got = pairs.pairs_within(df, ["g"], "u", "lat", "lon", 50, block=block)
    assert rows(got, "user_left", "user_right") == rows(brute, "a.u", "b.u")


@pytest.mark.parametrize("block", [2, 2000])
def test_co_members_equal_brute_force(spark, block):
    rng = random.Random(2)
    df = spark.createDataFrame([(rng.randrange(4), rng.randrange(60)) for _ in range(200)], "g int, m int")
    a, b = df.distinct().alias("a"), df.distinct().alias("b")
    brute = a.join(b, (F.col("a.g") == F.col("b.g")) & (F.col("a.m") < F.col("b.m")))
    got = pairs.co_members(df, ["g"], "m", block=block)
    assert rows(got) == rows(brute.select("a.m", "b.m").distinct())


def test_channel_rule_is_optional(spark):
    df = frame(spark, "g int, m int", (1, 1), (1, 2), (2, 1))
    assert pairs.limit_groups(df, "g", None).count() == 3
    assert rows(pairs.limit_groups(df, "g", 1)) == [(2, 1)]


# --- vault ------------------------------------------------------------------------------

def test_satellite_keeps_changes_only_and_reload_adds_nothing(spark):
    def at(h):
        return dt.datetime(2024, 1, 1, h)

    src = frame(spark, "k string, status string, load_dt timestamp_ntz",
                ("a", "new", at(1)), ("a", "new", at(2)), ("a", "done", at(3)), ("a", "new", at(4)), ("b", None, at(1)))
    first = vault.satellite(src, "k", ["status"], "load_dt")
    assert rows(vault.changes(first, "k", "load_dt"), "k", "status", "load_dt") == [
        ("a", "done", at(3)), ("a", "new", at(1)), ("a", "new", at(4)), ("b", None, at(1))]
    assert vault.satellite(src, "k", ["status"], "load_dt", first).isEmpty()
    more = frame(spark, "k string, status string, load_dt timestamp_ntz", ("a", "new", at(4)), ("b", "x", at(6)))
    assert rows(vault.satellite(more, "k", ["status"], "load_dt", first), "k", "status") == [("b", "x")]


def test_late_version_makes_its_successor_a_change(spark):
    def version(status, hour):
        return frame(spark, "k string, status string, load_dt timestamp_ntz", ("a", status, dt.datetime(2024, 1, 1, hour)))

    stored = vault.satellite(version("A", 1).unionByName(version("A", 3)), "k", ["status"], "load_dt")
    stored = stored.unionByName(vault.satellite(version("B", 2), "k", ["status"], "load_dt", stored))
    got = rows(vault.changes(stored, "k", "load_dt"), "load_dt", "status")
    assert [status for _, status in got] == ["A", "B", "A"]
