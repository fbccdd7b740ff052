"""Pairs made distinct without a hash map of them in any task."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from martloom.functions.geo import haversine
from martloom.operators import pairs
from martloom.operators.nearest import city_rows
from martloom.plans import geography
from tests.helpers import frame, plan, rows


def test_pairs_are_made_distinct_by_sorting(spark):
    df = frame(spark, "g int, m int", (1, 1), (1, 2), (1, 2), (2, 1), (2, 2), (2, 3), (None, 4), (3, None), (3, 5))
    got = pairs.co_members(df, ["g"], "m", "a", "b")
    assert rows(got) == [(1, 2), (1, 3), (2, 3)]
    assert "Aggregate(keys=[a#" not in plan(got) and "keys=[a#" not in plan(got)


@pytest.mark.parametrize("carried, met, block", [(100, 1000, 2000), (2, 1000, 5), (100, 1, 2000), (1, 0, 2000)])
def test_unknown_pairs_equal_brute_force(spark, carried, met, block):
    """Members with few or with many values and partners, and both kinds together."""
    rng = random.Random(5)
    people = {i: (rng.choice("xy"), rng.gauss(0, 0.4), 179.9 + rng.gauss(0, 0.4)) for i in range(60)}
    members = [(c, g, i, a, o - 360 if o > 180 else o) for i, (g, a, o) in people.items()
               for c in rng.choices(range(6), k=rng.choice([1, 2, 2, 5]))]  # some come twice
    df = frame(spark, "c int, g string, u int, lat double, lon double", *members)
    known = frame(spark, "user_left bigint, user_right bigint", (7, 7), (3, 99),
                  *{(min(p), max(p)) for p in (rng.sample(range(60), 2) for _ in range(300))})
    a, b = df.alias("a"), df.alias("b")
    close = haversine(F.col("a.lat"), F.col("a.lon"), F.col("b.lat"), F.col("b.lon")) <= 50
    brute = a.join(b, (F.col("a.c") == F.col("b.c")) & (F.col("a.g") == F.col("b.g")) & (F.col("a.u") < F.col("b.u")) & close).select(
        F.col("a.u").alias("user_left"), F.col("b.u").alias("user_right"), "a.g").distinct()
    want = rows(brute.join(known, ["user_left", "user_right"], "left_anti"))
    got = pairs.unknown_pairs_within(df, "c", "g", "u", "lat", "lon", 50, known, block=block, carried=carried, met_most=met)
    assert rows(got) == want and 0 < len(want) < brute.count()


def test_friends_are_not_dealt_out_as_pairs(spark):
    """Above the join of members nothing is shuffled, as pairs are many times the members."""
    at = dt.datetime(2024, 1, 1)
    places = frame(spark, "event_id int, user_id int, event_time timestamp_ntz, lat double, lon double",
                   *[(u, u, at, -33.865, 151.2094) for u in range(6)])
    subs = frame(spark, "user_id int, channel_id int", *[(u, c) for u in range(6) for c in range(3)])
    wrote = frame(spark, "a int, b int", (5, 1))
    got = geography.friend_recommendations(subs, places, wrote, city_rows(), F.lit(at))
    tree = got._jdf.queryExecution().optimizedPlan().toString()
    assert "row_number" not in tree and "LeftAnti" not in tree and "Aggregate" not in tree.partition("Join")[0]
    want = sorted((a, b) for a in range(6) for b in range(a + 1, 6) if (a, b) != (1, 5))
    assert rows(got, "user_left", "user_right") == want
