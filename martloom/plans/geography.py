"""Geo marts: where users are, what happens in each zone, whom to recommend."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import local_time
from ..functions.keys import ordered_pair
from ..operators.filters import require
from ..operators.nearest import nearest
from ..operators.pairs import limit_groups, unknown_pairs_within
from ..operators.ranges import count_changes
from ..operators.windows import home_state, latest

# Days in one city that make it home, km between friends, degrees to a city.
HOME_DAYS = 27
FRIEND_KM = 50
CITY_BOX_DEG = 1.0


def flatten_events(events: DataFrame) -> DataFrame:
    """Nested lake events as plain columns.  The actor is the writer of a message or
    the user of a subscription."""
    return events.select(
        F.coalesce(F.col("event.message_from"), F.col("event.user")).alias("user_id"),
        F.col("event.message_from").alias("message_from"),
        F.col("event.message_to").alias("message_to"),
        F.col("event.subscription_channel").alias("channel_id"),
        F.try_to_timestamp("event.datetime").cast("timestamp_ntz").alias("event_time"),
        "event_type", "lat", "lon",
        *[c for c in ("event_id",) if c in events.columns],
    )


def user_geography(events: DataFrame, ref, min_days: int = HOME_DAYS) -> DataFrame:
    """User: current city, local time of the last event, home city, number of moves,
    number of cities and the sorted city list.

    events(event_id, user_id, event_time, lat, lon); rows with a gap are left out.
    """
    located = nearest(require(events, "user_id", "event_time", "lat", "lon"), ref).select(
        "event_id", "user_id", "event_time", "zone_id", "timezone"
    )
    # One partial aggregate gives the last place and the (reference-sized) city set.
    now = located.groupBy("user_id").agg(
        F.max_by(F.struct("zone_id", "event_time", "timezone"), F.struct("event_time", "event_id")).alias("_last"),
        F.sort_array(F.collect_set("zone_id")).alias("travel_array"),
    )
    home = home_state(located, "user_id", "zone_id", "event_time", min_days).select(
        "user_id", F.col("zone_id").alias("home_city")
    )
    moves = count_changes(located, ["user_id"], ["event_time", "event_id"], "zone_id", "travel_count")
    return (
        now.select(
            "user_id",
            F.col("_last.zone_id").alias("current_city"),
            local_time(F.col("_last.event_time"), F.col("_last.timezone")).alias("local_time"),
            F.size("travel_array").alias("cities_visited"),
            "travel_array",
        )
        .join(home, "user_id", "left")
        .join(moves, "user_id", "left")
        .withColumn("travel_count", F.coalesce(F.col("travel_count"), F.lit(0)))
    )


def _activity(event_type: Column, prefix: str) -> list[Column]:
    return [F.count_if(event_type == t).alias(f"{prefix}_{t}") for t in ("message", "reaction", "subscription")]


def zone_weekly(located: DataFrame) -> DataFrame:
    """Month, week and zone: messages, reactions, subscriptions and registrations (the
    first event of a user).  located(event_id, user_id, event_time, event_type, zone_id)."""
    cell = [
        F.trunc(F.to_date("event_time"), "month").alias("month"),
        F.trunc(F.to_date("event_time"), "week").alias("week"),
        F.col("zone_id"),
    ]
    counts = located.groupBy(*cell).agg(*_activity(F.col("event_type"), "week"))
    first = located.groupBy("user_id").agg(
        F.min_by(F.struct("event_time", "zone_id"), F.struct("event_time", "event_id")).alias("_f")
    ).select("_f.*")
    registered = first.groupBy(*cell).agg(F.count(F.lit(1)).alias("week_user"))
    return counts.join(registered, ["month", "week", "zone_id"], "left").withColumn(
        "week_user", F.coalesce(F.col("week_user"), F.lit(0))
    )


def zone_monthly(weekly: DataFrame) -> DataFrame:
    """Month and zone totals, added up from the weekly rows."""
    return weekly.groupBy("month", "zone_id").agg(
        *[F.sum(f"week_{t}").alias(f"month_{t}") for t in ("message", "reaction", "subscription", "user")]
    )


def zone_activity(located: DataFrame) -> DataFrame:
    """Weekly rows with the totals of their month beside them."""
    weekly = zone_weekly(located)
    return weekly.join(zone_monthly(weekly), ["month", "zone_id"])


def friend_recommendations(subscriptions: DataFrame, places: DataFrame, interactions: DataFrame, ref,
                           processed: Column, km: float = FRIEND_KM, max_channel: int | None = None) -> DataFrame:
    """Pairs that share a channel, live in the same city at most `km` apart and never
    wrote to each other.

    subscriptions(user_id, channel_id); places(event_id, user_id, event_time, lat, lon);
    interactions(a, b).  The city is part of the join key, so people of different
    cities never meet; max_channel leaves out channels above that size.
    """
    members = require(subscriptions.select("user_id", "channel_id"), "user_id", "channel_id").distinct()
    members = limit_groups(members, "channel_id", max_channel)
    last = latest(require(places, "user_id", "lat", "lon"), ["user_id"], ["event_time", "event_id"])
    located = nearest(last.select("user_id", "lat", "lon"), ref, box_deg=CITY_BOX_DEG)
    rows = members.join(located.select("user_id", "lat", "lon", "zone_id"), "user_id")
    left, right = ordered_pair(F.col("a"), F.col("b"))
    wrote = require(interactions, "a", "b").select(left.alias("user_left"), right.alias("user_right")).distinct()
    pairs = unknown_pairs_within(rows, "channel_id", "zone_id", "user_id", "lat", "lon", km, wrote)
    return pairs.withColumn("processed_dttm", processed)
