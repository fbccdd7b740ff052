"""Advertising campaigns matched to subscribers while they run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import active_at
from ..functions.documents import pack_json

# Fields of a campaign message; times are epoch seconds.
CAMPAIGN_SCHEMA = (
    "restaurant_id string, adv_campaign_id string, adv_campaign_content string, adv_campaign_owner string, "
    "adv_campaign_owner_contact string, adv_campaign_datetime_start bigint, adv_campaign_datetime_end bigint, "
    "datetime_created bigint"
)
OUT_FIELDS = [f.split()[0] for f in CAMPAIGN_SCHEMA.split(", ")] + ["client_id", "trigger_datetime_created"]


def now_epoch() -> Column:
    """Fixed for the whole micro-batch."""
    return F.unix_timestamp(F.current_timestamp())


def active_campaigns(campaigns: DataFrame, at: Column | None = None) -> DataFrame:
    at = now_epoch() if at is None else at
    return campaigns.filter(
        active_at(F.col("adv_campaign_datetime_start"), F.col("adv_campaign_datetime_end"), at)
    )


def match_subscribers(campaigns: DataFrame, subscribers: DataFrame, at: Column | None = None) -> DataFrame:
    """One row per active campaign and subscriber of its restaurant.  The join type is
    left to the size of the subscriber table."""
    return (
        active_campaigns(campaigns, at)
        .join(subscribers.select("client_id", "restaurant_id"), "restaurant_id")
        .withColumn("trigger_datetime_created", now_epoch() if at is None else at)
        .select(*OUT_FIELDS)
    )


def feedback_rows(matches: DataFrame) -> DataFrame:
    """Shape of the table sink: an empty feedback column is added."""
    return matches.withColumn("feedback", F.lit(None).cast("string"))


def notification_messages(matches: DataFrame) -> DataFrame:
    """Shape of the message sink."""
    return matches.select(pack_json(*OUT_FIELDS).alias("value"))
