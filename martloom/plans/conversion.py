"""Group conversion on the activity vault."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.money import ratio
from ..operators import vault
from ..operators.joins import semi_top_k
from ..operators.merge import new_rows
from ..operators.windows import top_k


def activity_links(group_log: DataFrame, users: DataFrame, groups: DataFrame, links: DataFrame | None,
                   load_dt: Column, load_src: str = "s3") -> DataFrame:
    """New user-group links; log rows of unknown users or groups are left out."""
    known = group_log.join(users.select("user_id"), "user_id").join(groups.select("group_id"), "group_id")
    rows = vault.link(known, "hk_l_user_group_activity", {"hk_user_id": "user_id", "hk_group_id": "group_id"},
                      load_dt, load_src)
    return rows if links is None else new_rows(links, rows, ["hk_l_user_group_activity"], unique=True)


def auth_history(group_log: DataFrame, links: DataFrame, history: DataFrame | None = None) -> DataFrame:
    """Event history of the links: every event once, also when the log is loaded again."""
    from ..functions.keys import hash_key

    key = hash_key(hash_key(F.col("user_id")), hash_key(F.col("group_id")))
    rows = group_log.select(key.alias("hk_l_user_group_activity"), "user_id_from", "event", "event_dt").distinct()
    rows = rows.join(links.select("hk_l_user_group_activity"), "hk_l_user_group_activity", "left_semi")
    if history is None:
        return rows
    same = [rows[c].eqNullSafe(history[c]) for c in rows.columns]
    cond = same[0]
    for s in same[1:]:
        cond = cond & s
    return rows.join(history.select(*rows.columns), cond, "left_anti")


def added_users(history: DataFrame, links: DataFrame, groups: DataFrame, oldest: int | None = 10) -> DataFrame:
    """Distinct users added to each group, for the oldest groups (or all)."""
    members = links.select("hk_l_user_group_activity", "hk_user_id", "hk_group_id")
    if oldest is not None:
        members = semi_top_k(members, groups, "hk_group_id", ["registration_dt", "hk_group_id"], oldest)
    adds = history.filter(F.col("event") == "add").select("hk_l_user_group_activity")
    return (
        members.join(adds, "hk_l_user_group_activity", "left_semi")
        .groupBy("hk_group_id")
        .agg(F.count_distinct("hk_user_id").alias("cnt_added_users"))
    )


def writing_users(group_messages: DataFrame, user_messages: DataFrame) -> DataFrame:
    """Distinct users with a message in each group."""
    return (
        group_messages.select("hk_message_id", "hk_group_id")
        .join(user_messages.select("hk_message_id", "hk_user_id"), "hk_message_id")
        .groupBy("hk_group_id")
        .agg(F.count_distinct("hk_user_id").alias("cnt_users_in_group_with_messages"))
    )


def group_conversion(added: DataFrame, writing: DataFrame) -> DataFrame:
    count = F.coalesce(F.col("cnt_users_in_group_with_messages"), F.lit(0))
    return (
        added.join(writing, "hk_group_id", "left")
        .withColumn("cnt_users_in_group_with_messages", count)
        .withColumn("group_conversion", ratio(F.col("cnt_users_in_group_with_messages"), F.col("cnt_added_users")))
    )


def most_added(added: DataFrame, k: int = 10) -> DataFrame:
    return top_k(added, [F.col("cnt_added_users").desc(), F.col("hk_group_id")], k)


def least_writing(writing: DataFrame, k: int = 10) -> DataFrame:
    return top_k(writing, ["cnt_users_in_group_with_messages", "hk_group_id"], k)
