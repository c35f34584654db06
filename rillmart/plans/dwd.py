"""Cleaning rules: change rows or events to the cleaned tables.

Every rule binds to its declared columns; ``keep`` names extra columns (the
change columns of a stream) that pass through.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillmart import schemas
from rillmart.functions.measures import REWARD_FILTER
from rillmart.operators.changelog import CREATE, latest, paired
from rillmart.operators.conform import conform, enforce_not_null
from rillmart.sources.envelopes import encode_changes


def _stat_day(df: DataFrame) -> DataFrame:
    """Event day in wall-clock time."""
    return df.withColumn("statistic_time", F.to_date("update_time"))


def game_record(rows: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Settled bets with their day and hour."""
    kept = rows.where("status = 'settle' AND order_no IS NOT NULL AND update_time IS NOT NULL")
    timed = _stat_day(kept).withColumn("statistic_hour", F.hour("update_time").cast("bigint"))
    return conform(timed, schemas.DWD_GAME_RECORD, keep=keep)


def recharge_order(rows: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    kept = rows.where("order_no IS NOT NULL AND update_time IS NOT NULL")
    return conform(_stat_day(kept), schemas.DWD_RECHARGE_ORDER, keep=keep)


def withdraw_order(rows: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    kept = rows.where("order_no IS NOT NULL AND update_time IS NOT NULL")
    return conform(_stat_day(kept), schemas.DWD_WITHDRAW_ORDER, keep=keep)


def amount_operation_record(rows: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    kept = rows.where("status = 'COMPLETE' AND update_time IS NOT NULL")
    return conform(_stat_day(kept), schemas.DWD_AMOUNT_OPERATION_RECORD, keep=keep)


def user_proxy_statistic(rows: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Keeps the day delivered by the source."""
    return conform(rows.where("update_time IS NOT NULL"), schemas.DWD_USER_PROXY_STATISTIC, keep=keep)


def reward_record(events: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Reward events of the five known scopes; a missing draw flag counts as not drawn."""
    kept = events.where(REWARD_FILTER)
    drawn = kept.withColumn("draw_flag", F.expr("IF(draw_flag, 1, 0)"))
    return conform(_stat_day(drawn), schemas.DWD_REWARD_RECORD, keep=keep)


def user_online(events: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Online events; text times keep their fraction and turn NULL when unreadable.

    Rows whose key is then NULL are dropped.
    """
    kept = events.where("user_id IS NOT NULL AND online_time IS NOT NULL AND create_time IS NOT NULL")
    timed = kept.withColumns(
        {
            "session_id": F.expr("COALESCE(session_id, 'N/A')"),
            "online_time": F.expr("try_cast(replace(online_time, 'T', ' ') AS timestamp_ntz)"),
            "create_time": F.expr("try_cast(replace(create_time, 'T', ' ') AS timestamp_ntz)"),
        }
    )
    rows = conform(timed, schemas.USER_ONLINE_STATUS_RECORD, keep=keep)
    return enforce_not_null(rows, schemas.KEYS["user_online_status_record"]["sink"])


def user_online_status(events: DataFrame) -> DataFrame:
    """The landed table: one row per user and creation time.

    The source names no version, so of rows with the same key the largest wins,
    compared column by column in declared order.
    """
    keys = schemas.KEYS["user_online_status_record"]["sink"]
    order = [F.col(c).desc_nulls_last() for c in schemas.names(schemas.USER_ONLINE_STATUS_RECORD) if c not in keys]
    return latest(user_online(events), keys, order)


# cleaned table -> (source table, rule)
CLEANERS = {
    "dwd_game_record": ("game_record", game_record),
    "dwd_recharge_order": ("recharge_order", recharge_order),
    "dwd_withdraw_order": ("withdraw_order", withdraw_order),
    "dwd_amount_operation_record": ("amount_operation_record", amount_operation_record),
    "dwd_user_proxy_statistic": ("user_proxy_statistic", user_proxy_statistic),
    "dwd_reward_record": ("reward_event", reward_record),
    "user_online_status_record": ("online_event", user_online),
}


# The cleaned tables published as change topics, with their columns; all are keyed by their id.
TOPICS = {
    "dwd_game_record": schemas.DWD_GAME_RECORD,
    "dwd_recharge_order": schemas.DWD_RECHARGE_ORDER,
    "dwd_withdraw_order": schemas.DWD_WITHDRAW_ORDER,
    "dwd_amount_operation_record": schemas.DWD_AMOUNT_OPERATION_RECORD,
    "dwd_user_proxy_statistic": schemas.DWD_USER_PROXY_STATISTIC,
    "dwd_reward_record": schemas.DWD_REWARD_RECORD,
}
TOPIC_KEY = ["id"]


def topic_messages(cleaned: DataFrame, *, style: str = "change") -> DataFrame:
    """``key`` and ``value`` of the change topic of a cleaned table, from its signed cleaned rows.

    A change whose row leaves the rule's filter is published as a delete, one whose
    row enters it as a create.
    """
    return encode_changes(paired(cleaned, TOPIC_KEY), TOPIC_KEY, style=style)


def event_messages(cleaned: DataFrame) -> DataFrame:
    """Messages of cleaned events, which are only ever created."""
    row = F.struct(*cleaned.columns)
    made = cleaned.select(
        F.lit(CREATE).alias("op"), F.when(F.lit(False), row).alias("before"), row.alias("after"), F.lit(0).cast("bigint").alias("pos")
    )
    return encode_changes(made, TOPIC_KEY)
