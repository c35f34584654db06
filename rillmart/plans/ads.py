"""Application marts: user totals by day and over all time."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillmart.functions import measures as m
from rillmart.operators.aggregate import aggregate
from rillmart.operators.mart import Mart, by

_DAY = by("statistic_time", "user_id", "channel_id")
_ALL_TIME = by("user_id", "channel_id")

USER_GAME_DAY = Mart(
    "today_user_game_statistic", "today_user_game_statistics_dws", _DAY, m.user_game_pack(), derived=(m.KILL_RATE,)
)
USER_GAME_TOTAL = Mart(
    "user_game_statistic", "today_user_game_statistics_dws", _ALL_TIME, m.user_game_pack(), derived=(m.KILL_RATE,)
)
USER_REWARD_DAY = Mart(
    "today_user_reward_statistic", "dwd_reward_record", _DAY, m.user_reward_pack(), where=m.REWARD_FILTER
)
USER_REWARD_TOTAL = Mart(
    "user_reward_statistic", "dwd_reward_record", _ALL_TIME, m.user_reward_pack(), where=m.REWARD_FILTER
)

MARTS = {
    mart.name: mart for mart in (USER_GAME_DAY, USER_GAME_TOTAL, USER_REWARD_DAY, USER_REWARD_TOTAL)
}

USER_BOUNTY_DAY = "today_user_bounty_statistic"
USER_BOUNTY_TOTAL = "user_bounty_statistic"


def user_bounty(events: DataFrame, *, by_day: bool, compute: bool = False) -> DataFrame:
    """Bounty contest mart.

    The published job is a stub that groups nothing, so the default result has
    the full schema and no rows.  ``compute=True`` fills it from the amounts the
    event carries.
    """
    keys = {"user_id": "user_id", "channel_id": "channel_id"}
    if by_day:
        keys = {"statistic_time": "CAST(update_time AS DATE)", **keys}
    rows = events.where("update_time IS NOT NULL")
    if compute:
        return aggregate(rows, keys, m.bounty_pack())
    zeros = tuple(m.Measure(name, "sum", "0", kind) for name, kind in m.bounty_columns())
    return aggregate(rows.where(F.lit(False)), keys, zeros)
