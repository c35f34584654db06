"""Dimension tables: full replication with deletes, and the two detail landings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillmart import schemas
from rillmart.operators.changelog import current_state, latest, replicate
from rillmart.operators.conform import conform, enforce_not_null, protect

DIMENSIONS = (
    "user",
    "user_info",
    "user_relations",
    "user_cash_account",
    "user_global_currency_account",
    "user_proxy_account",
    "user_proxy_statistic",
)


def dimension(
    table: str, snapshot: DataFrame, changes: DataFrame, *, sensitive: str = "keep", metric: str | None = None
) -> DataFrame:
    """Current rows of a dimension: snapshot, then changes, one row per key.

    Rows with a NULL in the published key are dropped (and counted under
    ``metric``).  ``sensitive`` keeps, drops or hashes the credential and contact
    columns; the plain copy keeps them.
    """
    keys = schemas.KEYS[table]
    rows = conform(replicate(snapshot, changes, keys["entity"]), schemas.TABLES[table])
    rows = enforce_not_null(rows, keys["sink"], metric=metric)
    return rows if sensitive == "keep" else protect(rows, schemas.SENSITIVE.get(table, ()), how=sensitive)


def game_record_landing(changes: DataFrame, *, shards: bool = False) -> DataFrame:
    """Bets as landed, one row per order number and creation time, money widened.

    Changes are compacted by the bet first.  Sharded source tables may reuse ids,
    so with ``shards`` a bet is identified by shard and id.  Of bets that share
    the published key the last updated wins, then the largest by the other columns.
    """
    keys = (["_shard"] if shards else []) + schemas.KEYS["game_record"]["entity"]
    rows = current_state(changes, keys).where("order_no IS NOT NULL")
    return _by_sink_key(conform(rows, schemas.GAME_RECORD_LANDING), schemas.KEYS["game_record"]["sink"])


def reward_record_landing(cleaned: DataFrame) -> DataFrame:
    """Rewards as landed, one row per user, reward number and creation time.

    The last version wins: by update time, then by the remaining columns so that
    the choice does not depend on arrival order.
    """
    rows = conform(cleaned.where("id IS NOT NULL"), schemas.REWARD_RECORD_LANDING)
    return _by_sink_key(rows, schemas.KEYS["reward_record"]["sink"])


def _by_sink_key(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The last updated row per key; ties by the remaining columns in declared order."""
    rest = ["update_time"] + [c for c in rows.columns if c not in keys and c != "update_time"]
    return latest(enforce_not_null(rows, keys), keys, [F.col(c).desc_nulls_last() for c in rest])
