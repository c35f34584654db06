"""Raw change topics: decode, filter deletes, project, publish."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillmart import schemas
from rillmart.operators.changelog import drop_deletes
from rillmart.sources.envelopes import encode_changes


@dataclass(frozen=True)
class Topic:
    """One published change topic of a source table."""

    name: str
    table: str
    ddl: str
    keep_deletes: bool = False


TOPICS = {
    topic.name: topic
    for topic in (
        Topic("flink_game_order_data_sync", "game_record", schemas.GAME_RECORD),
        Topic("flink_recharge_order_data_sync", "recharge_order", schemas.RECHARGE_ORDER),
        Topic("flink_withdraw_order_data_sync", "withdraw_order", schemas.WITHDRAW_ORDER),
        Topic(
            "flink_third_withdraw_payment_order_data_sync",
            "third_withdraw_payment_order",
            schemas.THIRD_WITHDRAW_PAYMENT_ORDER,
        ),
        Topic(
            "flink_user_proxy_statistic_data_sync",
            "user_proxy_statistic",
            schemas.USER_PROXY_STATISTIC,
            keep_deletes=True,
        ),
        Topic(
            "flink_amount_operation_record_data_sync", "amount_operation_record", schemas.AMOUNT_OPERATION_TOPIC
        ),
    )
}


def _side(name: str, ddl: str):
    picked = F.struct(*(F.col(f"{name}.{c}").cast(t).alias(c) for c, t in schemas.fields(ddl)))
    return F.when(F.col(name).isNotNull(), picked).alias(name)


def published(topic: Topic, envelopes: DataFrame) -> DataFrame:
    """The envelopes a topic carries: its columns, without deletes unless it keeps them."""
    kept = envelopes if topic.keep_deletes else drop_deletes(envelopes)
    return kept.select("op", _side("before", topic.ddl), _side("after", topic.ddl), "pos")


def messages(topic: Topic, envelopes: DataFrame, *, style: str = "change") -> DataFrame:
    """``key``/``value`` messages of a topic, keyed by the row's primary key."""
    return encode_changes(published(topic, envelopes), schemas.KEYS[topic.table]["entity"], style=style)
