"""Change feeds derived from the provided tables.

Every row is created; a third of the rows is updated, and every eleventh key is
deleted.  Optionally every thirteenth creation is delivered twice.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillmart.operators.changelog import CREATE, DELETE, UPDATE

TURN = "turn"
UPDATED, DELETED, REPEATED = "{} % 3 = 0", "{} % 11 = 0", "{} % 13 = 0"

# Second version of the rows, as SQL over the first version.
SECOND = {
    "game_event": {
        "status": "CASE WHEN id % 2 = 0 THEN 'void' ELSE 'settle' END",
        "bet_amount": "CAST(bet_amount * 2 AS DECIMAL(19,2))",
        "update_time": "update_time + INTERVAL 1 DAY",
    },
    "recharge_order": {"order_status": "'complete'", "order_amount": "CAST(order_amount + 1 AS DECIMAL(20,4))"},
    "withdraw_order": {
        "order_status": "CASE WHEN id % 2 = 0 THEN 'COMPLETED' ELSE 'REJECTED' END",
        "withdraw_funds_amount": "CAST(withdraw_funds_amount + 10 AS DECIMAL(20,4))",
        "update_time": "CASE WHEN id % 6 = 0 THEN update_time + INTERVAL 1 DAY ELSE update_time END",
    },
    "third_withdraw_payment_order": {"order_status": "'COMPLETED'"},
    "user_proxy_statistic": {"transfer_amount": "CAST(transfer_amount + 1 AS DECIMAL(20,4))"},
    "amount_operation_record": {
        "status": "CASE WHEN id % 2 = 0 THEN 'CANCELLED' ELSE 'COMPLETE' END",
        "update_time": "update_time + INTERVAL 1 DAY",
    },
    "device": {"device_id": "'a' || CAST(id % 40 AS STRING)"},
    "user": {"user_country": "'moved'"},
    "user_info": {"nick_name": "'renamed'", "current_level_recharge_amount": "CAST(-1 AS DECIMAL(20,4))"},
    "user_relations": {"rebate_amount": "CAST(0 AS DECIMAL(20,4))"},
    "user_cash_account": {"bonus_amount": "CAST(NULL AS DECIMAL(19,4))"},
    "user_global_currency_account": {"global_currency_status": "'closed'"},
    "user_proxy_account": {"user_proxy_level": "CAST(99 AS BIGINT)"},
}


def second_version(rows: DataFrame, changed: Mapping[str, str]) -> list:
    return [F.expr(changed[c]).alias(c) if c in changed else F.col(c) for c in rows.columns]


def envelopes(rows: DataFrame, changed: Mapping[str, str], *, key: str = "id", repeats: bool = True, creates: bool = True) -> DataFrame:
    """Change envelopes of a table; ``creates=False`` leaves out what a snapshot holds."""
    first, second = F.struct(*rows.columns), F.struct(*second_version(rows, changed))
    updated, deleted, repeated = (F.expr(t.format(key)) for t in (UPDATED, DELETED, REPEATED))
    nothing = F.when(F.lit(False), first)

    def change(cond, op, pos, before, after):
        fields = (F.lit(op).alias("op"), F.lit(pos).cast("bigint").alias("pos"), before.alias("before"), after.alias("after"))
        return F.when(cond, F.struct(*fields))

    parts = [
        change(updated, UPDATE, 2, first, second),
        change(deleted, DELETE, 3, F.when(updated, second).otherwise(first), nothing),
    ]
    if creates:
        parts.append(change(F.lit(True), CREATE, 1, nothing, first))
        if repeats:
            parts.append(change(repeated, CREATE, 1, nothing, first))
    events = F.filter(F.array(*parts), lambda e: e.isNotNull())
    return rows.select(F.inline(events))


def write_lines(messages: DataFrame, path: str, turn: Column | None = None) -> str:
    """Add messages as compressed JSON-lines files, dealt out so that one key's changes meet in any order.

    With ``turn`` those of turn ``k`` go to the folder ``turn=k``; all are made in one go.
    """
    turns = [] if turn is None else [turn.alias(TURN)]
    lines = messages.select("value", *turns).repartition(F.col("value"))
    writer = lines.write.mode("append").option("maxRecordsPerFile", 5000).option("compression", "gzip")
    (writer.partitionBy(TURN) if turns else writer).text(path)
    return path


def live_sql(source: str, name: str, key: str = "id") -> str:
    """The rows a feed leaves behind, as a query over its source query."""
    changed = ", ".join(
        f"CASE WHEN {UPDATED.format(key)} THEN {expr} ELSE {column} END AS {column}"
        for column, expr in SECOND[name].items()
    )
    return f"SELECT * REPLACE ({changed}) FROM ({source}) WHERE NOT ({DELETED.format(key)})"
