"""The provided tables, shaped like the library's source tables.

Each shape is a list of ``column: SQL`` pairs over provided tables.  The SQL uses
only ``%``, ``CASE``, ``CAST`` and ``||``, which Spark and the checking engine
read alike, so both sides of a check start from the same input text.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Shape:
    tables: tuple[str, ...]
    columns: dict[str, str]
    # of columns whose SQL outgrows a BIGINT on large tables: the same value in wider arithmetic, for reading by Spark
    wide: dict[str, str] = field(default_factory=dict)

    def sql(self) -> str:
        """The shape as a query over the provided tables."""
        source = self.tables[0]
        if len(self.tables) > 1:
            source += f" JOIN {self.tables[1]} ON l_orderkey = o_orderkey"
        picked = ", ".join(f"{expr} AS {name}" for name, expr in self.columns.items())
        return f"SELECT {picked} FROM {source}"


_BET = "CAST(l_extendedprice AS DECIMAL(19,2))"
_SETTLE = "CAST(l_quantity * 1000 AS DECIMAL(19,2))"
_NONE_TS = "CAST(NULL AS TIMESTAMP)"
_NONE_STR = "CAST(NULL AS STRING)"
_M4 = "CAST({} AS DECIMAL(20,4))"


def _m4(expr: str) -> str:
    return _M4.format(expr)


GAME_RECORD = Shape(
    ("lineitem", "orders"),
    {
        "id": "l_orderkey * 10 + l_linenumber",
        "user_id": "o_custkey",
        "game_id": "l_partkey",
        "game_category_id": "l_suppkey % 10",
        "bet_amount": _BET,
        "settle_amount": _SETTLE,
        "transfer_amount": f"CAST({_SETTLE} - {_BET} AS DECIMAL(19,2))",
        "bet_deposit_amount": f"CASE WHEN l_linenumber % 2 = 0 THEN {_BET} ELSE NULL END",
        "bet_withdrawal_amount": f"CASE WHEN l_linenumber % 3 = 0 THEN {_BET} ELSE CAST(0 AS DECIMAL(19,2)) END",
        "bet_bonus_amount": "CAST(l_discount AS DECIMAL(19,2))",
        "effective_bet_flag": (
            "CAST(CASE WHEN l_linenumber % 3 = 0 THEN 0 WHEN l_linenumber % 5 = 0 THEN 2 "
            "WHEN l_linenumber % 7 = 0 THEN NULL ELSE 1 END AS TINYINT)"
        ),
        "settle_deposit_amount": "CAST(l_quantity AS DECIMAL(19,2))",
        "settle_withdrawal_amount": "CAST(l_tax AS DECIMAL(19,2))",
        "settle_bonus_amount": "CAST(0 AS DECIMAL(19,2))",
        "transfer_deposit_amount": "CAST(l_quantity - 25 AS DECIMAL(19,2))",
        "transfer_withdrawal_amount": "CAST(l_tax - l_discount AS DECIMAL(19,2))",
        "transfer_bonus_amount": "CAST(l_linenumber - 4 AS DECIMAL(19,2))",
        "third_platform_provider_type": "l_returnflag",
        "bet_time": "o_orderdate",
        "settle_time": "l_shipdate",
        "status": "CASE WHEN l_linestatus = 'F' THEN 'settle' ELSE 'bet' END",
        "bet_no": "'b' || CAST(l_orderkey AS STRING)",
        "create_time": "o_orderdate",
        "update_time": "l_shipdate",
        "game_name_code": "'g' || CAST(l_partkey AS STRING)",
        "order_no": "CASE WHEN l_orderkey % 97 = 0 THEN NULL ELSE l_orderkey * 10 + l_linenumber END",
        "channel_id": "o_custkey % 5",
        "game_record_expand_list": "'[]'",
        "valid_bet_amount": _BET,
        "valid_bet_deposit_amount": f"CASE WHEN l_linenumber % 2 = 0 THEN {_BET} ELSE NULL END",
        "valid_bet_withdrawal_amount": "CAST(l_quantity AS DECIMAL(19,2))",
        "valid_bet_bonus_amount": "CAST(l_discount AS DECIMAL(19,2))",
        "third_provider_game_code": "'c' || CAST(l_suppkey AS STRING)",
        "parent_game_category_id": "l_suppkey % 3",
        "third_provider_game_type": "l_suppkey % 4",
    },
)

_VALUE2 = "CAST(value AS DECIMAL(19,2))"

# Bets with a time of day and a unique id, for the hour grain and the streams.
GAME_EVENT = Shape(
    ("events",),
    {
        "id": "event_id",
        "user_id": "user_id",
        "game_id": "event_id % 20",
        "game_category_id": "event_id % 4",
        "bet_amount": _VALUE2,
        "settle_amount": "CAST(user_id % 100 AS DECIMAL(19,2))",
        "transfer_amount": f"CAST(CAST(user_id % 100 AS DECIMAL(19,2)) - {_VALUE2} AS DECIMAL(19,2))",
        "bet_deposit_amount": f"CASE WHEN event_id % 2 = 0 THEN {_VALUE2} ELSE NULL END",
        "bet_withdrawal_amount": f"CASE WHEN event_id % 3 = 0 THEN {_VALUE2} ELSE CAST(0 AS DECIMAL(19,2)) END",
        "bet_bonus_amount": "CAST(event_id % 7 AS DECIMAL(19,2))",
        "effective_bet_flag": (
            "CAST(CASE WHEN event_id % 3 = 0 THEN 0 WHEN event_id % 5 = 0 THEN 2 "
            "WHEN event_id % 7 = 0 THEN NULL ELSE 1 END AS TINYINT)"
        ),
        "settle_deposit_amount": "CAST(event_id % 11 AS DECIMAL(19,2))",
        "settle_withdrawal_amount": "CAST(event_id % 13 AS DECIMAL(19,2))",
        "settle_bonus_amount": "CAST(0 AS DECIMAL(19,2))",
        "transfer_deposit_amount": "CAST(event_id % 9 - 4 AS DECIMAL(19,2))",
        "transfer_withdrawal_amount": "CAST(NULL AS DECIMAL(19,2))",
        "transfer_bonus_amount": "CAST(event_id % 5 - 2 AS DECIMAL(19,2))",
        "third_platform_provider_type": "CASE WHEN event_id % 3 = 0 THEN 'A' WHEN event_id % 3 = 1 THEN 'B' ELSE 'C' END",
        "bet_time": "ts",
        "settle_time": "ts",
        "status": "CASE WHEN event_type = 'error' THEN 'bet' ELSE 'settle' END",
        "bet_no": "'b' || CAST(event_id AS STRING)",
        "create_time": "ts",
        "update_time": "ts",
        "game_name_code": "'g' || CAST(event_id % 20 AS STRING)",
        "order_no": "event_id",
        "channel_id": "user_id % 5",
        "game_record_expand_list": "props",
        "valid_bet_amount": _VALUE2,
        "valid_bet_deposit_amount": f"CASE WHEN event_id % 2 = 0 THEN {_VALUE2} ELSE NULL END",
        "valid_bet_withdrawal_amount": "CAST(event_id % 6 AS DECIMAL(19,2))",
        "valid_bet_bonus_amount": "CAST(event_id % 8 AS DECIMAL(19,2))",
        "third_provider_game_code": "'c' || CAST(event_id % 20 AS STRING)",
        "parent_game_category_id": "event_id % 2",
        "third_provider_game_type": "event_id % 6",
    },
)

RECHARGE_ORDER = Shape(
    ("orders",),
    {
        "id": "o_orderkey",
        "order_no": "o_orderkey",
        "user_id": "o_custkey",
        "currency_code": "'USD'",
        "rate_scale": _m4("1"),
        "order_amount": _m4("o_totalprice"),
        "pay_amount": _m4("o_totalprice"),
        "decrease_handling_fee": _m4("o_orderkey % 3"),
        "handling_fee": _m4("o_orderkey % 7"),
        "gift_amount": _m4("o_orderkey % 11"),
        "recharge_amount": _m4("o_totalprice"),
        "actual_handling_fee": f"CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE {_m4('o_orderkey % 7')} END",
        "actual_decrease_handling_fee": _m4("o_orderkey % 3"),
        "actual_gift_amount": _m4("o_orderkey % 11"),
        "actual_recharge_amount": _m4("o_totalprice"),
        "pay_status": (
            "CASE WHEN o_orderpriority LIKE '1%' THEN 'pending_payment' WHEN o_orderpriority LIKE '2%' "
            "THEN 'payment_failed' WHEN o_orderpriority LIKE '3%' THEN 'payment_timeout' ELSE 'paid' END"
        ),
        "order_status": "CASE WHEN o_orderstatus = 'F' THEN 'complete' WHEN o_orderstatus = 'O' THEN 'cancel' ELSE 'failed' END",
        "first_recharge": "CAST(CASE WHEN o_orderkey % 4 = 0 THEN 1 ELSE 0 END AS TINYINT)",
        "pay_method_id": "o_orderkey % 2",
        "pay_category_id": "o_orderkey % 6",
        "pay_channel_id": "CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_orderkey % 3 END",
        "pay_provider_id": "o_orderkey % 4",
        "recharge_success_time": "o_orderdate",
        "create_time": "o_orderdate",
        "update_time": "o_orderdate",
        "update_by": "'ops'",
        "channel_id": "o_custkey % 5",
    },
)

_WITHDRAW_USED = {
    "id": "o_orderkey",
    "order_no": "o_orderkey",
    "user_id": "o_custkey",
    "channel_id": "o_custkey % 5",
    "withdraw_funds_amount": _m4("o_totalprice"),
    "final_handling_fee": f"CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE {_m4('o_orderkey % 7')} END",
    "gift_amount": _m4("o_orderkey % 11"),
    "decrease_handling_amount": _m4("o_orderkey % 3"),
    "apply_bank_id": "o_orderkey % 6",
    "order_status": "CASE WHEN o_orderstatus = 'F' THEN 'COMPLETED' WHEN o_orderstatus = 'O' THEN 'REJECTED' ELSE 'PENDING' END",
    "pay_provider_id": "o_orderkey % 4",
    "withdrawal_mode_id": "o_orderkey % 2",
    "withdrawal_channel_id": "CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_orderkey % 3 END",
    "first_withdrawal_flag": "CAST(CASE WHEN o_orderkey % 4 = 0 THEN 1 ELSE 0 END AS TINYINT)",
    "create_time": "o_orderdate",
    "update_time": "o_orderdate",
}

# Text columns of the wide order that no mart reads get short stand-in values.
_WITHDRAW_TEXT = (
    "channel", "handling_type", "handling_mode", "handling_detail", "gift_mode", "decrease_handling_mode",
    "apply_ip", "apply_name", "apply_bank_name", "apply_bank_card", "apply_email", "apply_phone",
    "order_status_event", "remark", "reasons", "front_remarks", "back_remarks", "withdrawal_mode_name",
    "withdrawal_channel_name", "withdrawal_channel_bank_code", "pay_provider_type", "payment_order_no",
    "third_party_order_no",
)
_WITHDRAW_MONEY = (
    "balance", "withdrawal_amount", "projected_amount", "platform_handling_fee", "final_withdraw_funds_amount",
    "actual_amount", "gift_value", "decrease_handling_value", "third_party_handling_fee",
)
_WITHDRAW_IDS = ("user_bank_id", "create_by", "update_by", "locked_user_id", "last_audit_user")
_WITHDRAW_TIMES = ("request_time", "fallback_time", "payout_successful_time", "last_audit_time")

WITHDRAW_ORDER = Shape(
    ("orders",),
    {
        **_WITHDRAW_USED,
        **{c: f"'{c}-' || CAST(o_orderkey % 10 AS STRING)" for c in _WITHDRAW_TEXT},
        **{c: _m4("o_totalprice") for c in _WITHDRAW_MONEY},
        **{c: "o_orderkey % 100" for c in _WITHDRAW_IDS},
        **{c: "o_orderdate" for c in _WITHDRAW_TIMES},
        "payments_number": "CAST(o_orderkey % 3 AS INT)",
    },
)

THIRD_WITHDRAW_PAYMENT_ORDER = Shape(
    ("lineitem", "orders"),
    {
        # line numbers repeat within an order; with part and supplier a line is unique
        "id": "((l_orderkey * 10 + l_linenumber) * 1000000 + l_partkey) * 100000 + l_suppkey",
        "withdraw_order_no": "l_orderkey",
        "payments_number": "CAST(l_linenumber AS INT)",
        "payment_order_no": "CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING)",
        "amount": "CAST(CAST(l_extendedprice AS DECIMAL(20,4)) AS STRING)",
        "actual_amount": "CAST(CAST(l_extendedprice AS DECIMAL(20,4)) AS STRING)",
        "apply_name": "'n'",
        "apply_bank_card": "'c'",
        "apply_email": "'e'",
        "apply_phone": "'p'",
        "pay_provider_type": "l_returnflag",
        "third_party_order_no": "'t' || CAST(l_orderkey AS STRING)",
        "third_party_handling_fee": "'0'",
        "withdrawal_channel_id": "CASE WHEN l_suppkey % 5 = 0 THEN NULL ELSE l_suppkey % 5 END",
        "withdrawal_channel_bank_code": "'k'",
        "status": "l_linestatus",
        "trade_status": "l_linestatus",
        "notify_url": _NONE_STR,
        "request_param": _NONE_STR,
        "response_param": _NONE_STR,
        "create_time": "o_orderdate",
        "update_time": "CASE WHEN l_linenumber % 3 = 0 THEN l_shipdate ELSE o_orderdate END",
        "pay_provider_id": "CASE WHEN l_suppkey % 4 = 0 THEN NULL ELSE l_suppkey % 4 END",
        "withdrawal_channel_name": "'w'",
        "order_status": "CASE WHEN l_returnflag = 'R' THEN 'COMPLETED' WHEN l_returnflag = 'A' THEN 'WITHDRAW_FAIL' ELSE 'PROCESSING' END",
        "status_reason": _NONE_STR,
    },
    # order numbers from 9.2 million on do not fit: what is over 2 ** 63 starts from 0 again
    wide={
        "id": "CAST(((CAST(l_orderkey * 10 + l_linenumber AS DECIMAL(19,0)) * 1000000 + l_partkey) * 100000 + l_suppkey) "
        "% 9223372036854775808 AS BIGINT)",
    },
)

USER_PROXY_STATISTIC = Shape(
    ("orders",),
    {
        "id": "o_orderkey",
        "user_id": "o_custkey",
        "channel_id": "o_custkey % 5",
        "statistic_time": "CAST(o_orderdate AS DATE)",
        "direct_bet_rebate_amount": f"CASE WHEN o_orderkey % 3 = 0 THEN {_m4('0')} ELSE {_m4('o_totalprice')} END",
        "direct_recharge_rebate_amount": f"CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE {_m4('0')} END",
        "teams_bet_rebate_amount": _m4("0"),
        "teams_recharge_rebate_amount": _m4("0"),
        "team_size": "CAST(o_orderkey % 50 AS INT)",
        "direct_member": "CAST(o_orderkey % 9 AS INT)",
        "valid_direct_member": "CAST(o_orderkey % 5 AS INT)",
        "transfer_amount": _m4("o_totalprice"),
        "transfer_count": "CAST(1 AS INT)",
        "invitation_amount": _m4("o_orderkey % 13"),
        "achievement_amount": _m4("o_orderkey % 17"),
        "rebate_settlement": _m4("0"),
        "betting_rebate_count": "CAST(o_orderkey % 3 AS INT)",
        "recharge_rebate_count": "CAST(o_orderkey % 4 AS INT)",
        "effective_bet_amount": _m4("o_totalprice"),
        "team_effective_bet_amount": _m4("o_totalprice"),
        "direct_effective_bet_amount": _m4("o_totalprice"),
        "teams_rebate_amount": _m4("0"),
        "obtain_betting_rebate_count": "CAST(0 AS INT)",
        "obtain_recharge_rebate_count": "CAST(0 AS INT)",
        "create_time": "o_orderdate",
        "update_time": "o_orderdate",
    },
)

AMOUNT_OPERATION_RECORD = Shape(
    ("events",),
    {
        "id": "event_id",
        "user_id": "user_id",
        "type": "CASE WHEN event_id % 2 = 0 THEN 'INCREASE' ELSE 'REDUCE' END",
        "amount_type": "CASE WHEN event_id % 3 = 0 THEN 'WITHDRAW' WHEN event_id % 3 = 1 THEN 'DEPOSIT' ELSE 'BONUS' END",
        "amount": "CAST(value AS DECIMAL(19,4))",
        "balance": "CAST(value AS DECIMAL(19,4))",
        "status": "CASE WHEN event_type = 'error' THEN 'PENDING' ELSE 'COMPLETE' END",
        "create_by": "'ops'",
        "update_by": "'ops'",
        "create_time": "ts",
        "update_time": "ts",
        "channel_id": "user_id % 5",
        # columns of the source that the published topic leaves out
        "user_phone": "'p' || CAST(user_id AS STRING)",
        "user_email": _NONE_STR,
        "nick_name": "'n' || CAST(user_id AS STRING)",
        "receive_type": "event_type",
        "reward_title": _NONE_STR,
        **{
            name: "CAST(value AS DECIMAL(19,4))"
            for name in (
                "flow_amount", "withdraw_balance", "deposit_balance", "bonus_balance",
                "flow_balance", "deposit_flow_balance", "bonus_flow_balance",
            )
        },
        "bonus_balance_expire_time": _NONE_TS,
        "remark": "props",
        "auditor": "'ops'",
        "audit_remark": _NONE_STR,
        "audit_time": "ts",
        "import_id": "event_id % 9",
        "show_flag": "CAST(event_id % 2 AS TINYINT)",
    },
)

REWARD_EVENT = Shape(
    ("events",),
    {
        "id": "event_id",
        "user_id": "user_id",
        "channel_id": "user_id % 5",
        "unique_id": "event_id - event_id % 2",
        "reward_scope": (
            "CASE WHEN event_type = 'click' THEN 'VIP_REWARD' WHEN event_type = 'view' THEN 'REBATE_REWARD' "
            "WHEN event_type = 'purchase' THEN 'ACTIVITY_REWARD' WHEN event_type = 'signup' THEN 'BONUS_TASK' "
            "WHEN event_id % 17 = 0 THEN 'OTHER' ELSE 'TOURIST_TRIAL_BONUS' END"
        ),
        "reward_type": "CASE WHEN event_id % 3 = 0 THEN 'WITHDRAW' WHEN event_id % 3 = 1 THEN 'DEPOSIT' ELSE 'BONUS' END",
        "activity_type": "CASE WHEN event_id % 5 = 0 THEN NULL ELSE 'A' || CAST(event_id % 3 AS STRING) END",
        "bonus_amount": _m4("value"),
        "draw_flag": "CASE WHEN event_id % 7 = 0 THEN NULL ELSE event_id % 4 < 2 END",
        "not_receive_time": _NONE_TS,
        "receive_time": "ts",
        "time_out_time": _NONE_TS,
        "create_time": "ts",
        "update_time": "ts",
    },
)

ONLINE_EVENT = Shape(
    ("events",),
    {
        "user_id": "CASE WHEN event_id % 29 = 0 THEN NULL ELSE user_id END",
        "ip": "'10.0.0.' || CAST(event_id % 250 AS STRING)",
        "device_id": "'d' || CAST(event_id % 50 AS STRING)",
        "online_time": (
            "CASE WHEN event_id % 31 = 0 THEN 'soon' ELSE "
            "'2024-01-' || CAST(10 + event_id % 19 AS STRING) || 'T' || CAST(10 + event_id % 13 AS STRING) "
            "|| ':' || CAST(10 + event_id % 49 AS STRING) || ':07.250' END"
        ),
        "create_time": (
            "'2024-01-' || CAST(10 + event_id % 19 AS STRING) || 'T' || CAST(10 + event_id % 13 AS STRING) || ':00:00'"
        ),
        "token": "'t' || CAST(event_id AS STRING)",
        "session_id": "CASE WHEN event_id % 6 = 0 THEN NULL ELSE 's' || CAST(event_id AS STRING) END",
    },
)

BOUNTY_EVENT = Shape(
    ("events",),
    {
        "id": "event_id",
        "user_id": "user_id",
        "channel_id": "user_id % 5",
        "bounty_order_no": "'o' || CAST(event_id AS STRING)",
        "bet_amount": _m4("value"),
        "settle_amount": _m4("user_id % 100"),
        "win_loss_amount": _m4("0"),
        "punish_amount": f"CASE WHEN event_id % 4 = 0 THEN NULL ELSE {_m4('event_id % 3')} END",
        "pumped_amount": _m4("event_id % 2"),
        "profit_loss_amount": _m4("0"),
        "bet_deposit_amount": _m4("value"),
        "bet_withdrawal_amount": _m4("0"),
        "bet_bonus_amount": _m4("event_id % 5"),
        "settle_deposit_amount": _m4("event_id % 6"),
        "settle_withdrawal_amount": _m4("event_id % 7"),
        "settle_bonus_amount": _m4("0"),
        "create_time": "ts",
        "update_time": "ts",
    },
)


def _people(columns: dict[str, str], texts: str = "", numbers: str = "", money: str = "", money_type: str = "DECIMAL(20,4)", times: str = "", ints: str = "", dates: str = "") -> Shape:
    """A customer-based dimension: given columns, and stand-ins by type for the rest."""
    out = dict(columns)
    out.update({c: f"'{c[:3]}' || CAST(c_custkey % 10 AS STRING)" for c in texts.split()})
    out.update({c: "c_custkey % 100" for c in numbers.split()})
    out.update({c: f"CAST(c_acctbal AS {money_type})" for c in money.split()})
    out.update({c: "CAST('2024-01-02 03:04:05' AS TIMESTAMP)" for c in times.split()})
    out.update({c: "CAST(c_custkey % 7 AS INT)" for c in ints.split()})
    out.update({c: "CAST('2024-01-02' AS DATE)" for c in dates.split()})
    return Shape(("customer",), out)


_PERSON = {"id": "c_custkey", "user_id": "c_custkey", "channel_id": "c_custkey % 5"}

DIMENSIONS = {
    "user": _people(
        _PERSON,
        texts="user_phone password register_ip register_device_id user_country user_email phone_area_code app_channel "
        "register_source_value register_source_type register_method last_login_ip last_login_device_id tourist_name",
        numbers="abs_id", times="register_time update_time freeze_time last_login_time",
        ints="user_status test_flag user_type tourist_must_bind_user",
    ),
    "user_info": _people(
        {**_PERSON, "nick_name": "c_name"},
        texts="user_avatar user_education user_brief user_date_birth user_location user_current_ip remark invite_code "
        "signature real_name",
        numbers="game_valid_bet_calculate_id", money="current_level_recharge_amount current_level_effective_bet",
        times="create_time update_time", dates="update_nick_name_time update_sign_time",
        ints="user_gender user_age vip_level email_checked update_nick_name_num update_sign_num hidden_score "
        "second_return bounty_arena_disabled_flag",
    ),
    "user_relations": _people(
        {
            "id": "c_custkey",
            "distance": "CAST(1 + c_custkey % 3 AS INT)",
            "ancestor_user_id": "c_custkey % 10",
            "ancestor_channel_id": "c_custkey % 5",
            "descendant_user_id": "c_custkey",
            "descendant_channel_id": "c_custkey % 5",
        },
        texts="invite_Code", money="recharge_rebate_amount bet_rebate_amount rebate_amount",
        times="effective_time create_time update_time", ints="betting_rebate_count recharge_rebate_count",
    ),
    "user_cash_account": _people(
        {**_PERSON, "withdraw_flag": "CAST(c_custkey % 2 AS TINYINT)"},
        texts="currency_type account_status",
        money="freeze_deposit_amount freeze_withdrawal_amount deposit_amount withdrawal_amount total_recharge_amount "
        "total_bet_amount total_withdrawal_amount first_recharge_amount first_withdrawal_amount bonus_amount "
        "freeze_bonus_amount deposit_flow_target_amount deposit_flow_amount bonus_flow_target_amount bonus_flow_amount",
        money_type="DECIMAL(19,4)",
        times="first_recharge_time last_recharge_time first_withdrawal_time last_withdrawal_time "
        "bonus_amount_expire_time create_time update_time",
        ints="recharge_count withdrawal_count",
    ),
    "user_global_currency_account": _people(
        {**_PERSON, "global_currency_num": "CAST(c_custkey % 1000 AS DECIMAL(10,0))"},
        texts="global_currency_status", numbers="version", times="create_time update_time",
    ),
    "user_proxy_account": _people(
        _PERSON,
        texts="account_status",
        numbers="user_proxy_level transfer_count betting_rebate_count recharge_rebate_count affiliation version",
        money="extracted_amount withdrawal_amount pending_settlement_amount total_user_proxy_effective_bet_amount "
        "total_transfer_amount total_effective_bet_amount total_team_effective_bet_amount "
        "total_direct_effective_bet_amount total_direct_bet_rebate_amount total_direct_recharge_rebate_amount "
        "total_teams_bet_rebate_amount total_teams_recharge_rebate_amount total_user_invitations_amount "
        "total_user_achievement_amount",
        times="agent_activation_time create_time update_time",
    ),
}

DEVICE_USERS = Shape(("events",), {"user_id": "user_id", "device_id": "'d' || CAST(event_id % 50 AS STRING)"})

SHAPES = {
    "game_record": GAME_RECORD,
    "game_event": GAME_EVENT,
    "recharge_order": RECHARGE_ORDER,
    "withdraw_order": WITHDRAW_ORDER,
    "third_withdraw_payment_order": THIRD_WITHDRAW_PAYMENT_ORDER,
    "user_proxy_statistic": USER_PROXY_STATISTIC,
    "amount_operation_record": AMOUNT_OPERATION_RECORD,
    "reward_event": REWARD_EVENT,
    "online_event": ONLINE_EVENT,
    "bounty_event": BOUNTY_EVENT,
    **DIMENSIONS,
    "device_users_relations_flat": DEVICE_USERS,
}


def read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def load(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A source-shaped table over the provided Parquet files."""
    return shaped(spark, folder, SHAPES[name])


def shaped(spark: SparkSession, folder: str, shape: Shape) -> DataFrame:
    source = read(spark, folder, shape.tables[0])
    if len(shape.tables) > 1:
        other = read(spark, folder, shape.tables[1])
        source = source.join(other, source["l_orderkey"] == other["o_orderkey"])
    ntz = {k: v.replace("AS TIMESTAMP)", "AS TIMESTAMP_NTZ)") for k, v in {**shape.columns, **shape.wide}.items()}
    return source.selectExpr(*(f"{expr} AS {name}" for name, expr in ntz.items()))
