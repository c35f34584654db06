"""Checking queries: the same results written as plain SQL over the provided tables.

These are written from the published meaning of each table, not from the measure
packs: conditions are spelled out again, and distinct counts use
``COUNT(DISTINCT …)``.
"""

from __future__ import annotations

from collections.abc import Callable

from rillmart import schemas
from rillmart.fixtures.feeds import DELETED, REPEATED, SECOND, UPDATED, live_sql
from rillmart.fixtures.tables import DIMENSIONS, SHAPES

M4 = "DECIMAL(20,4)"


def _sum(expr: str, name: str, kind: str = M4) -> str:
    return f"CAST(SUM({expr}) AS {kind}) AS {name}"


def _sum_if(cond: str, expr: str, name: str, kind: str = M4) -> str:
    return _sum(f"CASE WHEN {cond} THEN {expr} ELSE 0 END", name, kind)


def _count(expr: str, name: str, kind: str = "BIGINT") -> str:
    return f"CAST(COUNT({expr}) AS {kind}) AS {name}"


def _count_if(cond: str, name: str, kind: str = "BIGINT") -> str:
    return _count(f"CASE WHEN {cond} THEN 1 END", name, kind)


def _distinct(expr: str, name: str, kind: str = "BIGINT") -> str:
    return f"CAST(COUNT(DISTINCT {expr}) AS {kind}) AS {name}"


def _select(ddl: str, source: str, where: str, special: dict[str, str] | None = None) -> str:
    special = special or {}
    types = {"string": "VARCHAR", "timestamp_ntz": "TIMESTAMP"}
    columns = ", ".join(
        f"CAST({special.get(n, n)} AS {types.get(t, t)}) AS {n}" for n, t in schemas.fields(ddl)
    )
    return f"SELECT {columns} FROM ({source}) WHERE {where}"


# --- cleaned tables ---------------------------------------------------------------

_DAY = {"statistic_time": "CAST(update_time AS DATE)"}
_SCOPES = "('VIP_REWARD', 'REBATE_REWARD', 'ACTIVITY_REWARD', 'BONUS_TASK', 'TOURIST_TRIAL_BONUS')"


def clean_game(source: str) -> str:
    return _select(
        schemas.DWD_GAME_RECORD, source,
        "status = 'settle' AND order_no IS NOT NULL AND update_time IS NOT NULL",
        {**_DAY, "statistic_hour": "hour(update_time)"},
    )


def clean_recharge(source: str) -> str:
    return _select(schemas.DWD_RECHARGE_ORDER, source, "order_no IS NOT NULL AND update_time IS NOT NULL", _DAY)


def clean_withdraw(source: str) -> str:
    return _select(schemas.DWD_WITHDRAW_ORDER, source, "order_no IS NOT NULL AND update_time IS NOT NULL", _DAY)


def clean_amount(source: str) -> str:
    return _select(
        schemas.DWD_AMOUNT_OPERATION_RECORD, source, "status = 'COMPLETE' AND update_time IS NOT NULL", _DAY
    )


def clean_proxy(source: str) -> str:
    return _select(schemas.DWD_USER_PROXY_STATISTIC, source, "update_time IS NOT NULL")


def clean_reward(source: str) -> str:
    return _select(
        schemas.DWD_REWARD_RECORD, source, f"update_time IS NOT NULL AND reward_scope IN {_SCOPES}",
        {**_DAY, "draw_flag": "CASE WHEN draw_flag THEN 1 ELSE 0 END"},
    )


def clean_online(source: str) -> str:
    return _select(
        schemas.USER_ONLINE_STATUS_RECORD, source,
        "user_id IS NOT NULL AND online_time IS NOT NULL AND create_time IS NOT NULL",
        {
            "session_id": "COALESCE(session_id, 'N/A')",
            "online_time": "TRY_CAST(REPLACE(online_time, 'T', ' ') AS TIMESTAMP)",
            "create_time": "TRY_CAST(REPLACE(create_time, 'T', ' ') AS TIMESTAMP)",
        },
    )


_GAME = clean_game(SHAPES["game_record"].sql())
_GAME_EVENTS = clean_game(SHAPES["game_event"].sql())
_RECHARGE = clean_recharge(SHAPES["recharge_order"].sql())
_WITHDRAW = clean_withdraw(SHAPES["withdraw_order"].sql())
_AMOUNT = clean_amount(SHAPES["amount_operation_record"].sql())
_PROXY = clean_proxy(SHAPES["user_proxy_statistic"].sql())
_REWARD = clean_reward(SHAPES["reward_event"].sql())


def _group(source: str, keys: list[str], columns: list[str], aliases: dict[str, str] | None = None) -> str:
    aliases = aliases or {}
    shown = ", ".join(f"{aliases.get(k, k)} AS {k}" for k in keys)
    grouped = ", ".join(aliases.get(k, k) for k in keys)
    return f"SELECT {shown}, {', '.join(columns)} FROM ({source}) AS src GROUP BY {grouped}"


# --- bets ---------------------------------------------------------------------------


def _bets(effective_count: str) -> list[str]:
    good = "effective_bet_flag = 1"
    return [
        _count("order_no", "bet_count"),
        effective_count,
        _count("*", "settle_count"),
        _sum("bet_amount", "settle_bet_amount"),
        _sum("bet_amount", "bet_amount"),
        _sum("settle_amount", "settle_amount"),
        _sum("transfer_amount", "win_lose_amount"),
        _sum_if(good, "valid_bet_amount", "effective_bet_amount"),
        _sum("bet_deposit_amount", "bet_deposit_amount"),
        _sum("bet_withdrawal_amount", "bet_withdrawal_amount"),
        _sum("bet_bonus_amount", "bet_bonus_amount"),
        _sum("settle_deposit_amount", "settle_deposit_amount"),
        _sum("settle_withdrawal_amount", "settle_withdrawal_amount"),
        _sum("settle_bonus_amount", "settle_bonus_amount"),
        _sum("transfer_deposit_amount", "win_lose_deposit_amount"),
        _sum("transfer_withdrawal_amount", "win_lose_withdrawal_amount"),
        _sum("transfer_bonus_amount", "win_lose_bonus_amount"),
        _sum_if(good, "valid_bet_deposit_amount", "effective_bet_deposit_amount"),
        _sum_if(good, "valid_bet_withdrawal_amount", "effective_bet_withdrawal_amount"),
        _sum_if(good, "valid_bet_bonus_amount", "effective_bet_bonus_amount"),
    ]


_FLAG_IS_ONE = _sum_if("effective_bet_flag = 1", "1", "effective_bet_count", "BIGINT")
_FLAG_ADDED = _sum("CAST(effective_bet_flag AS BIGINT)", "effective_bet_count", "BIGINT")
_USERS = _distinct("user_id", "user_count")


def user_game_day(source: str = _GAME) -> str:
    keys = ["statistic_time", "user_id", "channel_id", "game_id", "game_category_id", "third_platform_provider_type"]
    return _group(source, keys, _bets(_FLAG_IS_ONE))


def user_game_hour(source: str) -> str:
    keys = ["statistic_time", "statistic_hour", "user_id", "channel_id", "game_id", "third_platform_provider_type"]
    return _group(source, keys, [*_bets(_FLAG_ADDED), _sum("-transfer_amount", "profit_and_loss_amount")])


def channel_game(source: str, *extra: str) -> str:
    return _group(source, ["statistic_time", "channel_id", *extra], [_USERS, *_bets(_FLAG_ADDED)])


# Negated win/loss over the stake, rounded half away from zero at four digits in whole numbers.
_RATE_N = "CAST(-SUM(win_lose_amount) * 10000 AS HUGEINT)"
_RATE_D = "CAST(SUM(settle_bet_amount) * 10000 AS HUGEINT)"
_KILL_RATE = f"""
CASE WHEN SUM(settle_bet_amount) = 0 THEN CAST(0 AS {M4}) ELSE
CAST(CAST(SIGN({_RATE_N}) * ((2 * ABS({_RATE_N}) * 10000 + {_RATE_D}) // (2 * {_RATE_D})) AS DECIMAL(30,4))
 * CAST(0.0001 AS DECIMAL(5,4)) AS {M4}) END AS third_party_total_kill_rate"""


def user_games(keys: list[str], source: str = _GAME) -> str:
    t = "third_party_total_"
    columns = [
        _sum("effective_bet_amount", "total_effective_bet_amount"),
        _sum("effective_bet_count", "total_effective_bet_count", "INTEGER"),
        _sum("effective_bet_amount", t + "effective_bet_amount"),
        _sum("effective_bet_count", t + "effective_bet_count", "INTEGER"),
        _sum("effective_bet_deposit_amount", t + "effective_bet_deposit_amount"),
        _sum("effective_bet_withdrawal_amount", t + "effective_bet_withdrawal_amount"),
        _sum("effective_bet_bonus_amount", t + "effective_bet_bonus_amount"),
        _sum("win_lose_amount", t + "win_loss_amount"),
        _sum("win_lose_withdrawal_amount", t + "win_loss_withdraw_amount"),
        _sum("win_lose_deposit_amount", t + "win_loss_deposit_amount"),
        _sum("win_lose_bonus_amount", t + "win_loss_bonus_amount"),
        _KILL_RATE,
        _sum("settle_bet_amount", t + "settle_bet_amount"),
        _sum("bet_amount", t + "bet_amount"),
        _sum("bet_count", t + "bet_count", "INTEGER"),
        _sum("bet_deposit_amount", t + "bet_deposit_amount"),
        _sum("bet_withdrawal_amount", t + "bet_withdrawal_amount"),
        _sum("bet_bonus_amount", t + "bet_bonus_amount"),
        _sum("settle_amount", t + "settle_amount"),
        _sum(f"CAST(settle_count AS {M4})", t + "settle_count"),
        _sum("settle_deposit_amount", t + "settle_deposit_amount"),
        _sum("settle_withdrawal_amount", t + "settle_withdrawal_amount"),
        _sum("settle_bonus_amount", t + "settle_bonus_amount"),
    ]
    return _group(user_game_day(source), keys, columns)


# --- wallet changes -----------------------------------------------------------------


def _wallet_changes() -> list[str]:
    up, down = "type = 'INCREASE'", "type = 'REDUCE'"
    return [
        f"COUNT(*) FILTER (WHERE {up}) AS custom_increase_count",
        f"COUNT(*) FILTER (WHERE {down}) AS custom_reduction_count",
        _sum_if(up, "amount", "custom_increase_amount"),
        _sum_if(f"{up} AND amount_type = 'WITHDRAW'", "amount", "custom_increase_withdraw_amount"),
        _sum_if(f"{up} AND amount_type = 'DEPOSIT'", "amount", "custom_increase_deposit_amount"),
        _sum_if(f"{up} AND amount_type = 'BONUS'", "amount", "custom_increase_bonus_amount"),
        _sum_if(down, "amount", "custom_reduction_amount"),
        _sum_if(f"{down} AND amount_type = 'WITHDRAW'", "amount", "custom_reduction_withdraw_amount"),
        _sum_if(f"{down} AND amount_type = 'DEPOSIT'", "amount", "custom_reduction_deposit_amount"),
        _sum_if(f"{down} AND amount_type = 'BONUS'", "amount", "custom_reduction_bonus_amount"),
    ]


def user_custom_amount(source: str = _AMOUNT) -> str:
    times = ["MIN(src.create_time) AS create_time", "MAX(src.update_time) AS update_time"]
    return _group(source, ["user_id", "channel_id", "statistic_time"], [*_wallet_changes(), *times])


# --- withdrawals --------------------------------------------------------------------

_C, _R = "order_status = 'COMPLETED'", "order_status = 'REJECTED'"
_PAY_DIMS = {
    "pay_category_id": "apply_bank_id",
    "pay_method_id": "withdrawal_mode_id",
    "pay_channel_id": "withdrawal_channel_id",
}
_PAY_KEYS = [
    "statistic_time", "user_id", "channel_id", "pay_category_id", "pay_method_id", "pay_channel_id", "pay_provider_id",
]


def user_withdraw() -> str:
    paid = "withdraw_funds_amount"
    columns = [
        _sum_if(_C, paid, "completed_withdraw_amount"),
        _sum_if(_R, paid, "rejected_withdraw_amount"),
        _sum_if(_C, paid, "success_withdraw_amount"),
        _sum_if(f"{_C} AND first_withdrawal_flag = 1", paid, "first_withdraw_amount"),
        _sum_if(_C, "final_handling_fee", "handling_fee"),
        _sum_if(_C, "gift_amount", "gift_amount"),
        _sum_if(_C, "decrease_handling_amount", "decrease_handling_fee"),
        _count("id", "withdraw_order_count", "INTEGER"),
        _distinct(f"CASE WHEN {_C} THEN order_no END", "withdraw_success_order_count", "INTEGER"),
        _distinct(f"CASE WHEN {_R} THEN order_no END", "rejected_order_count", "INTEGER"),
        _distinct(f"CASE WHEN {_C} THEN order_no END", "completed_order_count", "INTEGER"),
    ]
    return _group(_WITHDRAW, _PAY_KEYS, columns, _PAY_DIMS)


def channel_withdraw(source: str = _WITHDRAW, *, strict: bool = False) -> str:
    first = f"{_C} AND first_withdrawal_flag = 1" if strict else _C
    columns = [
        _distinct("user_id", "user_count", "INTEGER"),
        _sum("withdraw_funds_amount", "withdraw_amount"),
        _sum_if(_C, "final_handling_fee", "handling_fee"),
        _sum_if(_C, "gift_amount", "gift_amount"),
        _sum_if(_C, "decrease_handling_amount", "decrease_handling_fee"),
        _distinct(f"CASE WHEN {_R} THEN order_no END", "rejected_order_count", "INTEGER"),
        _distinct(f"CASE WHEN {_C} THEN order_no END", "completed_order_count", "INTEGER"),
        _distinct(f"CASE WHEN {first} THEN user_id END", "first_user_count", "INTEGER"),
    ]
    return _group(source, ["statistic_time", "channel_id"], columns)


def finance_increment(orders: str, payments: str) -> str:
    """Payment attempts that ended, each beside its order of the same day."""
    keys = "day, user_id, channel_id, category, method, channel, provider"
    return f"""
WITH attempts AS (
  SELECT withdraw_order_no AS number, CAST(update_time AS DATE) AS day, payment_order_no AS attempt,
    TRY_CAST(amount AS {M4}) AS money, COALESCE(withdrawal_channel_id, 0) AS channel, COALESCE(pay_provider_id, 0) AS provider
  FROM ({payments}) WHERE order_status = 'COMPLETED' OR order_status = 'WITHDRAW_FAIL'
), applications AS (
  SELECT order_no AS number, statistic_time AS day, user_id, channel_id, apply_bank_id AS category,
    withdrawal_mode_id AS method, withdraw_funds_amount AS funds, order_status = 'COMPLETED' AS done, update_time AS changed
  FROM ({orders})
), paired AS (SELECT * FROM applications JOIN attempts USING (number, day))
SELECT day AS statistic_time, user_id, channel_id, category AS pay_category_id, method AS pay_method_id,
  channel AS pay_channel_id, provider AS pay_provider_id,
  {_sum("money", "withdraw_amount")}, {_sum_if("done", "funds", "success_withdraw_amount")},
  COUNT(DISTINCT user_id) AS user_count, COUNT(DISTINCT attempt) AS withdraw_order_count,
  {_count_if("done", "withdraw_success_order_count")},
  MAX(changed) AS create_time, MAX(changed) AS update_time
FROM paired GROUP BY {keys}"""


# --- recharges ------------------------------------------------------------------------

_OK = "order_status = 'complete'"


def _recharge_shared() -> list[str]:
    return [
        *(
            _count_if(f"pay_status = '{s}'", f"{s}_order_count", "INTEGER")
            for s in ("pending_payment", "payment_failed", "payment_timeout")
        ),
        _count_if(_OK, "recharge_success_order_count", "INTEGER"),
        _sum_if(f"{_OK} AND first_recharge = 1", "order_amount", "first_recharge_amount"),
        _sum_if(f"{_OK} AND first_recharge = 0", "order_amount", "repeat_recharge_amount"),
        _sum_if(_OK, "actual_handling_fee", "handling_fee"),
        _sum_if(_OK, "actual_gift_amount", "gift_amount"),
        _sum_if(_OK, "actual_decrease_handling_fee", "decrease_handling_fee"),
    ]


def user_recharge(source: str = _RECHARGE) -> str:
    columns = [
        "CAST(-1 AS BIGINT) AS abs_id",
        "CAST(1 AS INTEGER) AS recharge_user_count",
        *_recharge_shared(),
        _count("id", "total_recharge_count", "INTEGER"),
        _count_if("order_status IN ('cancel', 'failed')", "recharge_failed_order_count", "INTEGER"),
        _sum("order_amount", "total_recharge_amount"),
        _sum_if(_OK, "actual_recharge_amount", "success_recharge_amount"),
    ]
    return _group(source, _PAY_KEYS, columns)


def channel_recharge() -> str:
    columns = [
        _distinct(f"CASE WHEN {_OK} AND first_recharge = 1 THEN user_id END", "first_user_count", "INTEGER"),
        _distinct(f"CASE WHEN {_OK} THEN user_id END", "recharge_user_count", "INTEGER"),
        _distinct("user_id", "user_count", "INTEGER"),
        *_recharge_shared(),
    ]
    return _group(_RECHARGE, ["channel_id", "statistic_time"], columns)


# --- referral statistics ----------------------------------------------------------------


def channel_proxy() -> str:
    four = (
        "direct_bet_rebate_amount + direct_recharge_rebate_amount + teams_bet_rebate_amount + teams_recharge_rebate_amount"
    )
    bet, recharge = "betting_rebate_count <> 0", "recharge_rebate_count <> 0"
    columns = [
        _sum("direct_bet_rebate_amount", "direct_bet_rebate_amount"),
        _sum("direct_recharge_rebate_amount", "direct_recharge_rebate_amount"),
        _sum("teams_bet_rebate_amount", "teams_bet_rebate_amount"),
        _sum("teams_recharge_rebate_amount", "teams_recharge_rebate_amount"),
        _sum("invitation_amount", "invitation_amount"),
        _sum("achievement_amount", "achievement_amount"),
        _sum("effective_bet_amount", "total_effective_bet_amount"),
        _count(f"CASE WHEN ({four}) <> 0 THEN user_id END", "commissions_number"),
        _sum("valid_direct_member", "valid_direct_member", "BIGINT"),
        _sum("betting_rebate_count", "betting_rebate_count", "BIGINT"),
        _sum("recharge_rebate_count", "recharge_rebate_count", "BIGINT"),
        _count(f"CASE WHEN {bet} THEN user_id END", "betting_rebate_number"),
        _count(f"CASE WHEN {recharge} THEN user_id END", "recharge_rebate_number"),
        _count(f"CASE WHEN {bet} OR {recharge} THEN user_id END", "rebates_number"),
        _sum("transfer_amount", "total_transfer_amount"),
    ]
    return _group(_PROXY, ["channel_id", "statistic_time"], columns)


# --- rewards --------------------------------------------------------------------------


def _reward_columns(plain_activity_counts: bool) -> list[str]:
    stems = [
        ("vip", "VIP_REWARD", "vip_draw_total"),
        ("rebate", "REBATE_REWARD", "rebate_draw_total"),
        ("activity", "ACTIVITY_REWARD", "activity_total"),
        ("bonus_task", "BONUS_TASK", "bonus_task_total"),
        ("tourist", "TOURIST_TRIAL_BONUS", "tourist_draw_total"),
    ]
    wallets = [("withdrawal", "WITHDRAW"), ("deposit", "DEPOSIT"), ("bonus", "BONUS")]
    out = []
    for stem, scope, whole in stems:
        mine = f"reward_scope = '{scope}'"
        yes, no = f"{mine} AND draw_flag = 1", f"{mine} AND draw_flag = 0"
        if stem != "activity" or plain_activity_counts:
            out += [_count_if(yes, f"{stem}_draw_count"), _count_if(no, f"{stem}_no_draw_count")]
        out += [
            _sum_if(yes, "bonus_amount", f"{stem}_draw_amount"),
            _sum_if(no, "bonus_amount", f"{stem}_no_draw_amount"),
        ]
        for wallet, kind in wallets:
            typed = f"reward_type = '{kind}'"
            out += [
                _sum_if(f"{mine} AND {typed}", "bonus_amount", f"{whole}_{wallet}_amount"),
                _sum_if(f"{yes} AND {typed}", "bonus_amount", f"{stem}_draw_{wallet}_amount"),
                _sum_if(f"{no} AND {typed}", "bonus_amount", f"{stem}_no_draw_{wallet}_amount"),
            ]
    out.append(_sum_if("reward_scope = 'ACTIVITY_REWARD'", "bonus_amount", "activity_total_amount"))
    return out


_NAME = "(activity_type || '|' || CAST(user_id AS VARCHAR) || '|' || CAST(unique_id AS VARCHAR))"


def user_reward_day_activity() -> str:
    act = "reward_scope = 'ACTIVITY_REWARD'"
    columns = [
        _distinct(f"CASE WHEN {act} THEN {_NAME} END", "activity_total_count"),
        _distinct(f"CASE WHEN {act} AND draw_flag = 1 THEN {_NAME} END", "activity_draw_count"),
        _distinct(f"CASE WHEN {act} AND draw_flag = 0 THEN {_NAME} END", "activity_no_draw_count"),
        *_reward_columns(False),
    ]
    renamed = f"SELECT *, COALESCE(activity_type, '') AS activity_label FROM ({_REWARD})"
    keys = ["statistic_time", "user_id", "channel_id", "activity_type"]
    return _group(renamed, keys, columns, {"activity_type": "activity_label"})


def channel_reward() -> str:
    columns = [
        _distinct("user_id", "user_count"),
        *(
            _distinct(f"CASE WHEN reward_scope = '{scope}' THEN user_id END", f"{stem}_user_count")
            for stem, scope in (
                ("vip", "VIP_REWARD"), ("rebate", "REBATE_REWARD"),
                ("activity", "ACTIVITY_REWARD"), ("bonus_task", "BONUS_TASK"),
            )
        ),
        *_reward_columns(True),
    ]
    return _group(_REWARD, ["statistic_time", "channel_id"], columns)


def channel_activity() -> str:
    columns = [
        _distinct("user_id", "user_count"),
        _distinct("user_id", "activity_user_count"),
        "CAST(0 AS BIGINT) AS view_activity_count",
        _distinct(_NAME, "activity_reward_count"),
        _distinct(f"CASE WHEN draw_flag = 1 THEN {_NAME} END", "activity_draw_count"),
        _distinct(f"CASE WHEN draw_flag = 0 THEN {_NAME} END", "activity_no_draw_count"),
        _sum("bonus_amount", "activity_total_amount"),
        _sum_if("draw_flag = 1", "bonus_amount", "activity_draw_amount"),
        _sum_if("draw_flag = 0", "bonus_amount", "activity_no_draw_amount"),
    ]
    for wallet, kind in (("withdrawal", "WITHDRAW"), ("deposit", "DEPOSIT"), ("bonus", "BONUS")):
        typed = f"reward_type = '{kind}'"
        columns += [
            _sum_if(typed, "bonus_amount", f"activity_total_{wallet}_amount"),
            _sum_if(f"draw_flag = 1 AND {typed}", "bonus_amount", f"activity_draw_{wallet}_amount"),
            _sum_if(f"draw_flag = 0 AND {typed}", "bonus_amount", f"activity_no_draw_{wallet}_amount"),
        ]
    source = f"SELECT * FROM ({_REWARD}) WHERE activity_type IS NOT NULL AND reward_scope = 'ACTIVITY_REWARD'"
    return _group(source, ["statistic_time", "channel_id", "activity_type"], columns)


def user_rewards(keys: list[str]) -> str:
    drawn, task = "draw_flag = 1", "reward_scope = 'BONUS_TASK'"
    columns = [
        _sum(
            f"CASE WHEN {drawn} THEN CASE WHEN {task} THEN CASE WHEN reward_type = 'WITHDRAW' THEN bonus_amount ELSE 0 END "
            "ELSE bonus_amount END ELSE 0 END",
            "total_reward_amount",
        ),
        _sum_if(drawn, "1", "total_reward_count", "INTEGER"),
        _sum_if(f"{task} AND draw_flag = 0", "bonus_amount", "total_reward_task_amount"),
        _sum_if(f"{task} AND draw_flag = 0", "1", "total_reward_task_count", "INTEGER"),
        _sum_if(f"{task} AND {drawn}", "bonus_amount", "total_reward_task_draw_amount"),
        _sum_if(f"{task} AND {drawn}", "1", "total_reward_task_draw_count", "INTEGER"),
    ]
    for wallet, kind in (("withdrawal", "WITHDRAW"), ("deposit", "DEPOSIT"), ("bonus", "BONUS")):
        cond = f"reward_type = '{kind}' AND {drawn}"
        columns += [
            _sum_if(cond, "bonus_amount", f"total_reward_{wallet}_amount"),
            _sum_if(cond, "1", f"total_reward_{wallet}_count", "INTEGER"),
        ]
    return _group(_REWARD, keys, columns)


# --- bounty contests --------------------------------------------------------------------


def bounty(*, by_day: bool, compute: bool) -> str:
    families = ("effective_bet", "bet", "punish", "pumped", "profit_loss", "win_loss", "settle")
    wallets = ("deposit", "withdrawal", "bonus")
    whole = {
        "effective_bet": "bet_amount", "bet": "bet_amount", "settle": "settle_amount",
        "punish": "punish_amount", "pumped": "pumped_amount",
        "win_loss": "settle_amount - bet_amount",
        "profit_loss": "settle_amount - bet_amount - COALESCE(punish_amount, 0)",
    }
    split = {
        "effective_bet": "bet_{}_amount", "bet": "bet_{}_amount", "settle": "settle_{}_amount",
        "win_loss": "settle_{0}_amount - bet_{0}_amount", "profit_loss": "settle_{0}_amount - bet_{0}_amount",
        "punish": "0", "pumped": "0",
    }
    columns = []
    for f in families:
        kind = "INTEGER" if f in ("effective_bet", "bet") else M4
        columns.append(_sum(whole[f], f"bounty_total_{f}_amount"))
        happened = f"CASE WHEN {whole[f]} <> 0 THEN 1 END" if f in ("punish", "pumped") else "*"
        columns.append(_count(happened, f"bounty_total_{f}_count", kind))
        columns += [_sum(split[f].format(w), f"bounty_total_{f}_{w}_amount") for w in wallets]
    source = SHAPES["bounty_event"].sql()
    source = f"SELECT *, CAST(update_time AS DATE) AS statistic_time FROM ({source})"
    if not compute:
        source += " WHERE 1 = 0"
    keys = (["statistic_time"] if by_day else []) + ["user_id", "channel_id"]
    return _group(source, keys, columns)


# --- change feeds -----------------------------------------------------------------------


def _replaced(name: str) -> str:
    return "REPLACE (" + ", ".join(f"{e} AS {c}" for c, e in SECOND[name].items()) + ")"


def topic(shape: str, ddl: str, *, deletes: bool = False, pairs: bool = False) -> str:
    """All sides of all published changes of the derived feed."""
    base = f"SELECT {', '.join(schemas.names(ddl))} FROM ({SHAPES[shape].sql()})"
    upd, rem, rep = (t.format("id") for t in (UPDATED, DELETED, REPEATED))
    gone, back = ("d", "c") if pairs else ("u", "u")
    sides = [
        f"SELECT 'c' AS op, CAST(1 AS BIGINT) AS pos, CAST(1 AS INTEGER) AS sign, * FROM ({base})",
        f"SELECT 'c', 1, 1, * FROM ({base}) WHERE {rep}",
        f"SELECT '{gone}', 2, -1, * FROM ({base}) WHERE {upd}",
        f"SELECT '{back}', 2, 1, * {_replaced(shape)} FROM ({base}) WHERE {upd}",
    ]
    if deletes:
        sides += [
            f"SELECT 'd', 3, -1, * FROM ({base}) WHERE {rem} AND NOT ({upd})",
            f"SELECT 'd', 3, -1, * {_replaced(shape)} FROM ({base}) WHERE {rem} AND {upd}",
        ]
    return " UNION ALL ".join(sides)


def cleaned_topic(shape: str, ddl: str, clean: Callable[[str], str]) -> str:
    """All sides of a cleaned table's changes; a side that the rule drops turns an update into a create or delete."""
    base = f"SELECT {', '.join(schemas.names(ddl))} FROM ({SHAPES[shape].sql()})"
    old, new = clean(base), clean(f"SELECT * {_replaced(shape)} FROM ({base})")
    upd, rem = UPDATED.format("id"), DELETED.format("id")
    kind = "CASE WHEN id IN (SELECT id FROM ({})) THEN 'u' ELSE '{}' END"
    return " UNION ALL ".join([
        f"SELECT 'c' AS op, CAST(1 AS BIGINT) AS pos, CAST(1 AS INTEGER) AS sign, * FROM ({old})",
        f"SELECT {kind.format(new, 'd')}, 2, -1, * FROM ({old}) WHERE {upd}",
        f"SELECT {kind.format(old, 'c')}, 2, 1, * FROM ({new}) WHERE {upd}",
        f"SELECT 'd', 3, -1, * FROM ({old}) WHERE {rem} AND NOT ({upd})",
        f"SELECT 'd', 3, -1, * FROM ({new}) WHERE {rem} AND {upd}",
    ])


def live(shape: str, ddl: str | None = None) -> str:
    """Rows left after the derived feed."""
    source = SHAPES[shape].sql()
    columns = ", ".join(schemas.names(ddl or schemas.TABLES[shape]))
    return f"SELECT {columns} FROM ({live_sql(source, shape)})"


_AMOUNT_DDL = schemas.AMOUNT_OPERATION_TOPIC

_LANDING = {n: (f"CAST({n} AS {t})" if t.startswith("decimal") else n) for n, t in schemas.fields(schemas.GAME_RECORD_LANDING)}


def _row_kinds() -> str:
    base = f"SELECT id, channel_id, order_amount FROM ({SHAPES['recharge_order'].sql()})"
    sides = [
        f"SELECT 'c' AS op, 1 AS sign, * FROM ({base})",
        f"SELECT 'u', -1, * FROM ({base}) WHERE {UPDATED.format('id')}",
        f"SELECT 'u', 1, * FROM ({base}) WHERE {UPDATED.format('id')}",
        f"SELECT 'd', -1, * FROM ({base}) WHERE {DELETED.format('id')}",
    ]
    return (
        f"SELECT channel_id, op, CAST(SUM(sign) AS BIGINT) AS net_rows, "
        f"CAST(SUM(sign * order_amount) AS {M4}) AS net_amount "
        f"FROM ({' UNION ALL '.join(sides)}) GROUP BY channel_id, op"
    )


def _newest(source: str, keys: str, order: str, columns: str) -> str:
    return (
        f"SELECT {columns} FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY {keys} ORDER BY {order}) AS version_rank "
        f"FROM ({source})) WHERE version_rank = 1"
    )


def _reward_landing() -> str:
    names = schemas.names(schemas.REWARD_RECORD_LANDING)
    keys = ["user_id", "unique_id", "create_time"]
    rest = ["update_time"] + [n for n in names if n not in keys and n != "update_time"]
    order = ", ".join(f"{c} DESC NULLS LAST" for c in rest)
    return _newest(f"SELECT * FROM ({_REWARD}) WHERE id IS NOT NULL", ", ".join(keys), order, ", ".join(names))


_PEOPLE_HASH = ", ".join(f"sha256({c}) AS {c}" for c in ("password", "user_phone", "user_email"))

_ONLINE_NAMES = schemas.names(schemas.USER_ONLINE_STATUS_RECORD)
_ONLINE = _newest(
    f"SELECT * FROM ({clean_online(SHAPES['online_event'].sql())}) WHERE create_time IS NOT NULL",
    "user_id, create_time",
    ", ".join(f"{c} DESC NULLS LAST" for c in _ONLINE_NAMES if c not in ("user_id", "create_time")),
    ", ".join(_ONLINE_NAMES),
)


def _game_landing() -> str:
    """Live bets, one a key of order number and creation time."""
    rows = f"SELECT {', '.join(f'{e} AS {n}' for n, e in _LANDING.items())} FROM ({live_sql(SHAPES['game_event'].sql(), 'game_event')})"
    rest = ["update_time"] + [n for n in _LANDING if n not in ("order_no", "create_time", "update_time")]
    rows = f"SELECT * FROM ({rows}) WHERE order_no IS NOT NULL AND create_time IS NOT NULL"
    return _newest(rows, "order_no, create_time", ", ".join(f"{c} DESC NULLS LAST" for c in rest), ", ".join(_LANDING))


_DEVICES = """
SELECT c.customer, c.user_id,
  CASE WHEN c.user_id IS NULL THEN 'unknown' ELSE COALESCE('device_id: ' || d.device_id, 'no_device') END AS dimension_info
FROM (SELECT c_custkey AS customer, CASE WHEN c_custkey % 50 = 0 THEN NULL ELSE c_custkey END AS user_id FROM customer) AS c
LEFT JOIN (SELECT user_id, MIN('d' || CAST(event_id % 50 AS VARCHAR)) AS device_id FROM events GROUP BY user_id) AS d
  ON d.user_id = c.user_id"""

_STATUS = """
SELECT CASE o_orderkey % 4 WHEN 0 THEN 'PENDING' WHEN 1 THEN 'PAID' WHEN 2 THEN 'CANCELLED' ELSE 'REFUNDED' END AS order_status,
  COUNT(*) AS orders FROM orders GROUP BY 1"""


def _window(source: str, time: str, unit: str, columns: str) -> str:
    return (
        f"SELECT date_trunc('{unit}', {time}) AS window_start, date_trunc('{unit}', {time}) + INTERVAL 1 {unit} AS window_end, "
        f"{columns} FROM ({source}) GROUP BY 1, 2"
    )


def _codes(code: str, labels: dict[int, str], name: str) -> str:
    cases = " ".join(f"WHEN {k} THEN '{v}'" for k, v in labels.items())
    return f"SELECT CASE {code} {cases} END AS {name}, COUNT(*) AS events FROM events GROUP BY 1"


def _closed_windows() -> str:
    """Hours that ended five minutes before the last event; events that came after theirs was closed are left out."""
    rows = (
        f"SELECT ts, CAST(value AS {M4}) AS order_amount FROM events "
        "WHERE NOT (event_id % 97 = 0 AND ts < TIMESTAMP '2024-01-11 00:00:00')"
    )
    hours = _window(rows, "ts", "hour", f"COUNT(*) AS order_count, {_sum('order_amount', 'order_amount')}")
    return f"SELECT * FROM ({hours}) WHERE window_end <= (SELECT MAX(ts) - INTERVAL 5 MINUTE FROM events)"


def _expired() -> str:
    """Runs of a user's rewards without 36 silent hours, if that many have passed since the last one."""
    gaps = (
        "SELECT *, CASE WHEN update_time <= LAG(update_time) OVER (PARTITION BY user_id ORDER BY update_time) + INTERVAL 36 HOUR "
        f"THEN 0 ELSE 1 END AS begins FROM ({_REWARD})"
    )
    lives = f"SELECT *, SUM(begins) OVER (PARTITION BY user_id ORDER BY update_time) AS life FROM ({gaps})"
    return (
        "SELECT user_id, MIN(update_time) AS first_change, MAX(update_time) AS last_change, COUNT(*) AS reward_count, "
        f"{_sum('bonus_amount', 'reward_amount')} FROM ({lives}) GROUP BY user_id, life "
        f"HAVING MAX(update_time) + INTERVAL 36 HOUR <= (SELECT MAX(update_time) - INTERVAL 5 MINUTE FROM ({_REWARD}))"
    )


def _looked_up() -> str:
    devices = live_sql("SELECT event_id AS id, user_id, 'd' || CAST(event_id % 50 AS VARCHAR) AS device_id FROM events", "device")
    return f"""
SELECT c.customer, c.user_id,
  CASE WHEN c.user_id IS NULL THEN 'unknown' ELSE COALESCE('device_id: ' || d.device_id, 'no_device') END AS dimension_info
FROM (SELECT c_custkey AS customer, CASE WHEN c_custkey % 50 = 0 THEN NULL ELSE c_custkey END AS user_id FROM customer) AS c
LEFT JOIN (SELECT user_id, MIN(device_id) AS device_id FROM ({devices}) GROUP BY user_id) AS d ON d.user_id = c.user_id"""


_LIVE_EVENTS = clean_game(live_sql(SHAPES["game_event"].sql(), "game_event"))
_USER_DAY, _USER_ALL = ["statistic_time", "user_id", "channel_id"], ["user_id", "channel_id"]

ORACLES: dict[str, str] = {
    "dwd_game_record": _GAME,
    "dwd_recharge_order": _RECHARGE,
    "dwd_withdraw_order": _WITHDRAW,
    "dwd_amount_operation_record": _AMOUNT,
    "dwd_user_proxy_statistic": _PROXY,
    "dwd_reward_record": _REWARD,
    "dwd_user_online": _ONLINE,
    "dws_user_game_day": user_game_day(),
    "dws_user_game_hour": user_game_hour(_GAME_EVENTS),
    "dws_channel_game_category": channel_game(_GAME, "game_category_id"),
    "dws_channel_game_provider": channel_game(_GAME, "third_platform_provider_type"),
    "dws_channel_game": channel_game(_GAME),
    "dws_user_custom_amount": user_custom_amount(),
    "dws_channel_custom_amount": _group(_AMOUNT, ["channel_id", "statistic_time"], [_USERS, *_wallet_changes()]),
    "dws_user_withdraw": user_withdraw(),
    "dws_channel_withdraw": channel_withdraw(),
    "dws_channel_withdraw_strict_first": channel_withdraw(strict=True),
    "dws_finance_increment": finance_increment(_WITHDRAW, SHAPES["third_withdraw_payment_order"].sql()),
    "dws_user_recharge": user_recharge(),
    "dws_channel_recharge": channel_recharge(),
    "dws_channel_proxy": channel_proxy(),
    "dws_user_reward": user_reward_day_activity(),
    "dws_channel_reward": channel_reward(),
    "dws_channel_activity": channel_activity(),
    "rollup_user_game_day": user_game_day(),
    "rollup_channel_game_category": channel_game(_GAME, "game_category_id"),
    "rollup_channel_game": channel_game(_GAME),
    "ads_user_game_day": user_games(_USER_DAY),
    "ads_user_game_total": user_games(_USER_ALL),
    "ads_user_reward_day": user_rewards(_USER_DAY),
    "ads_user_reward_total": user_rewards(_USER_ALL),
    "ads_user_bounty_day": bounty(by_day=True, compute=False),
    "ads_user_bounty_total": bounty(by_day=False, compute=False),
    "ads_user_bounty_day_computed": bounty(by_day=True, compute=True),
    "ads_user_bounty_total_computed": bounty(by_day=False, compute=True),
    "ods_game_record": topic("game_event", schemas.GAME_RECORD),
    "ods_recharge_order": topic("recharge_order", schemas.RECHARGE_ORDER),
    "ods_withdraw_order": topic("withdraw_order", schemas.WITHDRAW_ORDER),
    "ods_third_withdraw_payment_order": topic("third_withdraw_payment_order", schemas.THIRD_WITHDRAW_PAYMENT_ORDER),
    "ods_user_proxy_statistic": topic("user_proxy_statistic", schemas.USER_PROXY_STATISTIC, deletes=True),
    "ods_amount_operation_record": topic("amount_operation_record", _AMOUNT_DDL),
    "ods_change_pairs": topic("recharge_order", schemas.RECHARGE_ORDER, pairs=True),
    "ods_changelog_apply": live("withdraw_order"),
    "ods_row_kinds": _row_kinds(),
    "ods_latest_version": _newest(
        SHAPES["game_record"].sql(), "id",
        "update_time DESC, bet_amount DESC, game_id DESC, game_category_id DESC",
        "id, update_time, bet_amount, game_id, game_category_id",
    ),
    "ods_shard_union": (
        "SELECT id, user_id, bet_amount, update_time, 'game_record_' || CAST(id % 8 AS VARCHAR) AS _shard "
        f"FROM ({SHAPES['game_event'].sql()})"
    ),
    **{f"dim_{name}": live(name) for name in DIMENSIONS},
    "dim_user_proxy_statistic": live("user_proxy_statistic"),
    "dim_protected_user": f"SELECT user_id, {_PEOPLE_HASH} FROM ({SHAPES['user'].sql()})",
    "game_record_landing": _game_landing(),
    "reward_record_landing": _reward_landing(),
    "change_json_roundtrip": f"SELECT * FROM ({_REWARD}) WHERE id % 101 <> 0",
    "sink_not_null": f"SELECT * FROM ({user_recharge()}) WHERE pay_channel_id IS NOT NULL",
    "lookup_user_device": _DEVICES,
    "decode_order_status": _STATUS,
    "window_login_minute": _window(
        f"SELECT * FROM ({_ONLINE}) WHERE online_time IS NOT NULL",
        "online_time", "minute", "COUNT(*) AS login_count",
    ),
    "window_order_hour": _window(
        f"SELECT ts, CAST(value AS {M4}) AS order_amount FROM events", "ts", "hour",
        f"COUNT(*) AS order_count, {_sum('order_amount', 'order_amount')}",
    ),
    "stream_channel_game": channel_game(clean_game(live_sql(SHAPES["game_event"].sql(), "game_event"))),
    "stream_restart": channel_game(_LIVE_EVENTS),
    "stream_channel_game_repeats": channel_game(_LIVE_EVENTS),
    "stream_channel_withdraw_repeats": channel_withdraw(
        clean_withdraw(live_sql(SHAPES["withdraw_order"].sql(), "withdraw_order"))
    ),
    "stream_channel_game_fan_out": " UNION ALL ".join(
        f"SELECT statistic_time, channel_id, user_count, bet_amount, '{name}' AS mart FROM ({channel_game(_LIVE_EVENTS, key)})"
        for name, key in (("provider", "third_platform_provider_type"), ("category", "game_category_id"))
    ),
    "stream_window_order_hour": _closed_windows(),
    "stream_channel_reward": channel_reward(),
    "stream_channel_activity": channel_activity(),
    "decode_game_id": _codes("1000 + event_id % 5", {1001: "KING_GLORY", 1002: "GENSHIN", 1003: "PUBG"}, "game_name"),
    "decode_device_type": _codes("event_id % 5", {1: "IOS", 2: "ANDROID", 3: "PC"}, "device_type"),
    "stream_user_game_hour": user_game_hour(clean_game(live_sql(SHAPES["game_event"].sql(), "game_event"))),
    "stream_channel_withdraw": channel_withdraw(clean_withdraw(live_sql(SHAPES["withdraw_order"].sql(), "withdraw_order"))),
    "stream_user_recharge": user_recharge(clean_recharge(live_sql(SHAPES["recharge_order"].sql(), "recharge_order"))),
    "stream_user_reward_total": user_rewards(_USER_ALL),
    "stream_upsert_replay": live("user_info"),
    "stream_user_game_ads_day": user_games(_USER_DAY, _LIVE_EVENTS),
    "stream_user_game_ads_total": user_games(_USER_ALL, _LIVE_EVENTS),
    "stream_multi_table": " UNION ALL ".join(
        f"SELECT '{name}' AS table, id, channel_id, {amount} AS amount FROM ({live_sql(SHAPES[name].sql(), name)})"
        for name, amount in (
            ("withdraw_order", "withdraw_funds_amount"), ("recharge_order", "order_amount"), ("user_info", "current_level_recharge_amount"),
        )
    ),
    "stream_lookup_user_device": _looked_up(),
    "stream_user_reward_expiring": _expired(),
    "dwd_topic_game_record": cleaned_topic("game_event", schemas.GAME_RECORD, clean_game),
    "dwd_topic_recharge_order": cleaned_topic("recharge_order", schemas.RECHARGE_ORDER, clean_recharge),
    "dwd_topic_withdraw_order": cleaned_topic("withdraw_order", schemas.WITHDRAW_ORDER, clean_withdraw),
    "dwd_topic_amount_operation_record": cleaned_topic("amount_operation_record", _AMOUNT_DDL, clean_amount),
    "dwd_topic_user_proxy_statistic": cleaned_topic("user_proxy_statistic", schemas.USER_PROXY_STATISTIC, clean_proxy),
    "dwd_topic_reward_record": f"SELECT 'c' AS op, CAST(0 AS BIGINT) AS pos, CAST(1 AS INTEGER) AS sign, * FROM ({_REWARD})",
    "dim_user_chunked": live("user_info"),
    "stream_user_custom_amount": user_custom_amount(
        clean_amount(live_sql(SHAPES["amount_operation_record"].sql(), "amount_operation_record"))
    ),
    "stream_finance_increment": finance_increment(
        clean_withdraw(live_sql(SHAPES["withdraw_order"].sql(), "withdraw_order")), live_sql(SHAPES["third_withdraw_payment_order"].sql(), "third_withdraw_payment_order"),
    ),
}
