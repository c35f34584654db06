"""Measure packs: the aggregates every mart is made of, declared once.

A measure is a name, an aggregate kind and a SQL expression over one cleaned
row.  Keeping the expression apart from the aggregate lets the same declaration
serve a one-level aggregate, a two-level aggregate with exact distinct counts
and a signed (retractable) ledger.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

MONEY = "decimal(20,4)"


@dataclass(frozen=True)
class Measure:
    """``kind(expr)`` published as ``name`` with the declared column type."""

    name: str
    kind: str  # sum | count | min | max
    expr: str
    type: str = MONEY
    # the category values the condition fixes, one per column of ``Cells`` (None: any)
    cell: tuple = ()


@dataclass(frozen=True)
class Distinct:
    """Exact number of distinct non-NULL ``value`` among rows where ``when`` holds."""

    name: str
    value: str
    when: str | None = None
    type: str = "bigint"


@dataclass(frozen=True)
class Cells:
    """Categorical columns that all conditions of a pack are made of, and the summed amount.

    ``dims`` lists the values of each column; a ``None`` among them stands for any
    other value.
    """

    dims: Mapping[str, tuple]
    amount: str


def total(name: str, expr: str | None = None, type: str = MONEY) -> Measure:
    return Measure(name, "sum", expr or name, type)


def total_if(name: str, cond: str, expr: str, type: str = MONEY) -> Measure:
    """Conditional sum: rows outside the condition add 0, so they never make it NULL."""
    return Measure(name, "sum", f"IF({cond}, {expr}, 0)", type)


def tally(name: str, expr: str = "1", type: str = "bigint") -> Measure:
    return Measure(name, "count", expr, type)


def tally_if(name: str, cond: str, type: str = "bigint") -> Measure:
    return Measure(name, "count", f"IF({cond}, 1, NULL)", type)


WALLETS = ("deposit", "withdrawal", "bonus")


# --- bets ---------------------------------------------------------------------


def bet_pack(*, numeric_flag: bool) -> tuple[Measure, ...]:
    """Bet counts and amounts, in total and by wallet.

    ``numeric_flag`` adds up the flag itself (a flag of 2 counts twice, a NULL
    flag counts as missing); otherwise only flags equal to 1 are counted.
    """
    effective = "effective_bet_flag = 1"
    flag = "CAST(effective_bet_flag AS BIGINT)" if numeric_flag else f"IF({effective}, 1, 0)"
    by_wallet = [
        measure
        for stem, column in (("bet", "bet"), ("settle", "settle"), ("win_lose", "transfer"))
        for wallet in WALLETS
        for measure in [total(f"{stem}_{wallet}_amount", f"{column}_{wallet}_amount")]
    ]
    return (
        tally("bet_count", "order_no"),
        total("effective_bet_count", flag, "bigint"),
        tally("settle_count"),
        total("settle_bet_amount", "bet_amount"),
        total("bet_amount"),
        total("settle_amount"),
        total("win_lose_amount", "transfer_amount"),
        total_if("effective_bet_amount", effective, "valid_bet_amount"),
        *by_wallet,
        *(
            total_if(f"effective_bet_{w}_amount", effective, f"valid_bet_{w}_amount")
            for w in WALLETS
        ),
    )


PROFIT_AND_LOSS = total("profit_and_loss_amount", "-transfer_amount")


def user_game_pack() -> tuple[Measure, ...]:
    """Second-level sums over the user-game day mart."""
    third = "third_party_total_"
    # Published name stem and the mart column it adds up.
    amounts = {
        "effective_bet_amount": "effective_bet_amount",
        "effective_bet_deposit_amount": "effective_bet_deposit_amount",
        "effective_bet_withdrawal_amount": "effective_bet_withdrawal_amount",
        "effective_bet_bonus_amount": "effective_bet_bonus_amount",
        "win_loss_amount": "win_lose_amount",
        "win_loss_withdraw_amount": "win_lose_withdrawal_amount",
        "win_loss_deposit_amount": "win_lose_deposit_amount",
        "win_loss_bonus_amount": "win_lose_bonus_amount",
        "settle_bet_amount": "settle_bet_amount",
        "bet_amount": "bet_amount",
        "bet_deposit_amount": "bet_deposit_amount",
        "bet_withdrawal_amount": "bet_withdrawal_amount",
        "bet_bonus_amount": "bet_bonus_amount",
        "settle_amount": "settle_amount",
        "settle_deposit_amount": "settle_deposit_amount",
        "settle_withdrawal_amount": "settle_withdrawal_amount",
        "settle_bonus_amount": "settle_bonus_amount",
    }
    return (
        total("total_effective_bet_amount", "effective_bet_amount"),
        total("total_effective_bet_count", "effective_bet_count", "int"),
        total(third + "effective_bet_count", "effective_bet_count", "int"),
        total(third + "bet_count", "bet_count", "int"),
        total(third + "settle_count", f"CAST(settle_count AS {MONEY})"),
        *(total(third + name, column) for name, column in amounts.items()),
    )


# Negated win/loss over the settled stake; 0 when nothing was staked.
KILL_RATE = (
    "third_party_total_kill_rate",
    "CASE WHEN third_party_total_settle_bet_amount = 0 THEN 0 "
    "ELSE -third_party_total_win_loss_amount / third_party_total_settle_bet_amount END",
    MONEY,
)


# --- manual wallet changes -------------------------------------------------------


def wallet_change_pack() -> tuple[Measure, ...]:
    directions = (("increase", "INCREASE"), ("reduction", "REDUCE"))
    wallets = (("withdraw", "WITHDRAW"), ("deposit", "DEPOSIT"), ("bonus", "BONUS"))
    pack: list[Measure] = []
    for stem, code in directions:
        pack.append(tally_if(f"custom_{stem}_count", f"type = '{code}'"))
        pack.append(total_if(f"custom_{stem}_amount", f"type = '{code}'", "amount"))
        pack += [
            total_if(
                f"custom_{stem}_{wallet}_amount",
                f"type = '{code}' AND amount_type = '{kind}'",
                "amount",
            )
            for wallet, kind in wallets
        ]
    return tuple(pack)


FIRST_CREATED = Measure("create_time", "min", "create_time", "timestamp_ntz")
LAST_UPDATED = Measure("update_time", "max", "update_time", "timestamp_ntz")


# --- withdrawals ------------------------------------------------------------------

DONE = "order_status = 'COMPLETED'"
REJECTED = "order_status = 'REJECTED'"

_WITHDRAW_COSTS = (
    total_if("handling_fee", DONE, "final_handling_fee"),
    total_if("gift_amount", DONE, "gift_amount"),
    total_if("decrease_handling_fee", DONE, "decrease_handling_amount"),
)


def user_withdraw_pack() -> tuple[Measure, ...]:
    paid = "withdraw_funds_amount"
    return (
        total_if("completed_withdraw_amount", DONE, paid),
        total_if("rejected_withdraw_amount", REJECTED, paid),
        total_if("success_withdraw_amount", DONE, paid),
        total_if("first_withdraw_amount", f"{DONE} AND first_withdrawal_flag = 1", paid),
        *_WITHDRAW_COSTS,
        tally("withdraw_order_count", "id", "int"),
    )


def user_withdraw_distincts() -> tuple[Distinct, ...]:
    return (
        Distinct("withdraw_success_order_count", "order_no", DONE, "int"),
        Distinct("rejected_order_count", "order_no", REJECTED, "int"),
        Distinct("completed_order_count", "order_no", DONE, "int"),
    )


def channel_withdraw_pack() -> tuple[Measure, ...]:
    return (total("withdraw_amount", "withdraw_funds_amount"), *_WITHDRAW_COSTS)


def channel_withdraw_distincts(*, strict_first: bool) -> tuple[Distinct, ...]:
    """``strict_first`` also asks for the first-withdrawal flag, which the published mart ignores."""
    first = f"{DONE} AND first_withdrawal_flag = 1" if strict_first else DONE
    return (
        Distinct("user_count", "user_id", None, "int"),
        Distinct("first_user_count", "user_id", first, "int"),
        Distinct("rejected_order_count", "order_no", REJECTED, "int"),
        Distinct("completed_order_count", "order_no", DONE, "int"),
    )


# --- recharges --------------------------------------------------------------------

PAID_UP = "order_status = 'complete'"
FIRST_PAID = f"{PAID_UP} AND first_recharge = 1"
REPEAT_PAID = f"{PAID_UP} AND first_recharge = 0"

_RECHARGE_COUNTS = tuple(
    tally_if(f"{status}_order_count", f"pay_status = '{status}'", "int")
    for status in ("pending_payment", "payment_failed", "payment_timeout")
) + (tally_if("recharge_success_order_count", PAID_UP, "int"),)

_RECHARGE_MONEY = (
    total_if("first_recharge_amount", FIRST_PAID, "order_amount"),
    total_if("repeat_recharge_amount", REPEAT_PAID, "order_amount"),
    total_if("handling_fee", PAID_UP, "actual_handling_fee"),
    total_if("gift_amount", PAID_UP, "actual_gift_amount"),
    total_if("decrease_handling_fee", PAID_UP, "actual_decrease_handling_fee"),
)


def user_recharge_pack() -> tuple[Measure, ...]:
    return (
        *_RECHARGE_COUNTS,
        tally("total_recharge_count", "id", "int"),
        tally_if("recharge_failed_order_count", "order_status = 'cancel' OR order_status = 'failed'", "int"),
        total("total_recharge_amount", "order_amount"),
        total_if("success_recharge_amount", PAID_UP, "actual_recharge_amount"),
        *_RECHARGE_MONEY,
    )


def channel_recharge_pack() -> tuple[Measure, ...]:
    return (*_RECHARGE_COUNTS, *_RECHARGE_MONEY)


def channel_recharge_distincts() -> tuple[Distinct, ...]:
    return (
        Distinct("user_count", "user_id", None, "int"),
        Distinct("first_user_count", "user_id", FIRST_PAID, "int"),
        Distinct("recharge_user_count", "user_id", PAID_UP, "int"),
    )


# --- referral statistics ------------------------------------------------------------


def proxy_pack() -> tuple[Measure, ...]:
    commissions = (
        "direct_bet_rebate_amount",
        "direct_recharge_rebate_amount",
        "teams_bet_rebate_amount",
        "teams_recharge_rebate_amount",
    )
    bet, recharge = "betting_rebate_count <> 0", "recharge_rebate_count <> 0"

    def users(name: str, cond: str) -> Measure:
        return tally(name, f"IF({cond}, user_id, NULL)")

    return (
        *(total(column) for column in commissions),
        total("invitation_amount"),
        total("achievement_amount"),
        total("total_effective_bet_amount", "effective_bet_amount"),
        # one missing commission makes the sum NULL, so the row is not counted
        users("commissions_number", f"({' + '.join(commissions)}) <> 0"),
        total("valid_direct_member", type="bigint"),
        total("betting_rebate_count", type="bigint"),
        total("recharge_rebate_count", type="bigint"),
        users("betting_rebate_number", bet),
        users("recharge_rebate_number", recharge),
        users("rebates_number", f"{bet} OR {recharge}"),
        total("total_transfer_amount", "transfer_amount"),
    )


# --- rewards ------------------------------------------------------------------------

# Reward scopes, with the stem of their published columns and the
# stem of the columns that ignore the draw state.
REWARD_SCOPES = {
    "VIP_REWARD": ("vip", "vip_draw_total"),
    "REBATE_REWARD": ("rebate", "rebate_draw_total"),
    "ACTIVITY_REWARD": ("activity", "activity_total"),
    "BONUS_TASK": ("bonus_task", "bonus_task_total"),
    "TOURIST_TRIAL_BONUS": ("tourist", "tourist_draw_total"),
}
# Reward types and the wallet named in the published columns.
REWARD_TYPES = {"WITHDRAW": "withdrawal", "DEPOSIT": "deposit", "BONUS": "bonus"}
DRAW_STATES = {"draw": 1, "no_draw": 0}

REWARD_FILTER = "update_time IS NOT NULL AND reward_scope IN ({})".format(
    ", ".join(f"'{scope}'" for scope in REWARD_SCOPES)
)


# every reward condition is a combination of these columns
REWARD_CELLS = Cells(
    {
        "reward_scope": tuple(REWARD_SCOPES),
        "reward_type": (*REWARD_TYPES, None),
        "draw_flag": tuple(DRAW_STATES.values()),
    },
    "bonus_amount",
)


def _reward(name: str, kind: str, *cell) -> Measure:
    """Count or amount of the rewards in a category combination."""
    fixed = zip(REWARD_CELLS.dims, cell)
    cond = " AND ".join(f"{c} = {v!r}" for c, v in fixed if v is not None)
    if kind == "count":
        return Measure(name, "count", f"IF({cond}, 1, NULL)", "bigint", cell)
    return Measure(name, "sum", f"IF({cond}, bonus_amount, 0)", MONEY, cell)


def _scope_pack(scope: str, *, activity_counts: bool) -> list[Measure]:
    stem, total_stem = REWARD_SCOPES[scope]
    pack = [
        _reward(f"{total_stem}_{wallet}_amount", "sum", scope, kind, None)
        for kind, wallet in REWARD_TYPES.items()
    ]
    for state, flag in DRAW_STATES.items():
        if scope != "ACTIVITY_REWARD" or activity_counts:
            pack.append(_reward(f"{stem}_{state}_count", "count", scope, None, flag))
        pack.append(_reward(f"{stem}_{state}_amount", "sum", scope, None, flag))
        pack += [
            _reward(f"{stem}_{state}_{wallet}_amount", "sum", scope, kind, flag)
            for kind, wallet in REWARD_TYPES.items()
        ]
    if scope == "ACTIVITY_REWARD":
        pack.append(_reward("activity_total_amount", "sum", scope, None, None))
    return pack


def reward_pack(*, activity_counts: bool) -> tuple[Measure, ...]:
    """Counts and amounts of all scopes by draw state and wallet.

    With ``activity_counts`` the activity scope gets plain row counts; the user
    mart counts distinct activity rewards instead (``activity_distincts``).
    """
    return tuple(m for s in REWARD_SCOPES for m in _scope_pack(s, activity_counts=activity_counts))


# A reward is named by activity, user and reward number; any NULL part means "no name".
_NAMED_ACTIVITY = (
    "IF(reward_scope = 'ACTIVITY_REWARD' AND activity_type IS NOT NULL AND user_id IS NOT NULL, "
    "unique_id, NULL)"
)


def user_activity_distincts() -> tuple[Distinct, ...]:
    """Activity and user are grouping keys here, so the reward number alone is distinct-counted."""
    return (
        Distinct("activity_total_count", _NAMED_ACTIVITY),
        Distinct("activity_draw_count", _NAMED_ACTIVITY, "draw_flag = 1"),
        Distinct("activity_no_draw_count", _NAMED_ACTIVITY, "draw_flag = 0"),
    )


def channel_reward_distincts() -> tuple[Distinct, ...]:
    scoped = ("VIP_REWARD", "REBATE_REWARD", "ACTIVITY_REWARD", "BONUS_TASK")
    return (
        Distinct("user_count", "user_id"),
        *(
            Distinct(f"{REWARD_SCOPES[s][0]}_user_count", "user_id", f"reward_scope = '{s}'")
            for s in scoped
        ),
    )


def channel_activity_pack() -> tuple[Measure, ...]:
    pack = [
        Measure("view_activity_count", "sum", "0", "bigint"),
        total("activity_total_amount", "bonus_amount"),
    ]
    for kind, wallet in REWARD_TYPES.items():
        pack.append(total_if(f"activity_total_{wallet}_amount", f"reward_type = '{kind}'", "bonus_amount"))
    for state, flag in DRAW_STATES.items():
        pack.append(total_if(f"activity_{state}_amount", f"draw_flag = {flag}", "bonus_amount"))
        pack += [
            total_if(
                f"activity_{state}_{wallet}_amount",
                f"draw_flag = {flag} AND reward_type = '{kind}'",
                "bonus_amount",
            )
            for kind, wallet in REWARD_TYPES.items()
        ]
    return tuple(pack)


def channel_activity_distincts() -> tuple[Distinct, ...]:
    named = "CAST(user_id AS STRING) || '|' || CAST(unique_id AS STRING)"
    return (
        Distinct("user_count", "user_id"),
        Distinct("activity_user_count", "user_id"),
        Distinct("activity_reward_count", named),
        Distinct("activity_draw_count", named, "draw_flag = 1"),
        Distinct("activity_no_draw_count", named, "draw_flag = 0"),
    )


def user_reward_pack() -> tuple[Measure, ...]:
    drawn = "draw_flag = 1"
    task = "reward_scope = 'BONUS_TASK'"
    pack = [
        # a drawn bonus task only counts when it was paid to the withdrawable wallet
        total_if("total_reward_amount", drawn, f"IF({task}, IF(reward_type = 'WITHDRAW', bonus_amount, 0), bonus_amount)"),
        total_if("total_reward_count", drawn, "1", "int"),
        total_if("total_reward_task_amount", f"{task} AND draw_flag = 0", "bonus_amount"),
        total_if("total_reward_task_count", f"{task} AND draw_flag = 0", "1", "int"),
        total_if("total_reward_task_draw_amount", f"{task} AND {drawn}", "bonus_amount"),
        total_if("total_reward_task_draw_count", f"{task} AND {drawn}", "1", "int"),
    ]
    for kind, wallet in REWARD_TYPES.items():
        cond = f"reward_type = '{kind}' AND {drawn}"
        pack.append(total_if(f"total_reward_{wallet}_amount", cond, "bonus_amount"))
        pack.append(total_if(f"total_reward_{wallet}_count", cond, "1", "int"))
    return tuple(pack)


# --- bounty contests ----------------------------------------------------------------


def bounty_columns() -> list[tuple[str, str]]:
    """Measure columns of the bounty marts: seven families, in total, by count and by wallet."""
    families = ("effective_bet", "bet", "punish", "pumped", "profit_loss", "win_loss", "settle")
    out = []
    for family in families:
        count_type = "int" if family in ("effective_bet", "bet") else MONEY
        out.append((f"bounty_total_{family}_amount", MONEY))
        out.append((f"bounty_total_{family}_count", count_type))
        out += [(f"bounty_total_{family}_{wallet}_amount", MONEY) for wallet in WALLETS]
    return out


def bounty_pack() -> tuple[Measure, ...]:
    """Bounty sums from the columns the event carries.

    Every row counts as one effective bet; win/loss is settled minus staked and
    profit/loss is win/loss minus the penalty.  Penalties and commissions have no
    split by wallet in the event, so those columns stay 0.
    """
    amounts = {
        "effective_bet": "bet{}_amount",
        "bet": "bet{}_amount",
        "settle": "settle{}_amount",
        "win_loss": "settle{0}_amount - bet{0}_amount",
    }
    formula = {
        "punish": "punish_amount",
        "pumped": "pumped_amount",
        "profit_loss": "settle_amount - bet_amount - COALESCE(punish_amount, 0)",
    }
    wallet_formula = {"profit_loss": "settle{0}_amount - bet{0}_amount"}
    types = dict(bounty_columns())
    pack = []
    for family in ("effective_bet", "bet", "punish", "pumped", "profit_loss", "win_loss", "settle"):
        whole = amounts[family].format("") if family in amounts else formula[family]
        split = amounts.get(family) or wallet_formula.get(family) or "0"
        name = f"bounty_total_{family}_amount"
        pack.append(total(name, whole))
        name = f"bounty_total_{family}_count"
        pack.append(tally(name, f"IF(({whole}) <> 0, 1, NULL)", types[name]) if family in ("punish", "pumped") else tally(name, "1", types[name]))
        pack += [
            total(f"bounty_total_{family}_{wallet}_amount", split.format(f"_{wallet}")) for wallet in WALLETS
        ]
    return tuple(pack)
