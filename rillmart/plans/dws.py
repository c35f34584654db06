"""Day- and hour-grain marts over the cleaned tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillmart.functions import measures as m
from rillmart.operators.aggregate import aggregate, aggregate_once
from rillmart.operators.mart import Mart, by

_USERS = (m.Distinct("user_count", "user_id"),)
_BETS = m.bet_pack(numeric_flag=True)

USER_GAME_DAY = Mart(
    "today_user_game_statistics_dws",
    "dwd_game_record",
    by("statistic_time", "user_id", "channel_id", "game_id", "game_category_id", "third_platform_provider_type"),
    m.bet_pack(numeric_flag=False),
)

# Grouped by its declared key: the game category is not part of it.
USER_GAME_HOUR = Mart(
    "today_user_hour_game_ug_statistics_data",
    "dwd_game_record",
    by("statistic_time", "statistic_hour", "user_id", "channel_id", "game_id", "third_platform_provider_type"),
    (*_BETS, m.PROFIT_AND_LOSS),
)

# Bets mostly come joined or compacted, so these marts read them once.
CHANNEL_GAME_CATEGORY = Mart(
    "today_channel_game_category_statistic",
    "dwd_game_record",
    by("statistic_time", "channel_id", "game_category_id"),
    _BETS,
    _USERS,
    one_pass=True,
)

CHANNEL_GAME_PROVIDER = Mart(
    "today_channel_game_provider_statistic",
    "dwd_game_record",
    by("statistic_time", "channel_id", "third_platform_provider_type"),
    _BETS,
    _USERS,
    one_pass=True,
)

CHANNEL_GAME = Mart(
    "today_channel_game_record_statistic",
    "dwd_game_record",
    by("statistic_time", "channel_id"),
    _BETS,
    _USERS,
    one_pass=True,
)

# The declared key of the user mart omits the channel it is grouped by; the
# channel is kept in the key so that two channels do not overwrite each other.
USER_CUSTOM_AMOUNT = Mart(
    "today_user_custom_amount_statistics_data",
    "dwd_amount_operation_record",
    by("user_id", "channel_id", "statistic_time"),
    (*m.wallet_change_pack(), m.FIRST_CREATED, m.LAST_UPDATED),
)

CHANNEL_CUSTOM_AMOUNT = Mart(
    "today_channel_custom_amount_statistic",
    "dwd_amount_operation_record",
    by("channel_id", "statistic_time"),
    m.wallet_change_pack(),
    _USERS,
)

_WITHDRAW_DIMS = {
    "pay_category_id": "apply_bank_id",
    "pay_method_id": "withdrawal_mode_id",
    "pay_channel_id": "withdrawal_channel_id",
    "pay_provider_id": "pay_provider_id",
}

USER_WITHDRAW = Mart(
    "today_user_withdraw_statistic_dws",
    "dwd_withdraw_order",
    by("statistic_time", "user_id", "channel_id", **_WITHDRAW_DIMS),
    m.user_withdraw_pack(),
    m.user_withdraw_distincts(),
)


def channel_withdraw(*, strict_first: bool = False) -> Mart:
    return Mart(
        "today_channel_withdraw_statistic",
        "dwd_withdraw_order",
        by("statistic_time", "channel_id"),
        m.channel_withdraw_pack(),
        m.channel_withdraw_distincts(strict_first=strict_first),
    )


CHANNEL_WITHDRAW = channel_withdraw()

USER_RECHARGE = Mart(
    "today_user_recharge_statistic_dws",
    "dwd_recharge_order",
    by(
        "statistic_time", "user_id", "channel_id",
        "pay_category_id", "pay_method_id", "pay_channel_id", "pay_provider_id",
    ),
    m.user_recharge_pack(),
    derived=(("abs_id", "-1", "bigint"), ("recharge_user_count", "1", "int")),
)

CHANNEL_RECHARGE = Mart(
    "today_channel_recharge_statistic",
    "dwd_recharge_order",
    by("channel_id", "statistic_time"),
    m.channel_recharge_pack(),
    m.channel_recharge_distincts(),
)

CHANNEL_PROXY = Mart(
    "today_channel_proxy_statistic",
    "dwd_user_proxy_statistic",
    by("channel_id", "statistic_time"),
    m.proxy_pack(),
)

USER_REWARD = Mart(
    "today_user_reward_statistics_dws",
    "dwd_reward_record",
    by("statistic_time", "user_id", "channel_id", activity_type="COALESCE(activity_type, '')"),
    m.reward_pack(activity_counts=False),
    m.user_activity_distincts(),
    where=m.REWARD_FILTER,
    cells=m.REWARD_CELLS,
)

CHANNEL_REWARD = Mart(
    "today_channel_reward_statistic",
    "dwd_reward_record",
    by("statistic_time", "channel_id"),
    m.reward_pack(activity_counts=True),
    m.channel_reward_distincts(),
    where=m.REWARD_FILTER,
    cells=m.REWARD_CELLS,
)

CHANNEL_ACTIVITY = Mart(
    "today_channel_activity_statistic",
    "dwd_reward_record",
    by("statistic_time", "channel_id", "activity_type"),
    m.channel_activity_pack(),
    m.channel_activity_distincts(),
    where="update_time IS NOT NULL AND activity_type IS NOT NULL AND reward_scope = 'ACTIVITY_REWARD'",
)

MARTS = {
    mart.name: mart
    for mart in (
        USER_GAME_DAY, USER_GAME_HOUR, CHANNEL_GAME_CATEGORY, CHANNEL_GAME_PROVIDER, CHANNEL_GAME,
        USER_CUSTOM_AMOUNT, CHANNEL_CUSTOM_AMOUNT,
        USER_WITHDRAW, CHANNEL_WITHDRAW,
        USER_RECHARGE, CHANNEL_RECHARGE,
        CHANNEL_PROXY,
        USER_REWARD, CHANNEL_REWARD, CHANNEL_ACTIVITY,
    )
}

FINANCE_INCREMENT = "today_user_withdraw_statistic_finance_increment"
_FINANCE_MEASURES = (
    m.total("withdraw_amount", "payment_amount * order_rows"),
    m.total("success_withdraw_amount", "completed_amount"),
    m.total("withdraw_success_order_count", "completed_rows", "bigint"),
    m.Measure("create_time", "max", "order_update_time", "timestamp_ntz"),
    m.Measure("update_time", "max", "order_update_time", "timestamp_ntz"),
)
_FINANCE_DISTINCTS = (
    m.Distinct("user_count", "user_id"),
    m.Distinct("withdraw_order_count", "payment_order_no"),
)
FINANCE_KEYS = (
    "statistic_time", "user_id", "channel_id",
    "pay_category_id", "pay_method_id", "pay_channel_id", "pay_provider_id",
)


def finance_increment(orders: DataFrame, payments: DataFrame) -> DataFrame:
    """Withdrawals matched to their payment attempts of the same day.

    Every attempt repeats the order amount, as in the published mart.  The order
    side is folded to one row per order, day and payer before the join (row
    count, completed amount, completed rows), so repeated order rows multiply a
    number instead of emitting pairs; the join output is linear in the attempts.
    """
    folded = orders.groupBy(
        "order_no",
        "statistic_time",
        "user_id",
        "channel_id",
        F.col("apply_bank_id").alias("pay_category_id"),
        F.col("withdrawal_mode_id").alias("pay_method_id"),
    ).agg(
        F.count(F.lit(1)).alias("order_rows"),
        F.expr(f"sum(IF({m.DONE}, withdraw_funds_amount, 0))").alias("completed_amount"),
        F.expr(f"count(IF({m.DONE}, 1, NULL))").alias("completed_rows"),
        F.max("update_time").alias("order_update_time"),
    )
    attempts = payments.where("order_status IN ('COMPLETED', 'WITHDRAW_FAIL')").select(
        F.col("withdraw_order_no").alias("order_no"),
        F.to_date("update_time").alias("statistic_time"),
        F.expr("COALESCE(withdrawal_channel_id, 0)").alias("pay_channel_id"),
        F.expr("COALESCE(pay_provider_id, 0)").alias("pay_provider_id"),
        F.expr("try_cast(amount AS DECIMAL(20,4))").alias("payment_amount"),
        "payment_order_no",
    )
    matched = folded.join(attempts, ["order_no", "statistic_time"])
    # one pass: the join must not run once more for the distinct payments
    grouped = aggregate_once(
        matched, by(*FINANCE_KEYS), _FINANCE_MEASURES, (_FINANCE_DISTINCTS[1],)
    )
    # the user is a grouping key, so its distinct count is 1 (0 when it is NULL)
    users = F.when(F.col("user_id").isNotNull(), 1).otherwise(0).cast("bigint")
    return grouped.withColumn("user_count", users).select(*(n for n, _ in FINANCE_FIELDS))


FINANCE_FIELDS = [
    ("statistic_time", "date"),
    *((k, "bigint") for k in FINANCE_KEYS[1:]),
    *((x.name, x.type) for x in (*_FINANCE_DISTINCTS, *_FINANCE_MEASURES)),
]


def game_marts(cleaned: DataFrame) -> dict[str, DataFrame]:
    """The channel marts as roll-ups of one shared user-level aggregate.

    Running all bet marts from the raw rows scans and shuffles them once per
    mart.  Here the raw rows are reduced once, to day, hour, user, channel, game,
    category and provider, and every coarser mart adds up that smaller table.
    The caller persists or writes the base when several marts are materialised.
    """
    keys = by(
        "statistic_time", "statistic_hour", "user_id", "channel_id", "game_id",
        "game_category_id", "third_platform_provider_type",
    )
    flagged = m.Measure("flagged_bet_count", "sum", "IF(effective_bet_flag = 1, 1, 0)", "bigint")
    base = aggregate(cleaned, keys, (*_BETS, m.PROFIT_AND_LOSS, flagged))

    def again(mart: Mart) -> DataFrame:
        flag = "flagged_bet_count" if mart is USER_GAME_DAY else "effective_bet_count"
        added = tuple(
            m.Measure(x.name, "sum", flag if x.name == "effective_bet_count" else x.name, x.type)
            for x in mart.measures
        )
        # one pass, in case the base is not materialised
        total = aggregate_once if mart.distincts else aggregate
        return mart.finish(total(base, mart.keys, added, mart.distincts))

    marts = (USER_GAME_DAY, USER_GAME_HOUR, CHANNEL_GAME_CATEGORY, CHANNEL_GAME_PROVIDER, CHANNEL_GAME)
    return {"base": base, **{mart.name: again(mart) for mart in marts}}


# --- withdrawals and payments as a join kept up from changes ---------------------------

MATCH = ("order_no", "statistic_time")


def matched_order(orders: DataFrame) -> DataFrame:
    """The order side of the join: what the finance mart reads of a cleaned withdrawal."""
    return _picked(orders, (
        "order_no", "statistic_time", "user_id", "channel_id", "apply_bank_id AS pay_category_id",
        "withdrawal_mode_id AS pay_method_id", "order_status", "withdraw_funds_amount", "update_time AS order_update_time",
    ))


def matched_payment(payments: DataFrame) -> DataFrame:
    """The payment side: attempts that ended, by order number and day."""
    return _picked(payments.where("order_status IN ('COMPLETED', 'WITHDRAW_FAIL')"), (
        "withdraw_order_no AS order_no", "CAST(update_time AS DATE) AS statistic_time",
        "COALESCE(withdrawal_channel_id, 0) AS pay_channel_id", "COALESCE(pay_provider_id, 0) AS pay_provider_id",
        "try_cast(amount AS DECIMAL(20,4)) AS payment_amount", "payment_order_no",
    ))


def _picked(rows: DataFrame, exprs: tuple[str, ...]) -> DataFrame:
    """The expressions, behind the change columns of signed rows."""
    return rows.selectExpr(*(c for c in ("op", "pos", "sign") if c in rows.columns), *exprs)


#: The finance mart over matched pairs; the same rows as ``finance_increment``.
FINANCE_PAIRS = Mart(
    FINANCE_INCREMENT,
    "matched",
    by(*FINANCE_KEYS),
    (
        m.total("withdraw_amount", "payment_amount"),
        m.total("success_withdraw_amount", f"IF({m.DONE}, withdraw_funds_amount, 0)"),
        m.total("withdraw_success_order_count", f"IF({m.DONE}, 1, 0)", "bigint"),
        m.Measure("create_time", "max", "order_update_time", "timestamp_ntz"),
        m.Measure("update_time", "max", "order_update_time", "timestamp_ntz"),
    ),
    _FINANCE_DISTINCTS,
)
