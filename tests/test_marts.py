"""Hand-made rows for the corner cases of cleaning and aggregation."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from rillmart import schemas
from rillmart.functions import measures as m
from rillmart.operators.aggregate import aggregate, aggregate_once
from rillmart.operators.mart import Mart, by
from rillmart.plans import ads, dwd, dws

T0 = dt.datetime(2024, 1, 1, 23, 59, 59)
T1 = dt.datetime(2024, 1, 2, 0, 0, 0)


def frame(spark, ddl, rows):
    """A frame of the declared columns from partial dicts; missing columns are NULL."""
    names = schemas.names(ddl)
    full = [tuple(r.get(n) for n in names) for r in rows]
    return spark.createDataFrame(full, ", ".join(f"`{n}` {t}" for n, t in schemas.fields(ddl)))


def rows_of(df):
    return [r.asDict() for r in df.collect()]


def bet(**over):
    row = dict(
        id=1, order_no=1, user_id=1, channel_id=1, game_id=1, game_category_id=1,
        third_platform_provider_type="A", status="settle", update_time=T0,
        bet_amount=D("10.00"), settle_amount=D("4.00"), transfer_amount=D("-6.00"),
        effective_bet_flag=1, valid_bet_amount=D("10.00"),
    )
    return {**row, **over}


def test_clean_keeps_settled_rows_with_order_and_time(spark):
    rows = [bet(), bet(status="SETTLE"), bet(status=None), bet(order_no=None), bet(update_time=None)]
    out = rows_of(dwd.game_record(frame(spark, schemas.GAME_RECORD, rows)))
    assert [(r["statistic_time"], r["statistic_hour"]) for r in out] == [(dt.date(2024, 1, 1), 23)]


def test_flag_variants_differ_on_missing_and_large_flags(spark):
    rows = frame(spark, schemas.GAME_RECORD, [bet(effective_bet_flag=f) for f in (1, 2, None)])
    cleaned = dwd.game_record(rows)
    user = rows_of(dws.USER_GAME_DAY.build(cleaned))[0]
    channel = rows_of(dws.CHANNEL_GAME.build(cleaned))[0]
    assert (user["effective_bet_count"], channel["effective_bet_count"]) == (1, 3)
    assert user["effective_bet_amount"] == channel["effective_bet_amount"] == D("10.0000")


def test_hour_mart_groups_by_its_key_and_binds_by_name(spark):
    rows = frame(spark, schemas.GAME_RECORD, [bet(), bet(game_category_id=2)])
    out = rows_of(dws.USER_GAME_HOUR.build(dwd.game_record(rows)))
    assert len(out) == 1
    assert (out[0]["profit_and_loss_amount"], out[0]["bet_amount"]) == (D("12.0000"), D("20.0000"))


def test_sum_of_missing_amounts_stays_missing(spark):
    out = rows_of(dws.CHANNEL_GAME.build(dwd.game_record(frame(spark, schemas.GAME_RECORD, [bet(bet_amount=None)]))))
    assert out[0]["bet_amount"] is None and out[0]["bet_bonus_amount"] is None


@pytest.mark.parametrize("stake,rate", [(D("10.00"), D("0.6000")), (D("0.00"), D("0.0000")), (None, None)])
def test_kill_rate(spark, stake, rate):
    cleaned = dwd.game_record(frame(spark, schemas.GAME_RECORD, [bet(bet_amount=stake)]))
    out = rows_of(ads.USER_GAME_DAY.build(dws.USER_GAME_DAY.build(cleaned)))
    assert out[0]["third_party_total_kill_rate"] == rate


def reward(**over):
    row = dict(
        id=1, user_id=1, channel_id=1, unique_id=1, reward_scope="ACTIVITY_REWARD", reward_type="WITHDRAW",
        activity_type="A", bonus_amount=D("5"), draw_flag=True, create_time=T0, update_time=T0,
    )
    return {**row, **over}


def test_reward_cells_equal_plain_sums(spark):
    """The pivoted measures equal the conditional sums they stand for, NULLs included."""
    variants = [
        reward(reward_scope=scope, reward_type=kind, draw_flag=draw, bonus_amount=amount, user_id=user)
        for scope in (*m.REWARD_SCOPES, "OTHER")
        for kind in (*m.REWARD_TYPES, "POINTS", None)
        for draw in (True, False, None)
        for amount in (D("1.5"), None)
        for user in (1, 2)
    ]
    only_missing = [reward(user_id=9, bonus_amount=None), reward(user_id=9, bonus_amount=None, unique_id=2)]
    cleaned = dwd.reward_record(frame(spark, schemas.REWARD_EVENT, variants + only_missing))
    for mart in (dws.USER_REWARD, dws.CHANNEL_REWARD):
        rows = mart.rows(cleaned)
        plain = aggregate(rows, mart.keys, mart.measures, mart.distincts)
        once = aggregate_once(rows, mart.keys, mart.measures, mart.distincts)
        celled = mart.build(cleaned)
        names = celled.columns
        got = {str(r) for r in celled.collect()}
        assert got == {str(r) for r in plain.select(*names).collect()}
        assert got == {str(r) for r in once.select(*names).collect()}
    missing = [r for r in rows_of(dws.USER_REWARD.build(cleaned)) if r["user_id"] == 9][0]
    assert missing["activity_total_amount"] is None and missing["vip_draw_amount"] == D("0.0000")


def test_reward_names_with_missing_parts_are_not_counted(spark):
    rows = [reward(activity_type=None), reward(activity_type="", unique_id=2), reward(activity_type="A", unique_id=None)]
    out = {r["activity_type"]: r for r in rows_of(dws.USER_REWARD.build(dwd.reward_record(frame(spark, schemas.REWARD_EVENT, rows))))}
    assert (out[""]["activity_total_count"], out["A"]["activity_total_count"]) == (1, 0)


def test_missing_draw_flag_counts_as_open(spark):
    out = rows_of(dwd.reward_record(frame(spark, schemas.REWARD_EVENT, [reward(draw_flag=None)])))
    assert out[0]["draw_flag"] == 0


def test_scope_totals_are_drawn_plus_open(spark, small):
    from rillmart.fixtures.tables import load

    built = dws.CHANNEL_REWARD.build(dwd.reward_record(load(spark, small, "reward_event")))
    for stem, whole in m.REWARD_SCOPES.values():
        for wallet in ("withdrawal", "deposit", "bonus"):
            bad = built.where(
                f"{whole}_{wallet}_amount <> {stem}_draw_{wallet}_amount + {stem}_no_draw_{wallet}_amount"
            )
            assert bad.isEmpty()


def test_bonus_task_counts_as_reward_only_when_withdrawable(spark):
    rows = [
        reward(reward_scope="BONUS_TASK", reward_type="WITHDRAW"),
        reward(reward_scope="BONUS_TASK", reward_type="BONUS", unique_id=2),
        reward(reward_scope="VIP_REWARD", reward_type="BONUS", unique_id=3),
    ]
    out = rows_of(ads.USER_REWARD_TOTAL.build(dwd.reward_record(frame(spark, schemas.REWARD_EVENT, rows))))[0]
    assert (out["total_reward_amount"], out["total_reward_count"]) == (D("10.0000"), 3)


def test_proxy_row_with_one_missing_commission_is_not_counted(spark):
    row = dict(
        id=1, user_id=1, channel_id=1, statistic_time=T0.date(), update_time=T0,
        direct_bet_rebate_amount=D("1"), direct_recharge_rebate_amount=D("1"),
        teams_bet_rebate_amount=D("1"), teams_recharge_rebate_amount=D("1"),
        betting_rebate_count=0, recharge_rebate_count=2,
    )
    rows = [row, {**row, "teams_bet_rebate_amount": None}, {**row, "direct_bet_rebate_amount": D("-3")}]
    out = rows_of(dws.CHANNEL_PROXY.build(dwd.user_proxy_statistic(frame(spark, schemas.USER_PROXY_STATISTIC, rows))))[0]
    assert (out["commissions_number"], out["rebates_number"], out["betting_rebate_number"]) == (1, 3, 0)


def payment(**over):
    row = dict(
        id=1, withdraw_order_no=7, payment_order_no="p1", amount="5.5", order_status="COMPLETED",
        update_time=T0, withdrawal_channel_id=None, pay_provider_id=3,
    )
    return {**row, **over}


def withdrawal(**over):
    row = dict(
        id=1, order_no=7, user_id=1, channel_id=1, apply_bank_id=2, withdrawal_mode_id=None,
        withdraw_funds_amount=D("100"), order_status="COMPLETED", update_time=T0, create_time=T0,
    )
    return {**row, **over}


def test_finance_join_repeats_amounts_without_emitting_pairs(spark):
    orders = dwd.withdraw_order(
        frame(spark, schemas.WITHDRAW_ORDER, [withdrawal(), withdrawal(id=2, withdraw_funds_amount=D("50"))])
    )
    payments = frame(
        spark, schemas.THIRD_WITHDRAW_PAYMENT_ORDER,
        [payment(), payment(id=2, payment_order_no="p2", amount="abc"), payment(id=3, update_time=T1),
         payment(id=4, order_status="PROCESSING"), payment(id=5, withdraw_order_no=None)],
    )
    out = rows_of(dws.finance_increment(orders, payments))
    assert len(out) == 1
    got = out[0]
    assert got["withdraw_amount"] == D("11.0000")  # 5.5 for each of two order rows, 'abc' unreadable
    assert got["success_withdraw_amount"] == D("300.0000")  # two orders, two attempts each
    assert (got["withdraw_success_order_count"], got["withdraw_order_count"], got["user_count"]) == (4, 2, 1)
    assert (got["pay_channel_id"], got["pay_provider_id"], got["pay_method_id"]) == (0, 3, None)


def test_finance_join_is_linear_in_a_hot_order(spark):
    """Thousands of rows on both sides of one order: the join emits one row per attempt."""
    many = spark.range(3000)
    order, attempt = (frame(spark, ddl, [row]) for ddl, row in (
        (schemas.WITHDRAW_ORDER, withdrawal()), (schemas.THIRD_WITHDRAW_PAYMENT_ORDER, payment())))
    orders = dwd.withdraw_order(many.select().join(order.drop("id").withColumn("id", F.lit(1)), how="cross"))
    payments = many.selectExpr("CAST(id AS STRING) AS n").join(attempt, how="cross").withColumn("payment_order_no", F.col("n")).drop("n")
    got = rows_of(dws.finance_increment(orders, payments))[0]
    assert (got["withdraw_order_count"], got["withdraw_success_order_count"]) == (3000, 9_000_000)
    assert got["withdraw_amount"] == D("49500000.0000")  # 5.5 × 3000 × 3000
    assert got["success_withdraw_amount"] == D("900000000.0000")  # 100 × 3000 × 3000


def test_null_keys_form_one_group_with_their_distinct_counts(spark):
    df = spark.createDataFrame([(None, 1), (None, 1), (None, 2), (5, None)], "k bigint, u bigint")
    mart = Mart("t", "t", by("k"), (m.tally("n"),), (m.Distinct("users", "u"), m.Distinct("big", "u", "u > 1")))
    out = {r["k"]: (r["n"], r["users"], r["big"]) for r in rows_of(mart.build(df))}
    assert out == {None: (3, 2, 1), 5: (1, 0, 0)}


def test_hot_group_is_spread_over_tasks(spark):
    """The step that sees single values shuffles by key and value, never by key alone."""
    df = spark.range(1000).selectExpr("id % 1 AS k", "id * 7 AS u")
    mart = Mart("t", "t", by("k"), (m.tally("n"),), (m.Distinct("users", "u"),))
    plan = mart.build(df)._jdf.queryExecution().executedPlan().toString()
    first_level = [line for line in plan.split("\n") if "Exchange hashpartitioning" in line][-1]
    assert "_groupingexpression" in first_level and "u#" in first_level
    assert rows_of(mart.build(df))[0]["users"] == 1000


def test_marts_publish_their_declared_types(spark, small):
    from rillmart.fixtures.tables import load

    kinds = {"bigint": "bigint", "int": "int"}
    for mart in (*dws.MARTS.values(), ads.USER_REWARD_DAY, ads.USER_REWARD_TOTAL):
        source, rule = dwd.CLEANERS[mart.source]
        built = mart.build(rule(load(spark, small, source)))
        assert built.dtypes == [(n, kinds.get(t, t)) for n, t in mart.fields()], mart.name


def test_reward_packs_have_all_columns():
    assert len(dws.USER_REWARD.measures) + len(dws.USER_REWARD.distincts) == 67
    assert len(m.bet_pack(numeric_flag=True)) == 20
    assert len(m.wallet_change_pack()) == 10
    assert len(m.user_reward_pack()) == 12
    assert len(m.user_game_pack()) + 1 == 23
    assert len(m.bounty_columns()) == 35


def test_bounty_stub_is_empty_with_full_schema(spark, small):
    from rillmart.fixtures.tables import load

    out = ads.user_bounty(load(spark, small, "bounty_event"), by_day=True)
    assert out.count() == 0
    assert out.dtypes == [("statistic_time", "date"), ("user_id", "bigint"), ("channel_id", "bigint"), *(
        (n, t) for n, t in [(x.name, x.type) for x in [m.Measure(a, "sum", "0", b) for a, b in m.bounty_columns()]]
    )]


def test_first_withdrawal_variants(spark):
    rows = [withdrawal(first_withdrawal_flag=0), withdrawal(id=2, order_no=8, user_id=2, first_withdrawal_flag=1)]
    cleaned = dwd.withdraw_order(frame(spark, schemas.WITHDRAW_ORDER, rows))
    plain = rows_of(dws.CHANNEL_WITHDRAW.build(cleaned))[0]
    strict = rows_of(dws.channel_withdraw(strict_first=True).build(cleaned))[0]
    assert (plain["first_user_count"], strict["first_user_count"]) == (2, 1)


def test_conservation_across_grains(spark, small):
    from rillmart.fixtures.tables import load

    cleaned = dwd.game_record(load(spark, small, "game_record")).persist()
    additive = ["bet_count", "settle_count", "bet_amount", "win_lose_amount", "bet_deposit_amount"]
    sums = [F.sum(c).cast("decimal(30,4)").alias(c) for c in additive]

    def totals(mart):
        return sorted(map(str, mart.build(cleaned).groupBy("statistic_time", "channel_id").agg(*sums).collect()))

    base = totals(dws.CHANNEL_GAME)
    for mart in (dws.CHANNEL_GAME_CATEGORY, dws.CHANNEL_GAME_PROVIDER, dws.USER_GAME_DAY):
        assert totals(mart) == base
    cleaned.unpersist()
