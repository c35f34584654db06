"""Declared column lists of every source table, event payload and cleaned table.

Each table is one DDL text in declaration order.  ``fields`` turns it into
``(name, type)`` pairs and ``row_struct`` into the nested type used when the
row travels inside a JSON envelope.  All wall-clock columns are
``timestamp_ntz`` so that the event day never depends on the session zone.
"""

from __future__ import annotations

import re

_FIELD = re.compile(r"(\w+)\s+(\w+(?:\(\s*\d+\s*,\s*\d+\s*\))?)\s*(?:,|$)")


def fields(ddl: str) -> list[tuple[str, str]]:
    """``(column, type)`` pairs of a flat DDL text, in order."""
    return [(name, kind.replace(" ", "")) for name, kind in _FIELD.findall(ddl)]


def names(ddl: str) -> list[str]:
    return [name for name, _ in fields(ddl)]


def row_struct(ddl: str) -> str:
    return "struct<" + ", ".join(f"`{n}`: {t}" for n, t in fields(ddl)) + ">"


# --- Fixed values: column names and types of the source tables ---------------

GAME_RECORD = """
id bigint, user_id bigint, game_id bigint, game_category_id bigint,
bet_amount decimal(19,2), settle_amount decimal(19,2), transfer_amount decimal(19,2),
bet_deposit_amount decimal(19,2), bet_withdrawal_amount decimal(19,2), bet_bonus_amount decimal(19,2),
effective_bet_flag tinyint,
settle_deposit_amount decimal(19,2), settle_withdrawal_amount decimal(19,2), settle_bonus_amount decimal(19,2),
transfer_deposit_amount decimal(19,2), transfer_withdrawal_amount decimal(19,2), transfer_bonus_amount decimal(19,2),
third_platform_provider_type string, bet_time timestamp_ntz, settle_time timestamp_ntz,
status string, bet_no string, create_time timestamp_ntz, update_time timestamp_ntz,
game_name_code string, order_no bigint, channel_id bigint, game_record_expand_list string,
valid_bet_amount decimal(19,2), valid_bet_deposit_amount decimal(19,2),
valid_bet_withdrawal_amount decimal(19,2), valid_bet_bonus_amount decimal(19,2),
third_provider_game_code string, parent_game_category_id bigint, third_provider_game_type bigint
"""

RECHARGE_ORDER = """
id bigint, order_no bigint, user_id bigint, currency_code string,
rate_scale decimal(20,4), order_amount decimal(20,4), pay_amount decimal(20,4),
decrease_handling_fee decimal(20,4), handling_fee decimal(20,4), gift_amount decimal(20,4),
recharge_amount decimal(20,4), actual_handling_fee decimal(20,4),
actual_decrease_handling_fee decimal(20,4), actual_gift_amount decimal(20,4),
actual_recharge_amount decimal(20,4), pay_status string, order_status string, first_recharge tinyint,
pay_method_id bigint, pay_category_id bigint, pay_channel_id bigint, pay_provider_id bigint,
recharge_success_time timestamp_ntz, create_time timestamp_ntz, update_time timestamp_ntz,
update_by string, channel_id bigint
"""

WITHDRAW_ORDER = """
id bigint, order_no bigint, user_id bigint, channel_id bigint, channel string,
withdraw_funds_amount decimal(20,4), balance decimal(20,4), withdrawal_amount decimal(20,4),
projected_amount decimal(20,4), platform_handling_fee decimal(20,4), final_handling_fee decimal(20,4),
final_withdraw_funds_amount decimal(20,4), actual_amount decimal(20,4),
handling_type string, handling_mode string, handling_detail string,
gift_mode string, gift_value decimal(20,4), gift_amount decimal(20,4),
decrease_handling_mode string, decrease_handling_value decimal(20,4), decrease_handling_amount decimal(20,4),
apply_ip string, user_bank_id bigint, apply_name string, apply_bank_name string, apply_bank_id bigint,
apply_bank_card string, apply_email string, apply_phone string,
order_status string, order_status_event string, remark string, reasons string,
front_remarks string, back_remarks string, pay_provider_id bigint,
withdrawal_mode_id bigint, withdrawal_mode_name string,
withdrawal_channel_id bigint, withdrawal_channel_name string, withdrawal_channel_bank_code string,
pay_provider_type string, payment_order_no string, third_party_order_no string,
third_party_handling_fee decimal(20,4), payments_number int, first_withdrawal_flag tinyint,
create_by bigint, create_time timestamp_ntz, update_by bigint, update_time timestamp_ntz,
request_time timestamp_ntz, fallback_time timestamp_ntz, payout_successful_time timestamp_ntz,
locked_user_id bigint, last_audit_user bigint, last_audit_time timestamp_ntz
"""

THIRD_WITHDRAW_PAYMENT_ORDER = """
id bigint, withdraw_order_no bigint, payments_number int, payment_order_no string,
amount string, actual_amount string, apply_name string, apply_bank_card string,
apply_email string, apply_phone string, pay_provider_type string, third_party_order_no string,
third_party_handling_fee string, withdrawal_channel_id bigint, withdrawal_channel_bank_code string,
status string, trade_status string, notify_url string, request_param string, response_param string,
create_time timestamp_ntz, update_time timestamp_ntz, pay_provider_id bigint,
withdrawal_channel_name string, order_status string, status_reason string
"""

USER_PROXY_STATISTIC = """
id bigint, user_id bigint, channel_id bigint, statistic_time date,
direct_bet_rebate_amount decimal(20,4), direct_recharge_rebate_amount decimal(20,4),
teams_bet_rebate_amount decimal(20,4), teams_recharge_rebate_amount decimal(20,4),
team_size int, direct_member int, valid_direct_member int,
transfer_amount decimal(20,4), transfer_count int,
invitation_amount decimal(20,4), achievement_amount decimal(20,4), rebate_settlement decimal(20,4),
betting_rebate_count int, recharge_rebate_count int,
effective_bet_amount decimal(20,4), team_effective_bet_amount decimal(20,4),
direct_effective_bet_amount decimal(20,4), teams_rebate_amount decimal(20,4),
obtain_betting_rebate_count int, obtain_recharge_rebate_count int,
create_time timestamp_ntz, update_time timestamp_ntz
"""

AMOUNT_OPERATION_RECORD = """
id bigint, user_id bigint, user_phone string, user_email string, nick_name string,
type string, receive_type string, amount_type string, reward_title string,
amount decimal(19,4), flow_amount decimal(19,4), balance decimal(19,4),
withdraw_balance decimal(19,4), deposit_balance decimal(19,4), bonus_balance decimal(19,4),
bonus_balance_expire_time timestamp_ntz, flow_balance decimal(19,4),
deposit_flow_balance decimal(19,4), bonus_flow_balance decimal(19,4),
status string, remark string, create_by string, update_by string,
create_time timestamp_ntz, update_time timestamp_ntz, channel_id bigint,
auditor string, audit_remark string, audit_time timestamp_ntz, import_id bigint, show_flag tinyint
"""

USER = """
id bigint, user_id bigint, user_phone string, password string, register_ip string,
register_device_id string, user_country string, user_status int, register_time timestamp_ntz,
update_time timestamp_ntz, user_email string, phone_area_code string, freeze_time timestamp_ntz,
test_flag int, app_channel string, register_source_value string, register_source_type string,
abs_id bigint, channel_id bigint, register_method string, last_login_ip string,
last_login_time timestamp_ntz, last_login_device_id string, user_type int,
tourist_name string, tourist_must_bind_user int
"""

USER_INFO = """
id bigint, user_id bigint, nick_name string, user_avatar string, user_gender int, user_age int,
vip_level int, user_education string, user_brief string, user_date_birth string,
user_location string, user_current_ip string, remark string,
create_time timestamp_ntz, update_time timestamp_ntz, invite_code string, email_checked int,
update_nick_name_time date, update_nick_name_num int, update_sign_num int, update_sign_time date,
current_level_recharge_amount decimal(20,4), current_level_effective_bet decimal(20,4),
hidden_score int, second_return int, signature string, channel_id bigint, real_name string,
bounty_arena_disabled_flag int, game_valid_bet_calculate_id bigint
"""

USER_RELATIONS = """
id bigint, distance int, ancestor_user_id bigint, ancestor_channel_id bigint,
descendant_user_id bigint, descendant_channel_id bigint, invite_Code string,
recharge_rebate_amount decimal(20,4), bet_rebate_amount decimal(20,4), rebate_amount decimal(20,4),
effective_time timestamp_ntz, betting_rebate_count int, recharge_rebate_count int,
create_time timestamp_ntz, update_time timestamp_ntz
"""

USER_CASH_ACCOUNT = """
id bigint, user_id bigint, currency_type string,
freeze_deposit_amount decimal(19,4), freeze_withdrawal_amount decimal(19,4), account_status string,
first_recharge_time timestamp_ntz, last_recharge_time timestamp_ntz,
first_withdrawal_time timestamp_ntz, last_withdrawal_time timestamp_ntz, withdraw_flag tinyint,
deposit_amount decimal(19,4), withdrawal_amount decimal(19,4), total_recharge_amount decimal(19,4),
total_bet_amount decimal(19,4), total_withdrawal_amount decimal(19,4),
first_recharge_amount decimal(19,4), first_withdrawal_amount decimal(19,4),
bonus_amount decimal(19,4), freeze_bonus_amount decimal(19,4), bonus_amount_expire_time timestamp_ntz,
deposit_flow_target_amount decimal(19,4), deposit_flow_amount decimal(19,4),
bonus_flow_target_amount decimal(19,4), bonus_flow_amount decimal(19,4),
recharge_count int, withdrawal_count int,
create_time timestamp_ntz, update_time timestamp_ntz, channel_id bigint
"""

USER_GLOBAL_CURRENCY_ACCOUNT = """
id bigint, channel_id bigint, user_id bigint, global_currency_num decimal(10,0),
create_time timestamp_ntz, update_time timestamp_ntz, version bigint, global_currency_status string
"""

USER_PROXY_ACCOUNT = """
id bigint, user_id bigint, channel_id bigint, account_status string,
extracted_amount decimal(20,4), withdrawal_amount decimal(20,4), pending_settlement_amount decimal(20,4),
user_proxy_level bigint, total_user_proxy_effective_bet_amount decimal(20,4),
total_transfer_amount decimal(20,4), total_effective_bet_amount decimal(20,4),
total_team_effective_bet_amount decimal(20,4), total_direct_effective_bet_amount decimal(20,4),
total_direct_bet_rebate_amount decimal(20,4), total_direct_recharge_rebate_amount decimal(20,4),
total_teams_bet_rebate_amount decimal(20,4), total_teams_recharge_rebate_amount decimal(20,4),
transfer_count bigint, betting_rebate_count bigint, recharge_rebate_count bigint,
total_user_invitations_amount decimal(20,4), total_user_achievement_amount decimal(20,4),
affiliation bigint, agent_activation_time timestamp_ntz, version bigint,
create_time timestamp_ntz, update_time timestamp_ntz
"""

DEVICE_USERS_RELATIONS_FLAT = "user_id bigint, device_id string"

# --- Fixed values: payloads of the enveloped JSON events ---------------------

REWARD_EVENT = """
id bigint, user_id bigint, channel_id bigint, unique_id bigint,
reward_scope string, reward_type string, activity_type string,
bonus_amount decimal(20,4), draw_flag boolean,
not_receive_time timestamp_ntz, receive_time timestamp_ntz, time_out_time timestamp_ntz,
create_time timestamp_ntz, update_time timestamp_ntz
"""

ONLINE_EVENT = """
user_id bigint, ip string, device_id string, online_time string, create_time string,
token string, session_id string
"""

BOUNTY_EVENT = """
id bigint, user_id bigint, channel_id bigint, bounty_order_no string,
bet_amount decimal(20,4), settle_amount decimal(20,4), win_loss_amount decimal(20,4),
punish_amount decimal(20,4), pumped_amount decimal(20,4), profit_loss_amount decimal(20,4),
bet_deposit_amount decimal(20,4), bet_withdrawal_amount decimal(20,4), bet_bonus_amount decimal(20,4),
settle_deposit_amount decimal(20,4), settle_withdrawal_amount decimal(20,4), settle_bonus_amount decimal(20,4),
create_time timestamp_ntz, update_time timestamp_ntz
"""

# --- Fixed values: column names and types of the cleaned tables --------------

DWD_GAME_RECORD = """
statistic_time date, statistic_hour bigint, user_id bigint, channel_id bigint, game_id bigint,
game_category_id bigint, third_platform_provider_type string, id bigint, order_no bigint,
bet_amount decimal(19,2), settle_amount decimal(19,2), transfer_amount decimal(19,2),
bet_deposit_amount decimal(19,2), bet_withdrawal_amount decimal(19,2), bet_bonus_amount decimal(19,2),
effective_bet_flag tinyint,
settle_deposit_amount decimal(19,2), settle_withdrawal_amount decimal(19,2), settle_bonus_amount decimal(19,2),
transfer_deposit_amount decimal(19,2), transfer_withdrawal_amount decimal(19,2), transfer_bonus_amount decimal(19,2),
valid_bet_amount decimal(19,2), valid_bet_deposit_amount decimal(19,2),
valid_bet_withdrawal_amount decimal(19,2), valid_bet_bonus_amount decimal(19,2),
status string, update_time timestamp_ntz
"""

DWD_RECHARGE_ORDER = """
statistic_time date, user_id bigint, channel_id bigint,
pay_category_id bigint, pay_method_id bigint, pay_channel_id bigint, pay_provider_id bigint,
id bigint, order_no bigint, currency_code string,
rate_scale decimal(20,4), order_amount decimal(20,4), pay_amount decimal(20,4),
decrease_handling_fee decimal(20,4), handling_fee decimal(20,4), gift_amount decimal(20,4),
recharge_amount decimal(20,4), actual_handling_fee decimal(20,4),
actual_decrease_handling_fee decimal(20,4), actual_gift_amount decimal(20,4),
actual_recharge_amount decimal(20,4), first_recharge tinyint, pay_status string, order_status string,
recharge_success_time timestamp_ntz, create_time timestamp_ntz, update_time timestamp_ntz
"""

DWD_WITHDRAW_ORDER = """
statistic_time date, user_id bigint, channel_id bigint, apply_bank_id bigint,
withdrawal_mode_id bigint, withdrawal_channel_id bigint, pay_provider_id bigint,
id bigint, order_no bigint, withdraw_funds_amount decimal(20,4), final_handling_fee decimal(20,4),
gift_amount decimal(20,4), decrease_handling_amount decimal(20,4), first_withdrawal_flag tinyint,
order_status string, create_time timestamp_ntz, update_time timestamp_ntz
"""

DWD_AMOUNT_OPERATION_RECORD = """
statistic_time date, user_id bigint, channel_id bigint, id bigint, type string, amount_type string,
amount decimal(19,4), balance decimal(19,4), status string,
create_time timestamp_ntz, update_time timestamp_ntz
"""

DWD_USER_PROXY_STATISTIC = """
statistic_time date, user_id bigint, channel_id bigint, id bigint,
direct_bet_rebate_amount decimal(20,4), direct_recharge_rebate_amount decimal(20,4),
teams_bet_rebate_amount decimal(20,4), teams_recharge_rebate_amount decimal(20,4),
team_size int, direct_member int, valid_direct_member int,
transfer_amount decimal(20,4), transfer_count int,
invitation_amount decimal(20,4), achievement_amount decimal(20,4), rebate_settlement decimal(20,4),
betting_rebate_count int, recharge_rebate_count int,
effective_bet_amount decimal(20,4), team_effective_bet_amount decimal(20,4),
direct_effective_bet_amount decimal(20,4), teams_rebate_amount decimal(20,4),
obtain_betting_rebate_count int, obtain_recharge_rebate_count int,
create_time timestamp_ntz, update_time timestamp_ntz
"""

DWD_REWARD_RECORD = """
statistic_time date, user_id bigint, channel_id bigint, unique_id bigint,
reward_scope string, reward_type string, activity_type string,
id bigint, bonus_amount decimal(20,4), draw_flag int,
not_receive_time timestamp_ntz, receive_time timestamp_ntz, time_out_time timestamp_ntz,
create_time timestamp_ntz, update_time timestamp_ntz
"""

USER_ONLINE_STATUS_RECORD = """
session_id string, user_id bigint, token string, online_time timestamp_ntz,
ip string, device_id string, create_time timestamp_ntz
"""

# --- Fixed values: columns published by the narrow change topic and landings --

AMOUNT_OPERATION_TOPIC = """
id bigint, user_id bigint, type string, amount_type string, amount decimal(19,4), balance decimal(19,4),
status string, create_by string, update_by string,
create_time timestamp_ntz, update_time timestamp_ntz, channel_id bigint
"""

REWARD_RECORD_LANDING = """
id bigint, user_id bigint, channel_id bigint, unique_id bigint,
reward_scope string, reward_type string, activity_type string,
bonus_amount decimal(20,4), draw_flag int,
not_receive_time timestamp_ntz, receive_time timestamp_ntz, time_out_time timestamp_ntz,
create_time timestamp_ntz, update_time timestamp_ntz
"""


def _game_landing() -> str:
    """Bet landing table: the source columns without the opaque list, money widened."""
    widened = (
        (name, "decimal(20,4)" if kind == "decimal(19,2)" else kind)
        for name, kind in fields(GAME_RECORD)
        if name != "game_record_expand_list"
    )
    return ", ".join(f"{name} {kind}" for name, kind in widened)


GAME_RECORD_LANDING = _game_landing()

# --- Fixed values: key columns ----------------------------------------------
# ``entity`` names the row that versions belong to (used for compaction);
# ``sink`` names the declared key of the published table.

KEYS = {
    "game_record": {"entity": ["id"], "sink": ["order_no", "create_time"]},
    "recharge_order": {"entity": ["id"], "sink": ["order_no", "create_time"]},
    "withdraw_order": {"entity": ["id"], "sink": ["order_no", "create_time"]},
    "third_withdraw_payment_order": {"entity": ["id"], "sink": ["id"]},
    "user_proxy_statistic": {"entity": ["id"], "sink": ["id"]},
    "amount_operation_record": {"entity": ["id"], "sink": ["id"]},
    "reward_record": {"entity": ["id"], "sink": ["user_id", "unique_id", "create_time"]},
    "user": {"entity": ["user_id", "register_time"], "sink": ["user_id", "register_time"]},
    "user_info": {"entity": ["id"], "sink": ["id"]},
    "user_relations": {"entity": ["id", "create_time"], "sink": ["id", "create_time"]},
    "user_cash_account": {"entity": ["id"], "sink": ["id"]},
    "user_global_currency_account": {"entity": ["id"], "sink": ["id"]},
    "user_proxy_account": {"entity": ["id"], "sink": ["id", "create_time"]},
    "user_online_status_record": {"entity": ["user_id", "create_time"], "sink": ["user_id", "create_time"]},
}

TABLES = {
    "game_record": GAME_RECORD,
    "recharge_order": RECHARGE_ORDER,
    "withdraw_order": WITHDRAW_ORDER,
    "third_withdraw_payment_order": THIRD_WITHDRAW_PAYMENT_ORDER,
    "user_proxy_statistic": USER_PROXY_STATISTIC,
    "amount_operation_record": AMOUNT_OPERATION_RECORD,
    "user": USER,
    "user_info": USER_INFO,
    "user_relations": USER_RELATIONS,
    "user_cash_account": USER_CASH_ACCOUNT,
    "user_global_currency_account": USER_GLOBAL_CURRENCY_ACCOUNT,
    "user_proxy_account": USER_PROXY_ACCOUNT,
    "reward_event": REWARD_EVENT,
    "online_event": ONLINE_EVENT,
    "bounty_event": BOUNTY_EVENT,
}

# Columns that hold credentials or personal contact data, by table.
SENSITIVE = {
    "user": ["password", "user_phone", "user_email"],
    "withdraw_order": ["apply_name", "apply_bank_card", "apply_email", "apply_phone"],
    "third_withdraw_payment_order": ["apply_name", "apply_bank_card", "apply_email", "apply_phone"],
    "amount_operation_record": ["user_phone", "user_email"],
    "user_info": ["real_name"],
}
