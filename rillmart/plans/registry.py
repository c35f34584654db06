"""All jobs by the name of the table or topic they fill."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame

from rillmart import schemas
from rillmart.plans import ads, dim, dwd, dws, ods


@dataclass(frozen=True)
class Job:
    """One published table: its layer, key, inputs and the plan over them.

    Change inputs of the raw and dimension layers are envelope and upsert frames;
    the other layers read current rows.
    """

    name: str
    layer: str
    key: tuple[str, ...]
    inputs: tuple[str, ...]
    build: Callable[..., DataFrame]

    def run(self, tables: Mapping[str, DataFrame]) -> DataFrame:
        missing = [name for name in self.inputs if name not in tables]
        if missing:
            raise KeyError(f"{self.name} needs {', '.join(missing)}")
        return self.build(*(tables[name] for name in self.inputs))


def _topic(topic: ods.Topic) -> Job:
    key = tuple(schemas.KEYS[topic.table]["entity"])
    return Job(topic.name, "ods", key, (f"{topic.table}_changes",), lambda changes: ods.messages(topic, changes))


def _dimension(table: str) -> Job:
    key = tuple(schemas.KEYS[table]["sink"])
    return Job(
        table, "dim", key, (table, f"{table}_changes"), lambda rows, changes: dim.dimension(table, rows, changes)
    )


def _cleaner(name: str) -> Job:
    source, rule = dwd.CLEANERS[name]
    if name == "user_online_status_record":
        rule = dwd.user_online_status  # the only cleaner that lands in a keyed table
    key = {
        "dwd_amount_operation_record": ("id", "update_time"),
        "dwd_user_proxy_statistic": ("id", "update_time"),
        "dwd_reward_record": ("unique_id", "update_time"),
        "user_online_status_record": ("user_id", "create_time"),
    }.get(name, ("order_no", "update_time"))
    return Job(name, "dwd", key, (source,), rule)


def _mart(mart, layer: str) -> Job:
    return Job(mart.name, layer, tuple(mart.keys), (mart.source,), mart.build)


def _bounty(name: str, by_day: bool) -> Job:
    key = ("user_id", "channel_id") + (("statistic_time",) if by_day else ())
    return Job(name, "ads", key, ("bounty_event",), lambda events: ads.user_bounty(events, by_day=by_day))


_ALL = (
    *(_topic(t) for t in ods.TOPICS.values()),
    *(_dimension(t) for t in dim.DIMENSIONS),
    *(_cleaner(n) for n in dwd.CLEANERS),
    Job("game_record", "dws", ("order_no", "create_time"), ("game_record_images",), dim.game_record_landing),
    Job(
        "reward_record", "dws", ("user_id", "unique_id", "create_time"), ("dwd_reward_record",),
        dim.reward_record_landing,
    ),
    *(_mart(m, "dws") for m in dws.MARTS.values()),
    Job(
        dws.FINANCE_INCREMENT, "dws", dws.FINANCE_KEYS,
        ("dwd_withdraw_order", "third_withdraw_payment_order"), dws.finance_increment,
    ),
    *(_mart(m, "ads") for m in ads.MARTS.values()),
    _bounty(ads.USER_BOUNTY_DAY, True),
    _bounty(ads.USER_BOUNTY_TOTAL, False),
)

JOBS: dict[str, Job] = {job.name: job for job in _ALL}


def run(name: str, tables: Mapping[str, DataFrame]) -> DataFrame:
    """The result of a job over named input frames."""
    return JOBS[name].run(tables)
