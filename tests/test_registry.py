from __future__ import annotations

import pytest

from rillmart.fixtures.tables import load
from rillmart.plans import dwd
from rillmart.plans.registry import JOBS, run


def test_all_jobs_are_registered_once():
    counts = {}
    for job in JOBS.values():
        counts[job.layer] = counts.get(job.layer, 0) + 1
    assert counts == {"ods": 6, "dim": 7, "dwd": 7, "dws": 18, "ads": 6}


def test_jobs_run_by_name_and_chain(spark, small):
    cleaned = run("dwd_game_record", {"game_record": load(spark, small, "game_record")})
    day = run("today_user_game_statistics_dws", {"dwd_game_record": cleaned})
    total = run("user_game_statistic", {"today_user_game_statistics_dws": day})
    assert total.count() == total.select("user_id", "channel_id").distinct().count() > 0


def test_published_keys_are_unique(spark, small):
    cleaned = dwd.recharge_order(load(spark, small, "recharge_order"))
    for name in ("today_user_recharge_statistic_dws", "today_channel_recharge_statistic"):
        job = JOBS[name]
        built = run(name, {"dwd_recharge_order": cleaned})
        assert built.count() == built.select(*job.key).distinct().count()


def test_missing_input_is_named():
    with pytest.raises(KeyError, match="dwd_game_record"):
        run("today_user_game_statistics_dws", {})
