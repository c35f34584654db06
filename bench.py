"""Benchmark: seconds per headline query, one JSON line on stdout.

Reads ``BENCH_SF_DIR`` (default /root/testdata/sf0.1) on ``local[BENCH_CPUS]``.
Every query is materialised in full through the no-op sink, so nothing is pruned
away and no result passes through the driver.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from rillmart import config  # noqa: E402
from rillmart.fixtures.queries import QUERIES  # noqa: E402

HEADLINE = (
    "dwd_game_record",
    "dws_user_game_day",
    "dws_user_game_hour",
    "dws_channel_game_category",
    "dws_channel_game_provider",
    "dws_channel_game",
    "dws_user_custom_amount",
    "dws_channel_custom_amount",
    "dws_user_withdraw",
    "dws_channel_withdraw",
    "dws_finance_increment",
    "dws_user_recharge",
    "dws_channel_recharge",
    "dws_channel_proxy",
    "dws_user_reward",
    "dws_channel_reward",
    "dws_channel_activity",
    "ads_user_game_day",
    "ads_user_game_total",
    "ads_user_reward_day",
    "ads_user_reward_total",
    "ods_changelog_apply",
    "ods_latest_version",
    "change_json_roundtrip",
    "dim_user_info",
    "lookup_user_device",
    "window_order_hour",
    "stream_channel_game",
    "stream_upsert_replay",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = int(os.environ.get("BENCH_CPUS", "8"))
    spark = config.session(
        "bench", cores=cores, shuffle_partitions=cores, **{"spark.driver.memory": "12g"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{folder}/region.parquet").count()  # starts executors and the Parquet reader
    wanted = sys.argv[1:] or HEADLINE
    seconds = {}
    for name in wanted:
        began = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - began, 3)
    scale = re.search(r"sf([0-9.]+)", folder)
    print(
        json.dumps(
            {
                "metric": "mart_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(scale.group(1)) if scale else None,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
