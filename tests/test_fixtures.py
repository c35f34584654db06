"""The derived tables and feeds: large keys, and feeds that arrive as small files."""

from __future__ import annotations

import datetime as dt
from glob import glob
from os.path import getsize

from pyspark.sql import functions as F

from rillmart import config
from rillmart.fixtures import feeds, queries
from rillmart.fixtures.queries import QUERIES
from rillmart.fixtures.tables import load
from rillmart.streaming import jobs

DAY = dt.datetime(2024, 1, 1)


def write_orders(spark, folder, *orders):
    """Orders of one line each: ``(order, part, supplier)``."""
    spark.createDataFrame(
        [(o, 1, "F", 5.0, DAY, "1-URGENT") for o, _, _ in orders],
        "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string",
    ).write.parquet(f"{folder}/orders.parquet")
    spark.createDataFrame(
        [(o, p, s, 1, 1.0, 2.0, 0.0, 0.0, "R", "F", DAY) for o, p, s in orders],
        "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, "
        "l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    ).write.parquet(f"{folder}/lineitem.parquet")


def test_payment_ids_of_large_order_numbers(spark, tmp_path):
    orders = [(7, 2, 3), (9_000_000, 1_200_000, 60_000), (9_300_000, 5, 6), (54_000_000, 7_200_000, 360_000)]
    write_orders(spark, str(tmp_path), *orders)
    ids = [((o * 10 + 1) * 1_000_000 + p) * 100_000 + s for o, p, s in orders]
    assert max(ids[:2]) < 2**63 < min(ids[2:])
    found = load(spark, str(tmp_path), "third_withdraw_payment_order").select("id").collect()
    assert sorted(r.id for r in found) == sorted(i % 2**63 for i in ids)
    topic = QUERIES["ods_third_withdraw_payment_order"](spark, str(tmp_path))
    assert {r.id for r in topic.collect()} == {i % 2**63 for i in ids}


def messages(spark, rows):
    made = spark.range(rows).selectExpr("id", "'some column ' || CAST(id AS STRING) AS text", "CAST(id / 7 AS DECIMAL(20,4)) AS amount")
    return made.select(F.col("id").cast("string").alias("key"), F.to_json(F.struct("*")).alias("value"))


def test_feed_files_are_compressed(spark):
    sent = [r.value for r in messages(spark, 20_000).collect()]
    path = feeds.write_lines(messages(spark, 20_000), config.scratch(spark, "feed"))
    assert sum(map(getsize, glob(f"{path}/part-*"))) < sum(map(len, sent)) / 3
    assert sorted(r.value for r in spark.read.text(path).collect()) == sorted(sent)


def test_turns_are_made_in_one_go(spark, monkeypatch):
    """Each turn's stream gets its own messages only, and the feed is encoded once for all of them."""
    made, turns = [], []
    write = feeds.write_lines
    monkeypatch.setattr(feeds, "write_lines", lambda *x: made.append(x) or write(*x))

    def run(stream, checkpoint):
        turns.append([])
        jobs.start(stream, lambda rows, number: turns[-1].extend(r.value for r in rows.collect()), checkpoint).awaitTermination()

    queries._in_turns(spark, messages(spark, 300), run)
    queries._in_turns(spark, messages(spark, 10), run, F.lit(1))  # turns without messages
    sent = [r.value for r in messages(spark, 300).collect()]
    assert sorted(sum(turns[:3], [])) == sorted(sent) and all(turns[:3])
    assert [len(t) for t in turns[3:]] == [0, 10, 0]
    assert len(made) == 2
