"""Envelopes, row kinds, compaction, codecs, topics, dimensions and writers."""

from __future__ import annotations

import datetime as dt
import json
from decimal import Decimal as D
from glob import glob

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from rillmart import config, schemas
from rillmart.functions import codes
from rillmart.operators import changelog
from rillmart.operators.conform import conform, enforce_not_null, protect
from rillmart.operators.lookup import device_of_user
from rillmart.plans import dim, dwd, ods
from rillmart.sources import envelopes as env
from rillmart.sources import readers, writers

DDL = "id bigint, name string, amount decimal(20,4), at timestamp_ntz"


def lines(spark, *items):
    return spark.createDataFrame([(i if isinstance(i, str) else json.dumps(i),) for i in items], "value string")


def row(id, name="a", amount=1.5, at="2025-12-31T15:12:09.123"):
    return {"id": id, "name": name, "amount": amount, "at": at}


CHANGES = (
    {"before": None, "after": row(1), "op": "c", "source": {"pos": 1}},
    {"before": row(1), "after": row(1, "b", at="2025-12-31 15:12:09.123"), "op": "u", "source": {"pos": 2}},
    {"before": None, "after": row(2), "op": "r", "source": {"pos": 3}},
    {"before": row(2), "after": None, "op": "d", "source": {"pos": 4}},
    {"before": None, "after": row(3), "op": "truncate"},
    "{broken",
)


def test_decode_drops_unreadable_changes_and_reads_both_time_forms(spark):
    got = env.decode_changes(lines(spark, *CHANGES), DDL)
    assert sorted(r.op for r in got.collect()) == ["c", "d", "r", "u"]
    times = {r.at for r in changelog.images(got).collect()}
    assert times == {dt.datetime(2025, 12, 31, 15, 12, 9, 123000)}


def test_images_are_signed_sides(spark):
    got = changelog.images(env.decode_changes(lines(spark, *CHANGES), DDL))
    assert sorted((r.op, r.sign, r.id, r.name) for r in got.collect()) == [
        ("c", 1, 1, "a"), ("d", -1, 2, "a"), ("r", 1, 2, "a"), ("u", -1, 1, "a"), ("u", 1, 1, "b"),
    ]


def test_parse_runs_once(spark):
    plan = changelog.images(env.decode_changes(lines(spark, *CHANGES), DDL))._jdf.queryExecution()
    assert plan.optimizedPlan().toString().count("from_json") == 1


def test_row_kinds_and_plain_codes_normalise(spark):
    df = spark.createDataFrame(
        [("+I", 1), ("-U", 1), ("+U", 1), ("-D", 1), ("c", 1), ("r", 1), ("d", 1), ("?", 1)], "row_status string, id int"
    ).withColumn("pos", F.lit(0).cast("bigint"))
    got = sorted((r.op, r.sign) for r in changelog.images_from_row_kinds(df).collect())
    assert got == [("c", 1), ("c", 1), ("d", -1), ("d", -1), ("r", 1), ("u", -1), ("u", 1)]


@pytest.mark.parametrize("style", ["change", "pair"])
def test_encoding_round_trip_keeps_current_state(spark, style):
    first = env.decode_changes(lines(spark, *CHANGES), DDL)
    again = env.decode_changes(env.encode_changes(first, ["id"], style=style), DDL)
    state = changelog.current_state(changelog.images(again), ["id"]).collect()
    assert [(r.id, r.name, r.amount) for r in state] == [(1, "b", D("1.5000"))]


def test_pairs_write_updates_as_delete_and_create(spark):
    first = env.decode_changes(lines(spark, CHANGES[1]), DDL)
    sent = env.encode_changes(first, ["id"], style="pair").collect()
    assert sorted(json.loads(r.value)["op"] for r in sent) == ["c", "d"]
    assert {r.key for r in sent} == {'{"id":1}'}


def test_compaction_ignores_order_and_repeats(spark):
    data = [("c", 1, 1, 10), ("u", 2, -1, 10), ("u", 2, 1, 20), ("u", 2, 1, 20), ("c", 1, 1, 10)]
    df = spark.createDataFrame([(*d, 7) for d in data], "op string, pos bigint, sign int, v int, id int")
    for arranged in (df, df.orderBy(F.desc("pos")), df.orderBy("pos")):
        assert [r.v for r in changelog.current_state(arranged, ["id"]).collect()] == [20]


def test_compaction_keeps_one_row_per_key_and_task_before_the_shuffle(spark):
    df = spark.range(10).selectExpr("'c' AS op", "id AS pos", "id % 2 AS id")
    plan = changelog.compact(df, ["id"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_topics_drop_deletes_except_where_kept(spark):
    rows = {n: None for n in schemas.names(schemas.USER_PROXY_STATISTIC)}
    changes = lines(
        spark,
        {"before": None, "after": {**rows, "id": 1}, "op": "c", "source": {"pos": 1}},
        {"before": {**rows, "id": 1}, "after": None, "op": "d", "source": {"pos": 2}},
    )
    kept = ods.TOPICS["flink_user_proxy_statistic_data_sync"]
    assert sorted(r.op for r in ods.published(kept, env.decode_changes(changes, kept.ddl)).collect()) == ["c", "d"]
    for topic in ods.TOPICS.values():
        if not topic.keep_deletes:
            sent = ods.messages(topic, env.decode_changes(changes, topic.ddl)).collect()
            assert [json.loads(r.value)["op"] for r in sent] == ["c"], topic.name


def test_dimension_applies_deletes_and_drops_missing_keys(spark):
    ddl = schemas.USER_GLOBAL_CURRENCY_ACCOUNT
    snapshot = spark.range(1, 4).selectExpr(
        "id", *(f"CAST(NULL AS {t}) AS {n}" for n, t in schemas.fields(ddl) if n != "id")
    )
    blank = {n: None for n in schemas.names(ddl)}
    changes = lines(
        spark,
        {"before": {**blank, "id": 2}, "after": None, "op": "d", "source": {"pos": 1}},
        {"before": None, "after": {**blank, "id": 9, "user_id": 5}, "op": "c", "source": {"pos": 2}},
        {"before": None, "after": {**blank, "user_id": 6}, "op": "c", "source": {"pos": 3}},
    )
    out = dim.dimension(
        "user_global_currency_account", snapshot, changelog.upserts(env.decode_changes(changes, ddl))
    )
    assert sorted((r.id, r.user_id) for r in out.collect()) == [(1, None), (3, None), (9, 5)]


def test_sensitive_columns_can_be_dropped_or_hashed(spark):
    df = spark.createDataFrame([(1, "secret")], "user_id bigint, password string")
    assert protect(df, ["password", "user_phone"]).columns == ["user_id"]
    hashed = protect(df, ["password"], how="hash").first().password
    assert len(hashed) == 64 and "secret" not in hashed


def test_conform_binds_by_name_and_fails_on_missing_columns(spark):
    df = spark.createDataFrame([("x", 1)], "b string, a int")
    assert conform(df, "a bigint, b string").dtypes == [("a", "bigint"), ("b", "string")]
    with pytest.raises(PySparkException):
        conform(df, "a bigint, c string").collect()


def test_not_null_counts_dropped_rows(spark):
    from pyspark.sql import Observation

    df = spark.createDataFrame([(1, None), (None, 2), (3, 4)], "a int, b int")
    assert enforce_not_null(df, ["a", "b"], metric="dropped").count() == 1
    seen = Observation("seen")
    df.observe(seen, F.count_if(F.col("a").isNull() | F.col("b").isNull()).alias("n")).count()
    assert seen.get["n"] == 2


def test_events_survive_broken_lines(spark):
    good = {"key": "1", "dataSyncType": "INSERT", "jsonData": {
        "user_id": 1, "online_time": "2025-12-31T15:12:09.5", "create_time": "2025-12-31T15:12:09", "token": "t"}}
    unreadable = {**good, "jsonData": {**good["jsonData"], "online_time": "soon"}}
    missing = {**good, "jsonData": {**good["jsonData"], "user_id": None}}
    out = dwd.user_online(env.decode_events(lines(spark, good, unreadable, missing, "{no", "{}"), schemas.ONLINE_EVENT))
    assert sorted((r.session_id, str(r.online_time)) for r in out.collect()) == [
        ("N/A", "2025-12-31 15:12:09.500000"), ("N/A", "None"),
    ]


def test_lookup_branches(spark):
    facts = spark.createDataFrame([(1,), (2,), (3,), (None,)], "user_id bigint")
    devices = spark.createDataFrame([(1, "z"), (1, "b"), (3, None)], "user_id bigint, device_id string")
    got = {r.user_id: r.dimension_info for r in device_of_user(facts, devices).collect()}
    assert got == {1: "device_id: b", 2: "no_device", 3: "device_id: null", None: "unknown"}


def test_codes_decode_and_fail_on_unknown(spark):
    df = spark.createDataFrame([(2,), (9,)], "c int")
    soft = [r[0] for r in df.select(codes.decode(F.col("c"), codes.DEVICE_TYPE, strict=False)).collect()]
    assert soft == ["ANDROID", None]
    with pytest.raises(PySparkException, match="Invalid device type: 9"):
        df.select(codes.decode(F.col("c"), codes.DEVICE_TYPE)).collect()


def test_shards_keep_equal_ids_apart(spark):
    root = config.scratch(spark, "shards")
    for shard in ("game_record_0", "game_record_1", "other"):
        spark.range(2).write.parquet(f"{root}/{shard}")
    got = sorted((r._shard, r.id) for r in readers.shard_tables(spark, root, "game_record_*").collect())
    assert got == [("game_record_0", 0), ("game_record_0", 1), ("game_record_1", 0), ("game_record_1", 1)]


def test_multi_table_feed_is_routed(spark):
    feed = [{**c, "source": {"pos": i, "table": t}} for i, (c, t) in enumerate(zip(CHANGES[:2], ("a", "b")))]
    decoded = env.decode_changes(lines(spark, *feed), DDL)
    assert [r.op for r in readers.of_table(decoded, "b").collect()] == ["u"]


def test_kafka_options_know_their_start_modes():
    options = readers.kafka_options("host:1", "topic", start="earliest")
    assert options["startingOffsets"] == "earliest"
    with pytest.raises(ValueError):
        readers.kafka_options("host:1", "topic", start="yesterday")


def test_upsert_statements():
    assert writers.upsert_statement("t", ["k", "v"], ["k"], "mysql") == (
        "INSERT INTO `t` (`k`, `v`) VALUES (%s, %s) ON DUPLICATE KEY UPDATE `v` = VALUES(`v`)"
    )
    assert writers.upsert_statement("t", ["k", "v"], ["k"], "ansi").endswith(
        'ON CONFLICT ("k") DO UPDATE SET "v" = excluded."v"'
    )
    assert writers.delete_statement("t", ["k"], "mysql") == "DELETE FROM `t` WHERE `k` <=> %s"


class Recorder:
    """Stand-in for a DB-API connection: writes what it is told to a file; fails at first on request."""

    def __init__(self, folder, fail_first):
        self.folder, self.fail_first, self.seen = folder, fail_first, []

    def cursor(self):
        return self

    def executemany(self, statement, values):
        self.seen += [(statement.split()[0], list(v)) for v in values]

    def commit(self):
        import os
        import uuid

        marker = os.path.join(self.folder, f"failed-{os.getpid()}")
        if self.fail_first and not os.path.exists(marker):
            open(marker, "w").close()
            raise OSError("connection lost")
        with open(os.path.join(self.folder, f"batch-{uuid.uuid4().hex}.json"), "w") as out:
            json.dump(self.seen, out)

    def close(self):
        pass


@pytest.mark.parametrize("fail_first", [False, True])
def test_keyed_writer_buffers_deletes_and_retries(spark, tmp_path, fail_first):
    folder = str(tmp_path)
    writer = writers.KeyedTableWriter(
        lambda: Recorder(folder, fail_first), "t", ["id"], buffer_rows=4, writers=2, pause=0.0
    )
    writer(spark.range(20).selectExpr("id", "id * 2 AS v", "IF(id % 5 = 0, 'd', 'u') AS op"))
    batches = [json.load(open(p)) for p in glob(f"{folder}/batch-*.json")]
    assert max(map(len, batches)) <= 4
    written = sorted((s, v) for b in batches for s, v in b)
    assert [v for s, v in written if s == "DELETE"] == [[0], [5], [10], [15]]
    assert len([v for s, v in written if s == "INSERT"]) == 16


def test_pairs_go_back_to_changes(spark):
    """Filters and key changes turn updates into creates and deletes; repeats fall together."""
    rows = [
        ("c", 1, 1, 1, "a"), ("c", 1, 1, 1, "a"),
        ("u", 2, -1, 1, "a"), ("u", 2, 1, 1, "b"),
        ("u", 3, -1, 1, "b"),  # left the filter
        ("u", 4, 1, 1, "c"),  # came back
        ("u", 5, -1, 1, "c"), ("u", 5, 1, 9, "c"),  # took another key
        ("d", 6, -1, 9, "c"),
    ]
    made = changelog.paired(spark.createDataFrame(rows, "op string, pos bigint, sign int, id int, v string"), ["id"])
    got = sorted((r.pos, r.op, r.before and tuple(r.before), r.after and tuple(r.after)) for r in made.collect())
    assert got == [
        (1, "c", None, (1, "a")), (2, "u", (1, "a"), (1, "b")), (3, "d", (1, "b"), None), (4, "c", None, (1, "c")),
        (5, "c", None, (9, "c")), (5, "d", (1, "c"), None), (6, "d", (9, "c"), None),
    ]


def test_chunks_hand_over_by_position(spark):
    snapshot = spark.createDataFrame([(1, "read"), (2, "read"), (11, "read"), (21, "read")], "id int, v string")
    read_at = spark.createDataFrame([(0, 5), (1, 3)], "chunk bigint, read_at bigint")
    changes = spark.createDataFrame(
        [
            ("u", 4, 1, "old"), ("u", 5, 2, "same"), ("u", 6, 2, "new"),  # chunk 0 was read at 5
            ("c", 2, 3, "gone before the read"), ("u", 6, 4, "came after"),
            ("d", 4, 11, "read"),  # chunk 1 was read at 3
            ("u", 0, 21, "kept"), ("c", 0, 22, "no chunk"),  # chunk 2 was never read in chunks
        ],
        "op string, pos bigint, id int, v string",
    )
    live = changelog.hand_over(snapshot, read_at, changes, ["id"], changelog.key_chunk("id", 0, 10))
    assert {r.id: r.v for r in live.collect()} == {1: "read", 2: "new", 4: "came after", 21: "kept", 22: "no chunk"}


def test_one_feed_of_many_tables(spark):
    tables = {"a": "id bigint, x string", "b": "id bigint, y decimal(10,2)"}
    make = lambda name, ddl, *values: env.encode_changes(
        spark.createDataFrame([("c", None, v, k) for k, v in enumerate(values)], f"op string, before struct<{ddl}>, after struct<{ddl}>, pos bigint"),
        ["id"], table=name,
    ).select("value")
    feed = make("a", "id: bigint, x: string", (1, "p"), (2, None)).union(make("b", "id: bigint, y: decimal(10,2)", (1, D("2.50"))))
    feed = feed.union(make("c", "id: bigint, z: int", (1, 1))).union(spark.createDataFrame([("{broken",), (None,)], "value string"))
    from pyspark.sql import Observation

    seen = Observation("feed")
    decoded = env.decode_feed(feed, tables, metric=seen)
    got = {name: sorted((r.op, r.pos, tuple(r.after)) for r in env.of_feed(decoded, name).collect()) for name in tables}
    assert got == {"a": [("c", 0, (1, "p")), ("c", 1, (2, None))], "b": [("c", 0, (1, D("2.50")))]}
    assert seen.get == {"unknown_table": 1, "unreadable": 2}
