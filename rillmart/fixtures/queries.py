"""Named queries over the provided tables, one per operator or mart."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rillmart import config, schemas
from rillmart.fixtures import feeds
from rillmart.fixtures.tables import load, read
from rillmart.functions.codes import DEVICE_TYPE, GAME_ID, ORDER_STATUS, decode
from rillmart.operators import changelog
from rillmart.operators.conform import enforce_not_null, protect
from rillmart.operators.lookup import DEVICE_OF_USER, WITHOUT_DEVICE, device_info, device_of_user
from rillmart.operators.mart import Mart
from rillmart.plans import ads, dim, dwd, dws, ods
from rillmart.sources.envelopes import decode_changes, decode_events, decode_feed, encode_changes, encode_events, of_feed
from rillmart.sources.readers import file_messages, shard_tables
from rillmart.streaming import jobs, windows
from rillmart.streaming.log import Batch

Query = Callable[[SparkSession, str], DataFrame]
BATCH_BYTES = 64 << 20  # of a feed that one micro-batch takes


def _cleaned(spark: SparkSession, folder: str, table: str, shape: str | None = None) -> DataFrame:
    source, rule = dwd.CLEANERS[table]
    return rule(load(spark, folder, shape or source))


def _dwd(table: str, shape: str | None = None) -> Query:
    return lambda spark, folder: _cleaned(spark, folder, table, shape)


def _mart(mart: Mart, shape: str | None = None) -> Query:
    return lambda spark, folder: mart.build(_cleaned(spark, folder, mart.source, shape))


def _over_user_games(mart: Mart) -> Query:
    def query(spark: SparkSession, folder: str) -> DataFrame:
        return mart.build(dws.USER_GAME_DAY.build(_cleaned(spark, folder, "dwd_game_record")))

    return query


def _rolled_up(name: str) -> Query:
    return lambda spark, folder: dws.game_marts(_cleaned(spark, folder, "dwd_game_record"))[name]


def _finance(spark: SparkSession, folder: str) -> DataFrame:
    orders = _cleaned(spark, folder, "dwd_withdraw_order")
    return dws.finance_increment(orders, load(spark, folder, "third_withdraw_payment_order"))


def _bounty(*, by_day: bool, compute: bool) -> Query:
    return lambda spark, folder: ads.user_bounty(load(spark, folder, "bounty_event"), by_day=by_day, compute=compute)


# --- change feeds ---------------------------------------------------------------


def _feed(spark: SparkSession, folder: str, shape: str, ddl: str, **options) -> DataFrame:
    """Envelopes of a derived feed after a trip through their JSON form."""
    rows = load(spark, folder, shape).select(*schemas.names(ddl))
    made = feeds.envelopes(rows, feeds.SECOND[shape], **options)
    return decode_changes(encode_changes(made, ["id"]), ddl)


def _topic(name: str, shape: str | None = None) -> Query:
    """A published change topic, read back as signed rows."""

    def query(spark: SparkSession, folder: str) -> DataFrame:
        topic = ods.TOPICS[name]
        changes = _feed(spark, folder, shape or topic.table, schemas.TABLES[topic.table])
        return changelog.images(decode_changes(ods.messages(topic, changes), topic.ddl))

    return query


def _topic_as_pairs(spark: SparkSession, folder: str) -> DataFrame:
    topic = ods.TOPICS["flink_recharge_order_data_sync"]
    changes = _feed(spark, folder, topic.table, topic.ddl)
    pairs = decode_changes(ods.messages(topic, changes, style="pair"), topic.ddl)
    return changelog.images(pairs)


def _cleaned_topic(table: str, shape: str, ddl: str) -> Query:
    """The change topic of a cleaned table, read back as signed rows."""

    def query(spark: SparkSession, folder: str) -> DataFrame:
        images = changelog.images(_feed(spark, folder, shape, ddl))
        messages = dwd.topic_messages(jobs.cleaned_images(images, dwd.CLEANERS[table][1]))
        return changelog.images(decode_changes(messages, dwd.TOPICS[table]))

    return query


def _reward_topic(spark: SparkSession, folder: str) -> DataFrame:
    messages = dwd.event_messages(_cleaned(spark, folder, "dwd_reward_record"))
    return changelog.images(decode_changes(messages, dwd.TOPICS["dwd_reward_record"]))


CHUNK_KEYS = 100  # keys of one snapshot chunk


def _chunked_dimension(spark: SparkSession, folder: str) -> DataFrame:
    """A dimension whose snapshot was read chunk by chunk while changes ran.

    Chunk ``c`` is read at position ``c % 4``, so chunks hold none, some or all of their
    keys' changes, and the feed repeats all of them.
    """
    ddl = schemas.USER_INFO
    chunk = changelog.key_chunk("id", 0, CHUNK_KEYS)
    changes = changelog.upserts(_feed(spark, folder, "user_info", ddl))
    chunks = changes.select(chunk.alias("chunk")).distinct()
    read_at = chunks.withColumn("read_at", F.pmod("chunk", F.lit(4)))
    past = changes.withColumn("chunk", chunk).join(read_at, "chunk").where("pos <= read_at").drop("chunk", "read_at")
    snapshot = changelog.current_state(past, ["id"])
    return changelog.hand_over(snapshot, read_at, changes, ["id"], chunk)


def _dimension(table: str) -> Query:
    def query(spark: SparkSession, folder: str) -> DataFrame:
        ddl = schemas.TABLES[table]
        changes = changelog.upserts(_feed(spark, folder, table, ddl, creates=False))
        return dim.dimension(table, load(spark, folder, table).select(*schemas.names(ddl)), changes)

    return query


def _protected_user(spark: SparkSession, folder: str) -> DataFrame:
    return protect(load(spark, folder, "user"), schemas.SENSITIVE["user"], how="hash").select(
        "user_id", "password", "user_phone", "user_email"
    )


def _changelog_apply(spark: SparkSession, folder: str) -> DataFrame:
    changes = changelog.upserts(_feed(spark, folder, "withdraw_order", schemas.WITHDRAW_ORDER))
    return changelog.current_state(changes, ["id"])


def _row_kinds(spark: SparkSession, folder: str) -> DataFrame:
    """Row-kind tagged changes, normalised and summed with their sign."""
    rows = load(spark, folder, "recharge_order").select("id", "channel_id", "order_amount")
    kinds = F.array(
        F.lit("+I"),
        F.when(F.expr(feeds.UPDATED.format("id")), "-U"),
        F.when(F.expr(feeds.UPDATED.format("id")), "+U"),
        F.when(F.expr(feeds.DELETED.format("id")), "-D"),
    )
    tagged = rows.withColumn("row_status", F.explode(F.array_compact(kinds))).withColumn(
        "pos", F.lit(0).cast("bigint")
    )
    return (
        changelog.images_from_row_kinds(tagged)
        .groupBy("channel_id", "op")
        .agg(
            F.sum("sign").alias("net_rows"),
            F.expr("sum(sign * order_amount)").cast("decimal(20,4)").alias("net_amount"),
        )
    )


def _latest_bet(spark: SparkSession, folder: str) -> DataFrame:
    rows = load(spark, folder, "game_record").select("id", "update_time", "bet_amount", "game_id", "game_category_id")
    order = [F.col(c).desc_nulls_last() for c in ("update_time", "bet_amount", "game_id", "game_category_id")]
    return changelog.latest(rows, ["id"], order)


def _shard_union(spark: SparkSession, folder: str) -> DataFrame:
    root = config.scratch(spark, "shards")
    rows = load(spark, folder, "game_event").withColumn("shard", F.expr("'game_record_' || CAST(id % 8 AS STRING)"))
    rows.hint("rebalance", F.col("shard")).write.partitionBy("shard").parquet(root)
    return shard_tables(spark, root, "shard=game_record_*").select("id", "user_id", "bet_amount", "update_time", "_shard")


def _game_landing(spark: SparkSession, folder: str) -> DataFrame:
    return dim.game_record_landing(changelog.upserts(_feed(spark, folder, "game_event", schemas.GAME_RECORD)))


def _reward_landing(spark: SparkSession, folder: str) -> DataFrame:
    return dim.reward_record_landing(_cleaned(spark, folder, "dwd_reward_record"))


def _json_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """Enveloped events with every 101st message broken, decoded and cleaned."""
    rows = load(spark, folder, "reward_event").select(*schemas.names(schemas.REWARD_EVENT))
    messages = encode_events(rows, "id", "INSERT").withColumn(
        "value", F.expr("IF(CAST(key AS BIGINT) % 101 = 0, substring(value, 1, 20), value)")
    )
    return dwd.reward_record(decode_events(messages, schemas.REWARD_EVENT))


def _not_null(spark: SparkSession, folder: str) -> DataFrame:
    mart = dws.USER_RECHARGE
    built = mart.build(_cleaned(spark, folder, mart.source))
    return enforce_not_null(built, list(mart.keys))


def _device(spark: SparkSession, folder: str) -> DataFrame:
    users = read(spark, folder, "customer").selectExpr(
        "c_custkey AS customer", "CASE WHEN c_custkey % 50 = 0 THEN NULL ELSE c_custkey END AS user_id"
    )
    return device_of_user(users, load(spark, folder, "device_users_relations_flat"))


def _order_status(spark: SparkSession, folder: str) -> DataFrame:
    code = F.expr("CAST(o_orderkey % 4 AS INT)")
    return (
        read(spark, folder, "orders").select(decode(code, ORDER_STATUS).alias("order_status"))
        .groupBy("order_status").agg(F.count(F.lit(1)).alias("orders"))
    )


def _login_minutes(spark: SparkSession, folder: str) -> DataFrame:
    online = dwd.user_online_status(load(spark, folder, "online_event")).where("online_time IS NOT NULL")
    return windows.login_counts(online)


def _order_hours(spark: SparkSession, folder: str) -> DataFrame:
    rows = read(spark, folder, "events").selectExpr("ts AS update_time", "CAST(value AS DECIMAL(20,4)) AS order_amount")
    return windows.order_counts(rows)


# --- streams -----------------------------------------------------------------------


def _lines(spark: SparkSession, messages: DataFrame) -> DataFrame:
    """A stream over JSON-lines files of the messages, several micro-batches long."""
    path = feeds.write_lines(messages, config.scratch(spark, "feed"))
    return file_messages(spark, path, bytes_per_batch=BATCH_BYTES)


def _in_turns(
    spark: SparkSession, messages: DataFrame, run: Callable[[DataFrame, str], None], turn: Column | None = None, turns: int = 3
) -> None:
    """``run`` a stream over the messages as they arrive in turns, each time from the checkpoint of the last."""
    feed, checkpoint = config.scratch(spark, "feed"), config.scratch(spark, "progress")
    feeds.write_lines(messages, feed, F.pmod(F.xxhash64("value"), F.lit(turns)) if turn is None else turn)
    for k in range(turns):
        run(file_messages(spark, f"{feed}/{feeds.TURN}=[0-{k}]", bytes_per_batch=BATCH_BYTES), checkpoint)


def _change_stream(spark: SparkSession, folder: str, shape: str, ddl: str, *, repeats: bool) -> DataFrame:
    rows = load(spark, folder, shape).select(*schemas.names(ddl))
    made = feeds.envelopes(rows, feeds.SECOND[shape], repeats=repeats)
    return decode_changes(_lines(spark, encode_changes(made, ["id"])), ddl)


def _finish(spark: SparkSession, stream: DataFrame, handler: jobs.Handler) -> None:
    query = jobs.start(stream, handler, config.scratch(spark, "progress"))
    query.awaitTermination()


def _ledger_stream(mart: Mart, shape: str, ddl: str, *also: Mart, part: str = jobs.DAY) -> Query:
    """One change stream into one or more incrementally maintained marts."""

    def query(spark: SparkSession, folder: str) -> DataFrame:
        root = config.scratch(spark, "marts")
        rule = dwd.CLEANERS[mart.source][1]
        targets = [jobs.LedgerMart(spark, m, root, part) for m in (mart, *also)]
        handler = jobs.fan_out(
            lambda batch: jobs.cleaned_images(changelog.images(batch), rule), *(t.apply for t in targets)
        )
        _finish(spark, _change_stream(spark, folder, shape, ddl, repeats=False), handler)
        return targets[0].table()

    return query


def _stream_fan_out(spark: SparkSession, folder: str) -> DataFrame:
    """Both targets of one prepared batch, side by side."""
    root = config.scratch(spark, "marts")
    targets = [jobs.LedgerMart(spark, m, root) for m in (dws.CHANNEL_GAME_PROVIDER, dws.CHANNEL_GAME_CATEGORY)]
    handler = jobs.fan_out(
        lambda batch: jobs.cleaned_images(changelog.images(batch), dwd.game_record), *(t.apply for t in targets)
    )
    _finish(spark, _change_stream(spark, folder, "game_event", schemas.GAME_RECORD, repeats=False), handler)
    both = [t.table().select("statistic_time", "channel_id", "user_count", "bet_amount") for t in targets]
    return changelog.union_tables([t.withColumn("mart", F.lit(m)) for t, m in zip(both, ("provider", "category"))])


def _stream_repeats(mart: Mart, shape: str, ddl: str, part: str) -> Query:
    """A ledger mart over a topic that repeats deliveries and sends updates without the row before.

    Keyed current rows turn the changes into exact signed images first.
    """

    def query(spark: SparkSession, folder: str) -> DataFrame:
        root = config.scratch(spark, "marts")
        rule = dwd.CLEANERS[mart.source][1]
        rows = jobs.RowTable(spark, shape, ["id"], root, jobs.bucket("id", 8))
        target = jobs.LedgerMart(spark, mart, root, part)

        def handle(batch: DataFrame, batch_id: Batch) -> None:
            blind = batch.withColumn("before", F.when(F.col("op") != changelog.UPDATE, F.col("before")))
            images = rows.differences(changelog.upserts(blind), batch_id)
            jobs.fan_out(lambda changed: jobs.cleaned_images(changed, rule), target.apply)(images, batch_id)

        made = feeds.envelopes(load(spark, folder, shape).select(*schemas.names(ddl)), feeds.SECOND[shape])
        _in_turns(
            spark, encode_changes(made, ["id"]),
            lambda stream, at: jobs.start(decode_changes(stream, ddl), handle, at).awaitTermination(),
        )
        return target.table()

    return query


def _stream_restart(spark: SparkSession, folder: str) -> DataFrame:
    """A mart over a stream that stops, goes on from its checkpoint, and later starts with a new one.

    The second checkpoint counts its batches from 0 again over the same tables;
    finished batches are compacted in between.
    """
    root = config.scratch(spark, "marts")
    rows = load(spark, folder, "game_event").select(*schemas.names(schemas.GAME_RECORD))
    messages = encode_changes(feeds.envelopes(rows, feeds.SECOND["game_event"], repeats=False), ["id"])
    target = jobs.LedgerMart(spark, dws.CHANNEL_GAME, root, gather=2)
    handler = jobs.fan_out(
        lambda batch: jobs.cleaned_images(changelog.images(batch), dwd.game_record), target.apply
    )
    feed = feeds.write_lines(messages, config.scratch(spark, "feed"), F.pmod(F.xxhash64("value"), F.lit(3)))
    first, second = config.scratch(spark, "progress"), config.scratch(spark, "progress")
    for turns, checkpoint in (("[0]", first), ("[0-1]", first), ("[2]", second)):
        stream = file_messages(spark, f"{feed}/{feeds.TURN}={turns}", bytes_per_batch=BATCH_BYTES)
        jobs.start(decode_changes(stream, schemas.GAME_RECORD), handler, checkpoint).awaitTermination()
    return target.table()


def _stream_order_hours(spark: SparkSession, folder: str) -> DataFrame:
    """Hourly counts of closed windows over three batches, the last of rows that come too late.

    Every 97th event of the first third of the month arrives after all others, when
    its window is closed, and is left out.
    """
    feed, out, progress = (config.scratch(spark, n) for n in ("feed", "windows", "progress"))
    early = "ts < TIMESTAMP_NTZ '2024-01-11 00:00:00'"
    rows = read(spark, folder, "events").selectExpr(
        "CAST(ts AS TIMESTAMP) AS update_time", "CAST(value AS DECIMAL(20,4)) AS order_amount",
        f"CASE WHEN {early} THEN IF(event_id % 97 = 0, 2, 0) ELSE 1 END AS turn",
    )
    schema = rows.drop("turn").schema
    for turn in range(3):
        rows.where(F.col("turn") == turn).drop("turn").write.mode("append").parquet(feed)
        counted = windows.order_counts(spark.readStream.schema(schema).parquet(feed), lateness=windows.LATENESS)
        sink = counted.writeStream.outputMode("append").format("parquet").option("path", out)
        sink.option("checkpointLocation", progress).trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(out)


def _stream_expiring(spark: SparkSession, folder: str) -> DataFrame:
    """Reward totals of users whose state expired: 36 hours of the event clock without a change close it."""
    rows = load(spark, folder, "reward_event").select(*schemas.names(schemas.REWARD_EVENT))
    messages = encode_events(rows, "id", "INSERT")
    third = "CAST(floor(datediff(DAY, TIMESTAMP_NTZ '2024-01-01 00:00:00', CAST(get_json_object(value, '$.jsonData.update_time') AS TIMESTAMP_NTZ)) / 10) AS INT)"
    out = config.scratch(spark, "expired")

    def run(stream: DataFrame, checkpoint: str) -> None:
        cleaned = dwd.reward_record(decode_events(stream, schemas.REWARD_EVENT))
        expired = windows.expired_totals(cleaned, ["user_id"], "update_time", [
            F.count(F.lit(1)).alias("reward_count"), F.sum("bonus_amount").cast("decimal(20,4)").alias("reward_amount"),
        ])
        sink = expired.writeStream.outputMode("append").format("parquet").option("path", out)
        sink.option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()

    _in_turns(spark, messages, run, F.least(F.greatest(F.expr(third), F.lit(0)), F.lit(2)))
    return spark.read.parquet(out)


def _decoded(table: dict[int, str], code: str, label: str) -> Query:
    """Lenient decoding of a code table, unknown codes counted as NULL."""

    def query(spark: SparkSession, folder: str) -> DataFrame:
        rows = read(spark, folder, "events").select(decode(F.expr(code), table, strict=False).alias(label))
        return rows.groupBy(label).agg(F.count(F.lit(1)).alias("events"))

    return query


def _reward_stream(mart: Mart, part: str = jobs.MONTH) -> Query:
    """A reward mart over a stream of enveloped events."""

    def query(spark: SparkSession, folder: str) -> DataFrame:
        rows = load(spark, folder, "reward_event").select(*schemas.names(schemas.REWARD_EVENT))
        stream = decode_events(_lines(spark, encode_events(rows, "id", "INSERT")), schemas.REWARD_EVENT)
        target = jobs.LedgerMart(spark, mart, config.scratch(spark, "marts"), part)
        handler = jobs.fan_out(lambda batch: dwd.reward_record(batch).withColumn("sign", F.lit(1)), target.apply)
        _finish(spark, stream, handler)
        return target.table()

    return query


def _stream_replay(spark: SparkSession, folder: str) -> DataFrame:
    """Dimension copy with repeated deliveries, every batch applied twice, compacted on the way."""
    ddl = schemas.USER_INFO
    table = jobs.RowTable(spark, "user_info", ["id"], config.scratch(spark, "dims"), jobs.bucket("id", 8), gather=2)

    def handle(batch: DataFrame, batch_id: Batch) -> None:
        changes = changelog.upserts(batch)
        table.apply(changes, batch_id)
        table.apply(changes, batch_id)

    rows = load(spark, folder, "user_info").select(*schemas.names(ddl))
    messages = encode_changes(feeds.envelopes(rows, feeds.SECOND["user_info"]), ["id"])
    run = lambda stream, at: jobs.start(decode_changes(stream, ddl), handle, at).awaitTermination()
    _in_turns(spark, messages, run, turns=2)
    return table.current().drop("part")


def _chained(mart: Mart, part: str) -> Query:
    """A mart fed by the changes of another, in one stream with updates, moved days and deletes."""

    def query(spark: SparkSession, folder: str) -> DataFrame:
        root = config.scratch(spark, "marts")
        target = jobs.LedgerMart(spark, mart, root, part)
        first = jobs.LedgerMart(spark, dws.USER_GAME_DAY, root, then=(target.apply,))
        rows = load(spark, folder, "game_event").select(*schemas.names(schemas.GAME_RECORD))
        messages = encode_changes(feeds.envelopes(rows, feeds.SECOND["game_event"], repeats=False), ["id"])

        def handle(batch: DataFrame, batch_id: Batch) -> None:
            first.apply(jobs.cleaned_images(changelog.images(batch), dwd.game_record), batch_id)

        def run(stream: DataFrame, checkpoint: str) -> None:
            jobs.start(decode_changes(stream, schemas.GAME_RECORD), handle, checkpoint).awaitTermination()

        _in_turns(spark, messages, run)
        return target.table()

    return query


def _shared_feed(spark: SparkSession, folder: str, tables: dict[str, str], **options) -> DataFrame:
    """Messages of several tables' derived feeds, each naming its table."""
    made = [
        encode_changes(feeds.envelopes(load(spark, folder, name).select(*schemas.names(ddl)), feeds.SECOND[name], **options), ["id"], table=name)
        for name, ddl in tables.items()
    ]
    return changelog.union_tables(made)


def _stream_finance(spark: SparkSession, folder: str) -> DataFrame:
    """Withdrawals and their payment attempts from one feed, joined from what changes on either side."""
    root = config.scratch(spark, "marts")
    tables = {"withdraw_order": schemas.WITHDRAW_ORDER, "third_withdraw_payment_order": schemas.THIRD_WITHDRAW_PAYMENT_ORDER}
    stored = {name: jobs.RowTable(spark, name, ["id"], root, jobs.bucket("id", 8)) for name in tables}
    mart = jobs.LedgerMart(spark, dws.FINANCE_PAIRS, root, jobs.MONTH)
    join = jobs.DeltaJoin(spark, "matched", root, dws.MATCH)

    def handle(batch: DataFrame, batch_id: Batch) -> None:
        batch = batch.persist()  # each message is read and parsed once
        try:
            # repeated deliveries end here
            exact = {name: table.differences(changelog.upserts(of_feed(batch, name)), batch_id) for name, table in stored.items()}
            orders = dws.matched_order(jobs.cleaned_images(exact["withdraw_order"], dwd.withdraw_order))
            join.apply(orders, dws.matched_payment(exact["third_withdraw_payment_order"]), batch_id, mart.apply)
        finally:
            batch.unpersist()

    def run(stream: DataFrame, checkpoint: str) -> None:
        jobs.start(decode_feed(stream, tables), handle, checkpoint).awaitTermination()

    _in_turns(spark, _shared_feed(spark, folder, tables), run)
    return mart.table()


def _stream_multi_table(spark: SparkSession, folder: str) -> DataFrame:
    """Three tables kept from one feed that also carries a table nobody asked for."""
    root = config.scratch(spark, "tables")
    tables = {"withdraw_order": schemas.WITHDRAW_ORDER, "recharge_order": schemas.RECHARGE_ORDER, "user_info": schemas.USER_INFO}
    amounts = {"withdraw_order": "withdraw_funds_amount", "recharge_order": "order_amount", "user_info": "current_level_recharge_amount"}
    stored = {name: jobs.RowTable(spark, name, ["id"], root, jobs.bucket("id", 8)) for name in tables}
    handler = jobs.fan_out(
        lambda batch: batch,
        *(lambda rows, number, n=name, t=table: t.apply(changelog.upserts(of_feed(rows, n)), number) for name, table in stored.items()),
    )
    messages = _shared_feed(spark, folder, {**tables, "user_relations": schemas.USER_RELATIONS})

    def run(stream: DataFrame, checkpoint: str) -> None:
        jobs.start(decode_feed(stream, tables), handler, checkpoint).awaitTermination()

    _in_turns(spark, messages, run)
    return changelog.union_tables([
        table.current().select(F.lit(name).alias("table"), "id", "channel_id", F.col(amounts[name]).alias("amount"))
        for name, table in stored.items()
    ])


def _stream_lookup(spark: SparkSession, folder: str) -> DataFrame:
    """Facts beside the device of their user, corrected when devices come, change or go later."""
    root = config.scratch(spark, "lookup")
    tables = {"fact": "customer bigint, user_id bigint", "device": "id bigint, user_id bigint, device_id string"}
    facts = read(spark, folder, "customer").selectExpr(
        "c_custkey AS customer", "CASE WHEN c_custkey % 50 = 0 THEN NULL ELSE c_custkey END AS user_id"
    )
    devices = read(spark, folder, "events").selectExpr(
        "event_id AS id", "user_id", "'d' || CAST(event_id % 50 AS STRING) AS device_id"
    )
    nothing = F.when(F.lit(False), F.struct(*facts.columns))
    created = facts.select(F.lit("c").alias("op"), nothing.alias("before"), F.struct(*facts.columns).alias("after"), F.lit(1).cast("bigint").alias("pos"))
    messages = encode_changes(created, ["customer"], table="fact").unionByName(
        encode_changes(feeds.envelopes(devices, feeds.SECOND["device"], repeats=False), ["id"], table="device")
    )
    result = jobs.SignedRows(spark, "facts_with_device", root, jobs.bucket("customer", 8))
    join = jobs.DeltaJoin(spark, "lookup", root, ["user_id"], WITHOUT_DEVICE)

    def handle(batch: DataFrame, batch_id: Batch) -> None:
        batch = batch.persist()
        try:
            new = changelog.images(of_feed(batch, "fact"))
            moved = []  # the dimension's changes, if it has any in this batch

            def looked_up(changed: DataFrame | None, number: Batch) -> None:
                moved.append(True)
                join.apply(new, None if changed is None else device_info(changed), number, result.apply)

            dimension = jobs.LedgerMart(spark, DEVICE_OF_USER, root, jobs.bucket("user_id", 8), then=(looked_up,))
            dimension.apply(changelog.images(of_feed(batch, "device")), batch_id)
            if not moved:
                looked_up(None, batch_id)
        finally:
            batch.unpersist()

    def run(stream: DataFrame, checkpoint: str) -> None:
        jobs.start(decode_feed(stream, tables), handle, checkpoint).awaitTermination()

    _in_turns(spark, messages, run)
    return result.table().select("customer", "user_id", "dimension_info")


QUERIES: dict[str, Query] = {
    # cleaning
    **{name: _dwd(name) for name in dwd.CLEANERS if name != "user_online_status_record"},
    "dwd_user_online": lambda spark, folder: dwd.user_online_status(load(spark, folder, "online_event")),
    # day and hour marts
    "dws_user_game_day": _mart(dws.USER_GAME_DAY),
    "dws_user_game_hour": _mart(dws.USER_GAME_HOUR, "game_event"),
    "dws_channel_game_category": _mart(dws.CHANNEL_GAME_CATEGORY),
    "dws_channel_game_provider": _mart(dws.CHANNEL_GAME_PROVIDER),
    "dws_channel_game": _mart(dws.CHANNEL_GAME),
    "dws_user_custom_amount": _mart(dws.USER_CUSTOM_AMOUNT),
    "dws_channel_custom_amount": _mart(dws.CHANNEL_CUSTOM_AMOUNT),
    "dws_user_withdraw": _mart(dws.USER_WITHDRAW),
    "dws_channel_withdraw": _mart(dws.CHANNEL_WITHDRAW),
    "dws_channel_withdraw_strict_first": _mart(dws.channel_withdraw(strict_first=True)),
    "dws_finance_increment": _finance,
    "dws_user_recharge": _mart(dws.USER_RECHARGE),
    "dws_channel_recharge": _mart(dws.CHANNEL_RECHARGE),
    "dws_channel_proxy": _mart(dws.CHANNEL_PROXY),
    "dws_user_reward": _mart(dws.USER_REWARD),
    "dws_channel_reward": _mart(dws.CHANNEL_REWARD),
    "dws_channel_activity": _mart(dws.CHANNEL_ACTIVITY),
    # roll-ups of the shared user-level aggregate
    "rollup_user_game_day": _rolled_up(dws.USER_GAME_DAY.name),
    "rollup_channel_game_category": _rolled_up(dws.CHANNEL_GAME_CATEGORY.name),
    "rollup_channel_game": _rolled_up(dws.CHANNEL_GAME.name),
    # application marts
    "ads_user_game_day": _over_user_games(ads.USER_GAME_DAY),
    "ads_user_game_total": _over_user_games(ads.USER_GAME_TOTAL),
    "ads_user_reward_day": _mart(ads.USER_REWARD_DAY),
    "ads_user_reward_total": _mart(ads.USER_REWARD_TOTAL),
    "ads_user_bounty_day": _bounty(by_day=True, compute=False),
    "ads_user_bounty_total": _bounty(by_day=False, compute=False),
    "ads_user_bounty_day_computed": _bounty(by_day=True, compute=True),
    "ads_user_bounty_total_computed": _bounty(by_day=False, compute=True),
    # change topics
    "ods_game_record": _topic("flink_game_order_data_sync", "game_event"),
    "ods_recharge_order": _topic("flink_recharge_order_data_sync"),
    "ods_withdraw_order": _topic("flink_withdraw_order_data_sync"),
    "ods_third_withdraw_payment_order": _topic("flink_third_withdraw_payment_order_data_sync"),
    "ods_user_proxy_statistic": _topic("flink_user_proxy_statistic_data_sync"),
    "ods_amount_operation_record": _topic("flink_amount_operation_record_data_sync"),
    "ods_change_pairs": _topic_as_pairs,
    # change topics of the cleaned tables
    "dwd_topic_game_record": _cleaned_topic("dwd_game_record", "game_event", schemas.GAME_RECORD),
    "dwd_topic_recharge_order": _cleaned_topic("dwd_recharge_order", "recharge_order", schemas.RECHARGE_ORDER),
    "dwd_topic_withdraw_order": _cleaned_topic("dwd_withdraw_order", "withdraw_order", schemas.WITHDRAW_ORDER),
    "dwd_topic_amount_operation_record": _cleaned_topic(
        "dwd_amount_operation_record", "amount_operation_record", schemas.AMOUNT_OPERATION_TOPIC
    ),
    "dwd_topic_user_proxy_statistic": _cleaned_topic(
        "dwd_user_proxy_statistic", "user_proxy_statistic", schemas.USER_PROXY_STATISTIC
    ),
    "dwd_topic_reward_record": _reward_topic,
    "ods_changelog_apply": _changelog_apply,
    "ods_row_kinds": _row_kinds,
    "ods_latest_version": _latest_bet,
    "ods_shard_union": _shard_union,
    # dimension copies and landings
    **{f"dim_{table}": _dimension(table) for table in dim.DIMENSIONS},
    "dim_protected_user": _protected_user,
    "dim_user_chunked": _chunked_dimension,
    "game_record_landing": _game_landing,
    "reward_record_landing": _reward_landing,
    # codecs, keys, lookups, windows
    "change_json_roundtrip": _json_roundtrip,
    "sink_not_null": _not_null,
    "lookup_user_device": _device,
    "decode_order_status": _order_status,
    "decode_game_id": _decoded(GAME_ID, "CAST(1000 + event_id % 5 AS INT)", "game_name"),
    "decode_device_type": _decoded(DEVICE_TYPE, "CAST(event_id % 5 AS INT)", "device_type"),
    "window_login_minute": _login_minutes,
    "window_order_hour": _order_hours,
    # streams
    "stream_channel_game": _ledger_stream(dws.CHANNEL_GAME, "game_event", schemas.GAME_RECORD),
    "stream_user_game_hour": _ledger_stream(
        dws.USER_GAME_HOUR, "game_event", schemas.GAME_RECORD, dws.CHANNEL_GAME_PROVIDER
    ),
    "stream_channel_withdraw": _ledger_stream(
        dws.CHANNEL_WITHDRAW, "withdraw_order", schemas.WITHDRAW_ORDER, part=jobs.MONTH
    ),
    "stream_user_recharge": _ledger_stream(
        dws.USER_RECHARGE, "recharge_order", schemas.RECHARGE_ORDER, part=jobs.MONTH
    ),
    "stream_channel_game_fan_out": _stream_fan_out,
    "stream_channel_game_repeats": _stream_repeats(dws.CHANNEL_GAME, "game_event", schemas.GAME_RECORD, jobs.DAY),
    "stream_channel_withdraw_repeats": _stream_repeats(
        dws.CHANNEL_WITHDRAW, "withdraw_order", schemas.WITHDRAW_ORDER, jobs.MONTH
    ),
    "stream_restart": _stream_restart,
    "stream_window_order_hour": _stream_order_hours,
    "stream_channel_reward": _reward_stream(dws.CHANNEL_REWARD),
    "stream_channel_activity": _reward_stream(dws.CHANNEL_ACTIVITY),
    "stream_user_reward_total": _reward_stream(ads.USER_REWARD_TOTAL, jobs.bucket("user_id", 16)),
    "stream_upsert_replay": _stream_replay,
    "stream_user_custom_amount": _stream_repeats(
        dws.USER_CUSTOM_AMOUNT, "amount_operation_record", schemas.AMOUNT_OPERATION_TOPIC, jobs.DAY
    ),
    "stream_user_game_ads_day": _chained(ads.USER_GAME_DAY, jobs.DAY),
    "stream_user_game_ads_total": _chained(ads.USER_GAME_TOTAL, jobs.bucket("user_id", 16)),
    "stream_multi_table": _stream_multi_table,
    "stream_lookup_user_device": _stream_lookup,
    "stream_user_reward_expiring": _stream_expiring,
    "stream_finance_increment": _stream_finance,
}
