"""Incremental jobs: any split, order, repeat or replay of a change log gives the batch result."""

from __future__ import annotations

import datetime as dt
import random
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from rillmart import config, schemas
from rillmart.fixtures.queries import QUERIES
from rillmart.operators import changelog
from rillmart.plans import ads, dwd, dws
from rillmart.streaming import jobs, ledger, windows
from rillmart.streaming.log import Batch, BatchLog

START = dt.datetime(2024, 1, 1, 10)
DDL = "op string, pos bigint, sign int, " + schemas.AMOUNT_OPERATION_TOPIC
RULE = dwd.amount_operation_record


def version(id, rng):
    return dict(
        id=id, user_id=rng.choice([1, 2, 3, None]), type=rng.choice(["INCREASE", "REDUCE"]),
        amount_type=rng.choice(["WITHDRAW", "DEPOSIT", "BONUS", None]),
        amount=rng.choice([D("1.5"), D("20"), None]), balance=None,
        status=rng.choice(["COMPLETE", "COMPLETE", "PENDING"]), create_by=None, update_by=None,
        create_time=START, update_time=START + dt.timedelta(days=rng.choice([0, 1, 2])), channel_id=rng.choice([1, 2]),
    )


def change_log(seed, rows=40):
    """Image rows (op, pos, sign, columns) of random life cycles."""
    rng, out = random.Random(seed), []
    for id in range(rows):
        current, pos = version(id, rng), id * 10
        out.append([("c", pos, 1, current)])
        for _ in range(rng.choice([0, 1, 2])):
            following, pos = version(id, rng), pos + 1
            out.append([("u", pos, -1, current), ("u", pos, 1, following)])
            current = following
        if rng.random() < 0.3:
            out.append([("d", pos + 1, -1, current)])
    return out


def as_frame(spark, changes):
    names = schemas.names(schemas.AMOUNT_OPERATION_TOPIC)
    flat = [(op, pos, sign, *(row[n] for n in names)) for change in changes for op, pos, sign, row in change]
    return spark.createDataFrame(flat, DDL)


def batch_result(spark, changes, mart):
    state = changelog.current_state(as_frame(spark, changes), ["id"])
    return sorted(map(str, mart.build(RULE(state)).collect()))


def table_rows(table, mart):
    return sorted(map(str, table.select(*(n for n, _ in mart.fields())).collect()))


def split(changes, parts, seed):
    shuffled = changes[:]
    random.Random(seed).shuffle(shuffled)
    return [shuffled[i::parts] for i in range(parts)]


@pytest.mark.parametrize("seed,mart", [(1, dws.CHANNEL_CUSTOM_AMOUNT), (2, dws.USER_CUSTOM_AMOUNT)])
def test_ledger_equals_batch_for_any_order_and_replay(spark, seed, mart):
    """Distinct counts, and the least and greatest of values that may go again."""
    changes = change_log(seed)
    job = jobs.LedgerMart(spark, mart, config.scratch(spark, "ledger"), gather=2)
    for batch_id, some in enumerate(split(changes, 4, seed)):
        images = jobs.cleaned_images(as_frame(spark, some), RULE)
        job.apply(images, batch_id)
        if batch_id == 2:
            job.apply(images, batch_id)  # replayed after a failure, when earlier batches are compacted
    assert table_rows(job.table(), mart) == batch_result(spark, changes, mart)
    assert any(f.kind == "whole" for f in job.log._folders(None))


def test_greatest_value_goes(spark):
    mart = dws.USER_CUSTOM_AMOUNT
    job = jobs.LedgerMart(spark, mart, config.scratch(spark, "ledger"))
    last = START + dt.timedelta(hours=5)
    first = START - dt.timedelta(days=3)
    steps = [
        [[life("c", 1, 1)], [life("c", 2, 1, id=2, update_time=last, create_time=first)], [life("c", 3, 1, id=3, update_time=last)]],
        [[life("d", 4, -1, id=3, update_time=last)]],
        [[life("d", 5, -1, id=2, update_time=last, create_time=first)]],
    ]
    seen = []
    for batch_id, changes in enumerate(steps):
        job.apply(jobs.cleaned_images(as_frame(spark, changes), RULE), batch_id)
        seen.append([(r.create_time, r.update_time) for r in job.table().collect()])
    assert seen == [[(first, last)], [(first, last)], [(START, START)]]


def test_two_writers_of_one_mart(spark):
    """Neither run's batches replace or hide the other's, whatever comes first and whoever compacts."""
    mart, changes, root = dws.CHANNEL_CUSTOM_AMOUNT, change_log(8), config.scratch(spark, "ledger")
    one, two = (jobs.LedgerMart(spark, mart, root, gather=2) for _ in range(2))
    for number, some in enumerate(split(changes, 3, 8)):
        images = [jobs.cleaned_images(as_frame(spark, some[k::2]), RULE) for k in range(2)]
        two.apply(images[1], Batch("two", number))
        one.apply(images[0], Batch("one", number))
        one.apply(images[0], Batch("one", number))
    assert table_rows(one.table(), mart) == batch_result(spark, changes, mart)
    two.log.compact(Batch("two", 2))
    two.log.prune()
    assert table_rows(two.table(), mart) == batch_result(spark, changes, mart)


def test_rows_read_and_written_do_not_grow_with_the_batches(spark):
    mart, read, written = dws.CHANNEL_CUSTOM_AMOUNT, [], []
    job = jobs.LedgerMart(spark, mart, config.scratch(spark, "ledger"), gather=3, then=(lambda rows, n: rows.count(),))
    for number in range(10):  # new rows of the same groups, and of one other
        some = [[life("c", number, 1, id=number * 10 + k, user_id=k % 3, channel_id=k % 2)] for k in range(6)]
        job.apply(jobs.cleaned_images(as_frame(spark, some), RULE), number)
        if number == 4:
            job.apply(jobs.cleaned_images(as_frame(spark, [[life("c", 99, 1, id=999, channel_id=9)]]), RULE), Batch("other", 0))
        parts = [str(START.date())]
        read.append(job.log.before(number + 1, parts).count())
        written.append(job.log.of(number, parts).count())
    assert len(set(written)) == 1 and max(read[6:]) <= max(read[:6]) <= 4 * written[0] + 4
    assert sum(r.custom_increase_count + r.custom_reduction_count for r in job.table().collect()) == 61


@pytest.mark.parametrize("mart,part", [(ads.USER_GAME_DAY, jobs.DAY), (ads.USER_GAME_TOTAL, jobs.bucket("user_id", 2))])
def test_mart_fed_by_a_mart(spark, mart, part):
    """Groups of the first mart that come, change, move to another day and go, with replays."""
    rng, live, changes = random.Random(4), {}, []
    row = lambda i: dict(
        id=i, order_no=i, user_id=i % 3, channel_id=1, game_id=i % 2, game_category_id=1, third_platform_provider_type="A",
        bet_amount=D(rng.randrange(9)), settle_amount=D(rng.randrange(9)), transfer_amount=D(rng.randrange(-5, 5)),
        valid_bet_amount=D(1), effective_bet_flag=rng.choice([0, 1]), status=rng.choice(["settle", "settle", "bet"]),
        update_time=START + dt.timedelta(days=rng.randrange(2)),
    )
    for i in range(25):
        live[i] = row(i)
        changes.append([("c", i, 1, live[i])])
    for pos, i in enumerate(rng.choices(range(25), k=20), start=100):
        if i in live:
            new = None if rng.random() < 0.4 else row(i)
            changes.append([("u" if new else "d", pos, -1, live.pop(i))] + ([("u", pos, 1, new)] if new else []))
            live |= {i: new} if new else {}
    ddl = "op string, pos bigint, sign int, " + schemas.GAME_RECORD

    def frame(some):
        flat = [(op, pos, sign, *(r.get(n) for n in schemas.names(schemas.GAME_RECORD))) for c in some for op, pos, sign, r in c]
        return jobs.cleaned_images(spark.createDataFrame(flat, ddl), dwd.game_record)

    root = config.scratch(spark, "chain")
    second = jobs.LedgerMart(spark, mart, root, part, gather=2)
    first = jobs.LedgerMart(spark, dws.USER_GAME_DAY, root, then=(second.apply,), gather=2)
    for number, some in enumerate(split(changes, 3, 4)):
        for _ in range(1 + (number == 1)):
            first.apply(frame(some), number)
    whole = frame([[("c", 0, 1, r)] for r in live.values()]).drop("op", "pos", "sign")
    expected = mart.build(dws.USER_GAME_DAY.build(whole))
    assert table_rows(second.table(), mart) == table_rows(expected, mart) and expected.count() > 2


# --- joins kept up from changes ---------------------------------------------------------


def signed(spark, rows, columns):
    return spark.createDataFrame(rows, f"op string, pos bigint, sign int, {columns}")


def joined_in_batches(spark, seed, missing):
    """Random changes on both sides, the right one with one row a key at most if rows may miss a partner."""
    rng = random.Random(seed)
    join = jobs.DeltaJoin(spark, "join", config.scratch(spark, "join"), ["k"], missing, buckets=2)
    out = jobs.SignedRows(spark, "out", config.scratch(spark, "out"), "pmod(hash(a), 2)", gather=2)
    left, right = [], {}
    for number in range(4):
        dl, dr = [], []
        for _ in range(rng.choice([0, 6])):
            if left and rng.random() < 0.4:
                dl.append(("d", 0, -1, *left.pop(rng.randrange(len(left)))))
            else:
                left.append((rng.choice([1, 2, 3, None]), rng.randrange(3)))
                dl.append(("c", 0, 1, *left[-1]))
        for k in rng.sample([1, 2, 3, 4], 3):
            for b in right.pop(k, []):
                dr.append(("d", 0, -1, k, b))
            if rng.random() < 0.7:
                right[k] = [f"b{rng.randrange(3)}" for _ in range(1 if missing else rng.choice([1, 2]))]
                dr += [("c", 0, 1, k, b) for b in right[k]]
        for _ in range(1 + (number == 2)):  # one batch is replayed
            join.apply(
                signed(spark, dl, "k int, a int") if dl else None, signed(spark, dr, "k int, b string") if dr else None, number, out.apply
            )
        pairs = [(k, a, b) for k, a in left for b in right.get(k, [])]
        if missing:
            pairs += [(k, a, "nothing") for k, a in left if not right.get(k)]
        got = out.table().select("k", "a", "b").collect() if not out.log.is_empty() else []
        assert sorted(map(tuple, got), key=str) == sorted(pairs, key=str)


@pytest.mark.parametrize("seed", [1, 2])
def test_join_kept_up_from_changes_of_both_sides(spark, seed):
    joined_in_batches(spark, seed, None)


def test_join_keeps_left_rows_without_partner(spark):
    joined_in_batches(spark, 3, {"b": "'nothing'"})


def test_join_reads_only_the_keys_of_the_batch(spark, monkeypatch):
    join = jobs.DeltaJoin(spark, "join", config.scratch(spark, "join"), ["k"], buckets=1)
    join.apply(signed(spark, [("c", 0, 1, k, k) for k in range(500)], "k int, a int"),
               signed(spark, [("c", 0, 1, k, k) for k in range(500)], "k int, b int"), 0, lambda rows, n: None)
    met = []
    matching = jobs._matching
    monkeypatch.setattr(jobs, "_matching", lambda *x: met.append(matching(*x)) or met[-1])
    seen = []
    join.apply(signed(spark, [("c", 1, 1, 7, 99)], "k int, a int"), None, 1, lambda rows, n: seen.extend(map(tuple, rows.collect())))
    assert sum(rows.count() for rows in met if rows is not None) == 1
    assert seen == [("u", 1, 7, 99, 7, 1)]


def life(op, pos, sign, **over):
    row = version(1, random.Random(0)) | dict(status="COMPLETE", user_id=1, channel_id=1, amount=D("5"), update_time=START)
    return (op, pos, sign, {**row, **over})


def test_emptied_day_and_moved_row(spark):
    mart = dws.CHANNEL_CUSTOM_AMOUNT
    job = jobs.LedgerMart(spark, mart, config.scratch(spark, "ledger"))
    later = START + dt.timedelta(days=1)
    steps = [
        [[life("c", 1, 1)]],
        [[life("u", 2, -1), life("u", 2, 1, update_time=later)]],  # to another day
        [[life("u", 3, -1, update_time=later), life("u", 3, 1, update_time=later, status="PENDING")]],  # out of the filter
    ]
    seen = []
    for batch_id, changes in enumerate(steps):
        job.apply(jobs.cleaned_images(as_frame(spark, changes), RULE), batch_id)
        seen.append(sorted(r.statistic_time for r in job.table().collect()))
    assert seen == [[START.date()], [later.date()], []]


def test_sink_gets_changed_groups_only(spark):
    seen = []
    sink = lambda df: seen.append(sorted((r.op, r.channel_id, r.custom_increase_count) for r in df.collect()))
    job = jobs.LedgerMart(spark, dws.CHANNEL_CUSTOM_AMOUNT, config.scratch(spark, "ledger"), sink=sink)
    up = dict(type="INCREASE")
    steps = [
        [[life("c", 1, 1, **up)], [life("c", 2, 1, id=2, channel_id=2, **up)]],
        [[life("d", 3, -1, id=2, channel_id=2, **up)]],
    ]
    for batch_id, changes in enumerate(steps):
        job.apply(jobs.cleaned_images(as_frame(spark, changes), RULE), batch_id)
    assert seen == [[("u", 1, 1), ("u", 2, 1)], [("d", 2, None)]]


def test_empty_first_batch_is_harmless(spark):
    mart = dws.CHANNEL_CUSTOM_AMOUNT
    job = jobs.LedgerMart(spark, mart, config.scratch(spark, "ledger"))
    job.apply(jobs.cleaned_images(as_frame(spark, [[life("c", 1, 1, status="PENDING")]]), RULE), 0)
    job.apply(jobs.cleaned_images(as_frame(spark, [[life("c", 1, 1)]]), RULE), 1)
    assert job.table().count() == 1


def test_retracted_amounts_return_to_missing(spark):
    mart = dws.CHANNEL_WITHDRAW
    images = spark.createDataFrame(
        [(1, D("7"), 1), (1, D("7"), -1), (2, None, 1)], "id bigint, withdraw_funds_amount decimal(20,4), sign int"
    )
    for n, t in schemas.fields(schemas.DWD_WITHDRAW_ORDER):
        if n not in images.columns:
            images = images.withColumn(n, F.lit(None).cast(t))
    settled = ledger.settle(ledger.combine(ledger.contributions(images, mart, "'all'"), mart), mart).first()
    assert settled.withdraw_amount is None and settled.handling_fee == D("0.0000")


def test_compaction_keeps_content_and_later_batches(spark):
    log = BatchLog(spark, config.scratch(spark, "log"), lambda df: df.groupBy("part", "k").agg(F.sum("v").alias("v")))
    for number in range(3):
        log.append(spark.createDataFrame([("p", 1, number + 1), (f"q{number}", 2, 5)], "part string, k int, v bigint"), number)
        if number == 1:
            assert log.compact(1) == ["p"] and log.compact(1) == []
    got = {(r.part, r.k): r.v for r in log.read().collect()}
    assert got == {("p", 1): 6, ("q0", 2): 5, ("q1", 2): 5, ("q2", 2): 5}
    assert [r.v for r in log.read(["p"]).collect()] == [6]
    assert log.prune() == 2  # two batches of p
    assert {(r.part, r.k): r.v for r in log.read().collect()} == got
    assert log.compact(2, least=3) == [] and log.compact(2, ["p"]) == ["p"] and log.prune() == 2
    assert {(r.part, r.k): r.v for r in log.read().collect()} == got
    assert log.expire(["q2"]) == 1
    assert {r.part for r in log.read().collect()} == {"p", "q0", "q1"}


def test_readers_keep_what_they_planned(spark):
    log = BatchLog(spark, config.scratch(spark, "log"), lambda df: df.groupBy("part").agg(F.sum("v").alias("v")))
    add = lambda v, number: log.append(spark.createDataFrame([("p", v)], "part string, v bigint"), number)
    add(1, 0)
    add(2, 1)
    planned = log.entries()
    log.compact(1)
    add(4, 2)
    assert sorted(r.v for r in planned.collect()) == [1, 2] and [r.v for r in log.read().collect()] == [7]


def test_reads_list_only_the_folders_of_their_parts(spark):
    log = BatchLog(spark, config.scratch(spark, "log"), lambda df: df)
    names = ["007", "1D", "a=b", "x*[y]{z}", "2024-01-01"]
    log.append(spark.createDataFrame([(n, k) for k, n in enumerate(names)], "part string, v int"), 0)
    assert {(r.part, r.v) for r in log.read().collect()} == {(n, k) for k, n in enumerate(names)}
    for k, n in enumerate(names):
        one = log.read([n])
        assert [r.v for r in one.collect()] == [k] and len(one.inputFiles()) == 1


def test_batch_numbers_of_another_run_do_not_meet(spark):
    log = BatchLog(spark, config.scratch(spark, "log"), lambda df: df.groupBy("part").agg(F.sum("v").alias("v")))
    add = lambda v, batch: log.append(spark.createDataFrame([("p", v)], "part string, v bigint"), batch)
    add(1, Batch("a", 0))
    add(2, Batch("a", 1))
    add(10, Batch("b", 0))  # a new checkpoint counts from 0 again
    assert [r.v for r in log.read().collect()] == [13]
    log.tidy(Batch("a", 1), ["p"], least=1)  # only what lies before the batch, which may be replayed
    add(2, Batch("a", 1))
    log.compact(Batch("a", 1))
    add(20, Batch("b", 1))
    assert [r.v for r in log.read().collect()] == [33]
    log.prune()
    assert [r.v for r in log.read().collect()] == [33]


@pytest.mark.parametrize("seed", [5, 6])
def test_differences_stand_repeats_replays_and_missing_befores(spark, seed):
    mart, changes = dws.CHANNEL_CUSTOM_AMOUNT, change_log(seed)
    root = config.scratch(spark, "differences")
    rows = jobs.RowTable(spark, "rows", ["id"], root, jobs.bucket("id", 2), gather=2)
    job = jobs.LedgerMart(spark, mart, root)
    for number, some in enumerate(split(changes + changes[::2], 3, seed)):
        images = as_frame(spark, some)
        # one row a change: the new row, or that of a delete
        upserts = images.where("sign > 0 OR op = 'd'").drop("sign")
        for _ in range(2):  # replayed after a failure
            job.apply(jobs.cleaned_images(rows.differences(upserts, Batch("r", number)), RULE), Batch("r", number))
    assert table_rows(job.table(), mart) == batch_result(spark, changes, mart)


def test_stream_end_to_end(spark, small):
    from rillmart.fixtures.oracle import ORACLES
    from tests.checking import compare, connect

    name = "stream_upsert_replay"
    assert compare(QUERIES[name](spark, small), connect(small), ORACLES[name]) == []


def test_window_counts_stream_in_append_mode(spark):
    root = config.scratch(spark, "window")
    rows = [(f"2024-01-01 10:{m:02d}:00",) for m in (1, 1, 2)] + [("2024-01-01 12:00:00",)]
    spark.createDataFrame(rows, "t string").coalesce(1).write.json(f"{root}/in")
    stream = spark.readStream.schema("t string").json(f"{root}/in").select(F.col("t").cast("timestamp").alias("online_time"))
    query = (
        windows.login_counts(stream, lateness=windows.LATENESS).writeStream.outputMode("append").format("memory")
        .queryName("logins").option("checkpointLocation", f"{root}/progress").trigger(availableNow=True).start()
    )
    query.awaitTermination()
    got = {str(r.window_start): r.login_count for r in spark.table("logins").collect()}
    assert got["2024-01-01 10:01:00"] == 2 and got["2024-01-01 10:02:00"] == 1
    assert windows.late_rows(query) == 0


def test_late_rows_are_left_out_and_counted(spark):
    root = config.scratch(spark, "late")

    def turn(*times):
        spark.createDataFrame([(f"2024-01-01 {t}",) for t in times], "t string").coalesce(1).write.mode("append").json(f"{root}/in")
        stream = spark.readStream.schema("t string").json(f"{root}/in").select(F.col("t").cast("timestamp").alias("online_time"))
        counted = windows.login_counts(stream, lateness=windows.LATENESS)
        sink = counted.writeStream.outputMode("append").format("parquet").option("path", f"{root}/out")
        query = sink.option("checkpointLocation", f"{root}/progress").trigger(availableNow=True).start()
        query.awaitTermination()
        return windows.late_rows(query)

    assert turn("10:00:01", "10:00:30", "10:30:00") == 0
    assert turn("10:00:59", "10:27:00") == 1  # the first minute is closed, 10:27 is not
    assert turn("11:00:00") == 0
    got = {str(r.window_start)[11:16]: r.login_count for r in spark.read.parquet(f"{root}/out").collect()}
    assert got == {"10:00": 2, "10:27": 1, "10:30": 1}


def test_expired_keys_start_from_nothing(spark):
    hour = lambda h: START + dt.timedelta(hours=h)
    rows = [(1, hour(0), 1), (1, hour(30), 2), (1, hour(70), 4), (2, hour(0), 8), (2, hour(36), 16), (3, hour(200), 32)]
    frame = spark.createDataFrame(rows, "user_id int, update_time timestamp_ntz, v int")
    out = windows.expired_totals(frame, ["user_id"], "update_time", [F.sum("v").alias("v")])
    assert sorted((r.user_id, r.first_change, r.last_change, r.v) for r in out.collect()) == [
        (1, hour(0), hour(30), 3), (1, hour(70), hour(70), 4), (2, hour(0), hour(36), 24), (3, hour(200), hour(200), 32)
    ]
