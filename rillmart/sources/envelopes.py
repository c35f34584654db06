"""JSON on the wire: change envelopes and enveloped events, both ways."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillmart import schemas
from rillmart.operators.changelog import CREATE, DELETE, READ, UPDATE, images

CORRUPT = "_corrupt_record"

# JSON layout of wall-clock times on write; reading accepts both.
TIME_STYLES = {"sql": "yyyy-MM-dd HH:mm:ss.SSSSSS", "iso": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


def _parsed(value: str | Column, schema: str) -> Column:
    column = F.col(value) if isinstance(value, str) else value
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    return F.from_json(column.cast("string"), schema, options)


def decode_changes(
    messages: DataFrame, ddl: str, *, value: str = "value", pos: str | None = None, metric: str | None = None
) -> DataFrame:
    """Change envelopes from JSON messages.

    ``pos`` names the transport column that orders the changes (a Kafka offset);
    without it the position comes from the envelope.  Unreadable messages and
    unknown operations are dropped and, with ``metric``, counted.
    """
    row = schemas.row_struct(ddl)
    schema = (
        f"before {row}, after {row}, op string, ts_ms bigint, "
        f"source struct<`table`: string, pos: bigint>, {CORRUPT} string"
    )
    position = [F.col(pos).alias("__pos")] if pos else []
    # as generator output the operation filter stays above the parse, which then runs once
    out = messages.select(*position, F.inline(F.array(_parsed(value, schema)))).select(
        "op",
        "before",
        "after",
        (F.col("__pos") if pos else F.coalesce("source.pos", "ts_ms")).cast("bigint").alias("pos"),
        F.col("source.table").alias("table"),
    )
    known = F.col("op").isin(CREATE, UPDATE, DELETE, READ)
    if metric:
        out = out.observe(metric, F.count_if(~F.coalesce(known, F.lit(False))).alias("unreadable"))
    return out.where(known)


def decode_feed(
    messages: DataFrame, tables: Mapping[str, str], *, value: str = "value", pos: str | None = None, metric: str | None = None
) -> DataFrame:
    """Changes of several tables that share one feed, each message parsed by its own table's columns.

    ``tables`` maps the names in the feed to declared columns.  The result has
    ``table``, ``op``, ``pos`` and one struct of ``before`` and ``after`` for each table,
    NULL for the others; ``of_feed`` picks a table.  Messages of unknown tables and
    unreadable ones are dropped and, with ``metric``, counted apart.
    """
    head = f"op string, ts_ms bigint, source struct<`table`: string, pos: bigint>, {CORRUPT} string"
    position = [F.col(pos).alias("__pos")] if pos else []
    out = messages.select(*position, F.col(value).alias("__value"), F.inline(F.array(_parsed(value, head))))
    name = F.col("source.table")
    known = F.coalesce(name.isin(list(tables)), F.lit(False))
    readable = F.coalesce(F.col("op").isin(CREATE, UPDATE, DELETE, READ), F.lit(False))
    if metric:
        out = out.observe(
            metric,
            F.count_if(readable & ~known).alias("unknown_table"),
            F.count_if(~readable).alias("unreadable"),
        )
    sides = []
    for table, ddl in tables.items():
        row = schemas.row_struct(ddl)
        sides.append(F.when(name == table, _parsed("__value", f"before {row}, after {row}")).alias(table))
    number = (F.col("__pos") if pos else F.coalesce("source.pos", "ts_ms")).cast("bigint").alias("pos")
    return out.where(known & readable).select(name.alias("table"), "op", number, *sides)


def of_feed(decoded: DataFrame, table: str) -> DataFrame:
    """The change envelopes of one table of a decoded feed."""
    rows = decoded.where(F.col("table") == table)
    return rows.select("op", F.col(f"`{table}`.before").alias("before"), F.col(f"`{table}`.after").alias("after"), "pos", "table")


def encode_changes(
    envelopes: DataFrame, keys: Sequence[str], *, style: str = "change", time_style: str = "sql", table: str | None = None
) -> DataFrame:
    """``key`` and ``value`` of change messages; ``table`` is named in them for feeds of several tables.

    ``style="change"`` writes one message per change; ``"pair"`` writes an update
    as a delete and a create.  Messages are keyed by the row key, so all changes
    of a row stay in order in one topic partition.
    """
    if style == "pair":
        flat = images(envelopes)
        columns = [c for c in flat.columns if c not in ("op", "pos", "sign")]
        row = F.struct(*columns)
        gone = F.col("sign") < 0
        envelopes = flat.select(
            F.when(gone, DELETE).otherwise(CREATE).alias("op"),
            F.when(gone, row).alias("before"),
            F.when(~gone, row).alias("after"),
            "pos",
        )
    elif style != "change":
        raise ValueError(f"unknown change style: {style!r}")
    pattern = TIME_STYLES[time_style]
    key = F.to_json(F.struct(*(F.coalesce(f"after.{k}", f"before.{k}").alias(k) for k in keys)))
    source = F.struct("pos") if table is None else F.struct("pos", F.lit(table).alias("table"))
    value = F.to_json(F.struct("before", "after", "op", source.alias("source")), {"timestampNTZFormat": pattern})
    return envelopes.select(key.alias("key"), value.alias("value"))


def decode_events(messages: DataFrame, ddl: str, *, value: str = "value", metric: str | None = None) -> DataFrame:
    """Payload columns of enveloped events (``key``, ``dataSyncType``, nested ``jsonData``).

    An unreadable message is dropped (and counted under ``metric``); a readable
    one keeps its payload even if single fields are missing.
    """
    schema = f"`key` string, dataSyncType string, jsonData {schemas.row_struct(ddl)}, {CORRUPT} string"
    parsed = messages.select(F.inline(F.array(_parsed(value, schema))))
    readable = F.col("jsonData").isNotNull()
    if metric:
        bad = F.col(CORRUPT).isNotNull() | ~readable
        parsed = parsed.observe(metric, F.count_if(bad).alias("unreadable"))
    return parsed.where(readable).select("jsonData.*")


def encode_events(rows: DataFrame, key: str, sync_type: str, *, time_style: str = "iso") -> DataFrame:
    """Messages of enveloped events, the inverse of ``decode_events``."""
    value = F.to_json(
        F.struct(
            F.col(key).cast("string").alias("key"),
            F.lit(sync_type).alias("dataSyncType"),
            F.struct(*rows.columns).alias("jsonData"),
        ),
        {"timestampNTZFormat": TIME_STYLES[time_style]},
    )
    return rows.select(F.col(key).cast("string").alias("key"), value.alias("value"))
