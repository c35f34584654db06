"""Tumbling event-time counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

# Window sizes of the login and order counts.
LOGIN_WINDOW = "1 minute"
ORDER_WINDOW = "1 hour"
LATENESS = "5 minutes"
# Fixed value: how long the state of a key is kept after its last change.
RETENTION = "36 hours"


def tumbling(rows: DataFrame, time: str, size: str, measures: list[Column], *, keys: tuple[str, ...] = (), lateness: str | None = None) -> DataFrame:
    """Aggregates per window (and key).

    On a stream ``lateness`` bounds the state; rows later than that are dropped,
    so it is meant for window counts only and never for the marts.
    """
    if lateness:
        rows = rows.withWatermark(time, lateness)
    grouped = rows.groupBy(F.window(time, size), *keys).agg(*measures)
    columns = [c for c in grouped.columns if c != "window"]
    return grouped.select(
        F.col("window.start").cast("timestamp_ntz").alias("window_start"),
        F.col("window.end").cast("timestamp_ntz").alias("window_end"),
        *columns,
    )


def login_counts(online: DataFrame, *, lateness: str | None = None) -> DataFrame:
    return tumbling(online, "online_time", LOGIN_WINDOW, [F.count(F.lit(1)).alias("login_count")], lateness=lateness)


def order_counts(orders: DataFrame, *, lateness: str | None = None) -> DataFrame:
    measures = [
        F.count(F.lit(1)).alias("order_count"),
        F.sum("order_amount").cast("decimal(20,4)").alias("order_amount"),
    ]
    return tumbling(orders, "update_time", ORDER_WINDOW, measures, lateness=lateness)


def expired_totals(
    rows: DataFrame, keys: list[str], time: str, measures: list[Column], *, retention: str = RETENTION, lateness: str = LATENESS
) -> DataFrame:
    """Totals of each key between silences of ``retention``, with its first and last change.

    A key without a change for that long on the event clock expires: on a stream its
    totals come out once, as they stood, its state goes, and a later change starts
    from nothing.  Keys that may still change are held back.
    """
    timed = rows.withColumn("__time", F.col(time).cast("timestamp")).withWatermark("__time", lateness)
    grouped = timed.groupBy(F.session_window("__time", retention).alias("__life"), *keys).agg(
        F.min("__time").alias("first_change"), F.max("__time").alias("last_change"), *measures
    )
    times = [F.col(c).cast("timestamp_ntz").alias(c) for c in ("first_change", "last_change")]
    return grouped.select(*keys, *times, *(c for c in grouped.columns if c not in ("__life", *keys, "first_change", "last_change")))


def late_rows(query: StreamingQuery) -> int:
    """Rows that the last batches of a stream dropped because their window was closed.

    Counted as Spark does, after the partial aggregation: late rows of a task that
    fall in the same window count once.
    """
    return sum(s.numRowsDroppedByWatermark for p in query.recentProgress for s in p.stateOperators)
