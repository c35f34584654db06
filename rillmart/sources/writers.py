"""Writers: change topics and keyed database tables."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql.streaming import DataStreamWriter


def kafka_sink(messages: DataFrame, servers: str, topic: str, checkpoint: str, **extra: str) -> DataStreamWriter:
    """Streaming writer of ``key``/``value`` messages (needs the Kafka package)."""
    return (
        messages.writeStream.format("kafka")
        .options(**{"kafka.bootstrap.servers": servers, "topic": topic, **extra})
        .option("checkpointLocation", checkpoint)
    )


def file_sink(messages: DataFrame, path: str, checkpoint: str) -> DataStreamWriter:
    """Streaming writer of one JSON line per message; a batch commits exactly once."""
    return (
        messages.select("value").writeStream.format("text")
        .option("path", path).option("checkpointLocation", checkpoint).outputMode("append")
    )


def upsert_statement(table: str, columns: Sequence[str], keys: Sequence[str], dialect: str) -> str:
    """Keyed insert-or-update with positional parameters."""
    if dialect == "mysql":
        mark, quote = "%s", "`"
    elif dialect == "ansi":
        mark, quote = "?", '"'
    else:
        raise ValueError(f"unknown dialect: {dialect!r}")
    q = lambda name: f"{quote}{name}{quote}"
    head = f"INSERT INTO {q(table)} ({', '.join(map(q, columns))}) VALUES ({', '.join([mark] * len(columns))})"
    rest = [c for c in columns if c not in keys]
    if dialect == "mysql":
        updates = ", ".join(f"{q(c)} = VALUES({q(c)})" for c in rest or keys)
        return f"{head} ON DUPLICATE KEY UPDATE {updates}"
    target = ", ".join(map(q, keys))
    updates = ", ".join(f"{q(c)} = excluded.{q(c)}" for c in rest)
    return f"{head} ON CONFLICT ({target}) DO " + (f"UPDATE SET {updates}" if updates else "NOTHING")


def delete_statement(table: str, keys: Sequence[str], dialect: str) -> str:
    mark, quote = ("%s", "`") if dialect == "mysql" else ("?", '"')
    same = f"{{}} <=> {mark}" if dialect == "mysql" else f"{{}} IS NOT DISTINCT FROM {mark}"  # keys may be NULL
    where = " AND ".join(same.format(f"{quote}{k}{quote}") for k in keys)
    return f"DELETE FROM {quote}{table}{quote} WHERE {where}"


@dataclass(frozen=True)
class KeyedTableWriter:
    """Keyed upserts into a database table, in buffered and retried batches.

    ``connect`` opens a DB-API connection inside the task.  Every partition
    writes its own batches, and ``writers`` bounds how many do so at a time.
    Rows whose ``op`` is ``d`` delete their key.  Each batch holds one row per key,
    as the marts and compacted tables give it; repeated keys are refused, because a
    shuffle keeps no order among them.  The statements are keyed, so a retried task
    or a replayed batch leaves the same rows.
    """

    connect: Callable[[], Any]
    table: str
    keys: Sequence[str]
    dialect: str = "mysql"
    buffer_rows: int = 5000
    writers: int = 3
    retries: int = 3
    pause: float = 1.0

    def __call__(self, rows: DataFrame) -> None:
        columns = [c for c in rows.columns if c != "op"]
        upsert = upsert_statement(self.table, columns, self.keys, self.dialect)
        delete = delete_statement(self.table, self.keys, self.dialect)
        rows.repartition(self.writers, *self.keys).sortWithinPartitions(*self.keys).foreachPartition(
            lambda part: self._write(part, columns, upsert, delete)
        )

    def _write(self, part: Iterable, columns: Sequence[str], upsert: str, delete: str) -> None:
        buffer: list[tuple[str, tuple]] = []
        last = None
        for row in part:
            values = row.asDict()
            key = tuple(values[k] for k in self.keys)
            if key == last:
                raise ValueError(f"two rows for the key {key} in one batch; compact it first")
            last = key
            if values.get("op") == "d":
                buffer.append((delete, key))
            else:
                buffer.append((upsert, tuple(values[c] for c in columns)))
            if len(buffer) >= self.buffer_rows:
                self._flush(buffer)
                buffer = []
        if buffer:
            self._flush(buffer)

    def _flush(self, buffer: list[tuple[str, tuple]]) -> None:
        for attempt in range(self.retries + 1):
            try:
                connection = self.connect()
                try:
                    cursor = connection.cursor()
                    for statement in dict.fromkeys(s for s, _ in buffer):
                        cursor.executemany(statement, [v for s, v in buffer if s == statement])
                    connection.commit()
                finally:
                    connection.close()
                return
            except Exception:
                if attempt == self.retries:
                    raise
                time.sleep(self.pause)


def jdbc_append(rows: DataFrame, url: str, table: str, properties: Mapping[str, str], *, batch_rows: int = 5000, writers: int = 3) -> None:
    """Plain JDBC append for staging tables: batched inserts over a bounded number of writers."""
    (
        rows.coalesce(writers).write.mode("append")
        .option("batchsize", batch_rows).option("isolationLevel", "READ_COMMITTED")
        .jdbc(url, table, properties=dict(properties))
    )
