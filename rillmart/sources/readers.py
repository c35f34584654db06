"""Readers: change topics, file feeds, snapshots and sharded tables.

Connection settings are always passed in; nothing is read from the environment
and no address or credential has a default.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

START_MODES = ("earliest", "latest")


def kafka_options(servers: str, topic: str, *, start: str, **extra: str) -> dict[str, str]:
    if start not in START_MODES:
        raise ValueError(f"start must be one of {START_MODES}")
    return {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": start, **extra}


def kafka_messages(spark: SparkSession, options: Mapping[str, str]) -> DataFrame:
    """Streaming ``key``, ``value`` and ``offset`` of a topic (needs the Kafka package).

    The start mode only applies to the first run; later runs resume from the
    checkpoint, so offsets are never committed to the broker.
    """
    raw = spark.readStream.format("kafka").options(**options).load()
    return raw.select(
        F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"), "offset"
    )


def file_messages(spark: SparkSession, path: str, *, bytes_per_batch: int | None = None) -> DataFrame:
    """Streaming ``value`` lines of a folder that JSON-lines files arrive in."""
    reader = spark.readStream.format("text")
    if bytes_per_batch:
        reader = reader.option("maxBytesPerTrigger", str(bytes_per_batch))
    return reader.load(path)


def of_table(envelopes: DataFrame, table: str) -> DataFrame:
    """The changes of one table of a multi-table feed."""
    return envelopes.where(F.col("table") == table)


def jdbc_snapshot(
    spark: SparkSession,
    url: str,
    table: str,
    *,
    key: str,
    bounds: tuple[int, int],
    partitions: int,
    properties: Mapping[str, str] | None = None,
) -> DataFrame:
    """Table snapshot read in parallel key ranges instead of one long scan."""
    low, high = bounds
    return spark.read.jdbc(
        url, table, column=key, lowerBound=low, upperBound=high, numPartitions=partitions,
        properties=dict(properties or {}),
    )


def shard_tables(spark: SparkSession, root: str, pattern: str, *, ddl: str | None = None) -> DataFrame:
    """All shard folders under ``root`` that match a glob, in one scan, with ``_shard``.

    A folder is named after its shard, plainly or as ``column=shard``.

    One scan over the glob plans thousands of shards as input files of a single
    node, where a union of one reader per shard would grow the plan with them.
    """
    reader = spark.read.schema(ddl) if ddl else spark.read
    rows = reader.parquet(f"{root}/{pattern}")
    folder = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -2)
    return rows.withColumn("_shard", F.substring_index(folder, "=", -1))


def select_shards(tables: Mapping[str, DataFrame], names: Sequence[str]) -> DataFrame:
    """Union of named shard frames by column name, with ``_shard`` (for JDBC shards)."""
    tagged = [tables[name].withColumn("_shard", F.lit(name)) for name in names]
    out = tagged[0]
    for shard in tagged[1:]:
        out = out.unionByName(shard)
    return out
