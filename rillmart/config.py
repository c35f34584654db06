"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the library is tuned for; a cluster sets its own sizes and keeps the rest.
RECOMMENDED = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.optimizer.windowGroupLimitThreshold": "1000",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}

CHECKPOINT_DIR = "spark.checkpoint.dir"


def session(name: str = "rillmart", *, cores: int | str = "*", shuffle_partitions: int = 8, **extra: str) -> SparkSession:
    """A local session with the recommended settings (tests, benchmarks)."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(name)
    settings = {
        **RECOMMENDED,
        "spark.sql.shuffle.partitions": str(shuffle_partitions),
        "spark.ui.enabled": "false",
        **extra,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch(spark: SparkSession, purpose: str) -> str:
    """A new folder name under the shared folder the session names.

    A cluster names the folder in ``spark.checkpoint.dir``.  Where it is unset a
    local session (tests) gets a temporary folder of this machine; any other
    session is refused, as its executors would write to disks of their own.
    """
    shared = spark.conf.get(CHECKPOINT_DIR, None) or spark.sparkContext.getConf().get(CHECKPOINT_DIR)
    if not shared:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError(f"set {CHECKPOINT_DIR} to a folder that all executors share")
        shared = tempfile.mkdtemp(prefix="rillmart-")
    return f"{shared.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
