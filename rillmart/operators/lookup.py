"""Dimension lookup as a join."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillmart.functions.measures import Measure
from rillmart.operators.changelog import META
from rillmart.operators.mart import Mart, by

# What a lookup answers for a user without a device, and without a user id.
NO_DEVICE, UNKNOWN = "no_device", "unknown"


def device_of_user(facts: DataFrame, devices: DataFrame, user: str = "user_id") -> DataFrame:
    """Add ``dimension_info``: the user's device, ``no_device`` or ``unknown``.

    The point lookup takes any one row of the user; here it is pinned to the
    smallest device id.  A user without a row gets ``no_device``, a missing user
    id ``unknown``.  The dimension is folded to one row per user before the join
    and grows with the users, so it is not hinted: the planner broadcasts it only
    below its size threshold and otherwise joins by shuffle with skew splitting.
    """
    per_user = devices.groupBy(F.col("user_id").alias(user)).agg(
        F.concat(F.lit("device_id: "), F.coalesce(F.min("device_id"), F.lit("null"))).alias("device")
    )
    known = facts.where(F.col(user).isNotNull()).join(per_user, user, "left")
    known = known.withColumn("dimension_info", F.coalesce("device", F.lit(NO_DEVICE))).drop("device")
    # rows without a user match nothing and would all meet in one task of the join
    return known.unionByName(facts.where(F.col(user).isNull()).withColumn("dimension_info", F.lit(UNKNOWN)))


#: The smallest device of each user, as a mart that can be kept up from changes.
DEVICE_OF_USER = Mart(
    "device_of_user", "device_users_relations_flat", by("user_id"),
    (Measure("device_id", "min", "device_id", "string"), Measure("devices", "count", "1", "bigint")),
)

#: What stands beside a fact whose user has no device (or that has no user).
WITHOUT_DEVICE = {"dimension_info": f"IF(user_id IS NULL, '{UNKNOWN}', '{NO_DEVICE}')"}


def device_info(devices: DataFrame) -> DataFrame:
    """Rows of ``DEVICE_OF_USER``, signed or not, as ``user_id`` and ``dimension_info``."""
    info = "concat('device_id: ', coalesce(device_id, 'null')) AS dimension_info"
    return devices.where("user_id IS NOT NULL").selectExpr(*(c for c in META if c in devices.columns), "user_id", info)
