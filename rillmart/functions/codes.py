"""Code tables and their decoding."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Integer codes and labels.
GAME_ID = {1001: "KING_GLORY", 1002: "GENSHIN", 1003: "PUBG"}
DEVICE_TYPE = {1: "IOS", 2: "ANDROID", 3: "PC"}
ORDER_STATUS = {0: "PENDING", 1: "PAID", 2: "CANCELLED", 3: "REFUNDED"}

_TITLES = {"game ID": GAME_ID, "device type": DEVICE_TYPE, "order status": ORDER_STATUS}


def decode(code: Column, table: dict[int, str], *, strict: bool = True) -> Column:
    """Label of a code; an unknown code fails the query, or gives NULL when not ``strict``."""
    label = F.lit(None).cast("string")
    if strict:
        title = next((t for t, codes in _TITLES.items() if codes is table), "code")
        message = F.concat(F.lit(f"Invalid {title}: "), code.cast("string"))
        label = F.when(code.isNotNull(), F.raise_error(message))
    for value, name in reversed(table.items()):
        label = F.when(code == value, name).otherwise(label)
    return label
