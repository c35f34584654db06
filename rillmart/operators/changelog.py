"""Change rows: normalisation, signed row images, compaction to current state.

An *envelope* frame has ``op`` (c, u, d or r), the row before and after the
change as structs, and ``pos``, a number that orders the changes of one entity.
An *image* frame has one row per side of a change: ``op``, ``pos``, ``sign``
(−1 for the row that goes, +1 for the row that comes) and the table columns.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CREATE, UPDATE, DELETE, READ = "c", "u", "d", "r"
META = ("op", "pos", "sign")

# Row-kind codes and the operation and sign they stand for.
ROW_KINDS = {
    "+I": (CREATE, 1),
    "-U": (UPDATE, -1),
    "+U": (UPDATE, 1),
    "-D": (DELETE, -1),
}


def _lookup(column: Column, mapping: dict) -> Column:
    pairs = [x for k, v in mapping.items() for x in (F.lit(k), F.lit(v))]
    return F.create_map(*pairs)[column]


def images(envelopes: DataFrame) -> DataFrame:
    """Both sides of every change as signed rows."""
    sides = F.array(
        F.struct(F.lit(-1).alias("sign"), F.col("before").alias("row")),
        F.struct(F.lit(1).alias("sign"), F.col("after").alias("row")),
    )
    return (
        envelopes.select("op", "pos", F.inline(sides))
        .where("row IS NOT NULL")
        .select("op", "pos", "sign", "row.*")
    )


def images_from_row_kinds(rows: DataFrame, kind: str = "row_status", pos: str = "pos") -> DataFrame:
    """Images from flat rows tagged with a row kind (or already with c/u/d/r)."""
    op = {**{k: v[0] for k, v in ROW_KINDS.items()}, **{o: o for o in (CREATE, UPDATE, DELETE, READ)}}
    sign = {**{k: v[1] for k, v in ROW_KINDS.items()}, CREATE: 1, UPDATE: 1, READ: 1, DELETE: -1}
    code = F.col(kind)
    columns = [c for c in rows.columns if c not in (kind, pos)]
    return rows.select(
        _lookup(code, op).alias("op"), F.col(pos).alias("pos"), _lookup(code, sign).alias("sign"), *columns
    ).where("op IS NOT NULL")


def paired(images: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Signed rows put back into change envelopes, one for each key and position.

    Both sides make an update; a side that a filter took away turns it into a create
    or a delete, and a row that changes its key is deleted there and created here.
    Repeated deliveries of a change fall together.
    """
    row = F.struct(*(c for c in images.columns if c not in META))
    sides = images.groupBy(*keys, "pos").agg(
        F.max(F.when(F.col("sign") < 0, row)).alias("before"), F.max(F.when(F.col("sign") > 0, row)).alias("after")
    )
    op = F.when(F.col("before").isNull(), CREATE).when(F.col("after").isNull(), DELETE).otherwise(UPDATE)
    return sides.select(op.alias("op"), "before", "after", "pos")


def upserts(envelopes: DataFrame) -> DataFrame:
    """One row per change: the new row, or the last known row of a delete."""
    row = F.coalesce(F.col("after"), F.col("before")).alias("row")
    return envelopes.select("op", "pos", row).where("row IS NOT NULL").select("op", "pos", "row.*")


def drop_deletes(changes: DataFrame) -> DataFrame:
    """Keep everything but deletes; works on envelopes, images and upserts alike."""
    return changes.where(F.col("op") != DELETE)


def latest(rows: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of every key under ``order``.

    A rank filter of 1 lets the planner keep one row per key and task before the
    shuffle, so a key with very many versions does not pile up in one task.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return rows.withColumn("__rank", F.row_number().over(window)).where("__rank = 1").drop("__rank")


def newest_first(rows: DataFrame) -> list[Column]:
    order = [F.col("pos").desc_nulls_last()]
    return order + ([F.col("sign").desc()] if "sign" in rows.columns else [])


def compact(changes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Latest change per key, deletes included (so that they can be carried on)."""
    return latest(changes, keys, newest_first(changes))


def current_state(changes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Live rows: the latest change per key unless it removed the row."""
    newest = compact(changes, keys)
    gone = F.col("sign") < 0 if "sign" in newest.columns else F.col("op") == DELETE
    return newest.where(~gone).drop(*META)


def as_snapshot(rows: DataFrame, pos: int | Column = -1) -> DataFrame:
    """Tag the rows of a table snapshot as reads that any later change overrides.

    ``pos`` is where the change feed stood when the rows were read.
    """
    number = F.lit(pos) if isinstance(pos, int) else pos
    return rows.select(F.lit(READ).alias("op"), number.cast("bigint").alias("pos"), *rows.columns)


def union_tables(tables: Sequence[DataFrame]) -> DataFrame:
    """Union of same-shaped tables, by column name."""
    return reduce(lambda left, right: left.unionByName(right), tables)


def replicate(snapshot: DataFrame, changes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Snapshot plus later changes, compacted to the live rows."""
    return current_state(union_tables([as_snapshot(snapshot), changes]), keys)


CHUNK, READ_AT = "chunk", "read_at"


def key_chunk(key: str, low: int, width: int) -> Column:
    """Number of the key range a row falls in, ranges of ``width`` keys from ``low`` on."""
    return F.floor((F.col(key) - low) / width).cast("bigint")


def hand_over(
    snapshot: DataFrame, read_at: DataFrame, changes: DataFrame, keys: Sequence[str], chunk: Column
) -> DataFrame:
    """Live rows of a snapshot read in chunks and of the changes that ran beside it.

    ``read_at`` (``chunk``, ``read_at``) says at which position of the feed each chunk
    was read.  A chunk holds everything up to its position: older changes of its keys
    lose, also of keys it does not hold any more, and newer ones win.  Changes of keys
    in no chunk are all taken.
    """
    at = read_at.select(F.col(CHUNK).alias("__chunk"), F.col(READ_AT).alias("__read_at"))

    def placed(rows: DataFrame) -> DataFrame:
        return rows.withColumn("__chunk", chunk).join(at, "__chunk", "left").drop("__chunk")

    read = placed(snapshot).select(*snapshot.columns, F.coalesce("__read_at", F.lit(-1)).alias("__read_at"))
    reads = as_snapshot(read, F.col("__read_at")).drop("__read_at")
    newer = placed(changes).where(F.col("__read_at").isNull() | (F.col("pos") > F.col("__read_at"))).drop("__read_at")
    return current_state(union_tables([reads, newer]), keys)
