"""Micro-batch jobs: change streams to maintained tables.

``LedgerMart`` maintains a mart from signed rows and works on the groups of the
batch only; it can hand the groups' old and new rows on, so that marts are fed by
marts.  ``RowTable`` keeps current rows by key: it serves dimension copies, and
turns repeated or unordered deliveries into the exact signed rows that a
``LedgerMart`` wants.  ``SignedRows`` keeps any signed rows, and ``DeltaJoin``
joins two sides of them from what changes.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from rillmart.operators.changelog import META, UPDATE, compact, current_state
from rillmart.operators.mart import Mart
from rillmart.streaming import ledger
from rillmart.streaming.log import PART, Batch, BatchLog, batch, part_of, running, touched_parts

Handler = Callable[[DataFrame, Batch | int], None]

# Folders of a part that may gather before its finished batches are added up.
GATHER = 8

# Part expressions: a part is what a batch lists and reads of its table.
# Days suit tables with much data per day, months long thin histories.
DAY = "CAST(statistic_time AS STRING)"
MONTH = "substring(CAST(statistic_time AS STRING), 1, 7)"


def bucket(column: str, buckets: int) -> str:
    """Part expression for tables without a day: a hash bucket of the key."""
    return f"pmod(hash({column}), {buckets})"


def cleaned_images(images: DataFrame, clean: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Apply a cleaning rule to both sides of every change.

    A row that leaves the filter keeps only its −1 side, a row that enters it only
    its +1 side, so marts see exactly the rows the rule lets through.
    """
    # the rules select declared columns, so the change columns travel as one struct
    tagged = images.withColumn("__change", F.struct(*META))
    rows = clean(tagged, keep=["__change"])
    return rows.select("__change.*", *(c for c in rows.columns if c != "__change"))


@dataclass(frozen=True)
class LedgerMart:
    """Incremental mart over signed cleaned rows, each wanted exactly once, in any order.

    Several streams may write the same mart; its table adds up what all have logged.
    A mart that hands its changes on must have one writer, as another's rows are only
    seen once they are logged.
    """

    spark: SparkSession
    mart: Mart
    root: str
    part: str = DAY
    # receives the changed groups of every batch, for example a ``KeyedTableWriter``
    sink: Callable[[DataFrame], None] | None = None
    # receive the signed old and new rows of the changed groups, for example other marts' ``apply``
    then: Sequence[Handler] = ()
    gather: int = GATHER

    @property
    def log(self) -> BatchLog:
        return BatchLog(
            self.spark, f"{self.root}/{self.mart.name}/ledger", lambda rows: ledger.combine(rows, self.mart)
        )

    def apply(self, images: DataFrame, batch_id: Batch | int) -> None:
        delta = ledger.contributions(images, self.mart, self.part).persist()
        try:
            parts = touched_parts(delta)
            if not parts:
                return
            self.log.tidy(batch_id, parts, least=self.gather)
            if self.then or self.sink:
                changed = self.changes(delta, batch_id, parts).persist()
                try:
                    for target in self.then:
                        target(changed, batch_id)
                    if self.sink:
                        self.sink(upserts(changed, list(self.mart.keys)))
                finally:
                    changed.unpersist()
            self.log.append(delta, batch_id)
        finally:
            delta.unpersist()

    def changes(self, delta: DataFrame, batch_id: Batch | int, parts: Sequence[str]) -> DataFrame:
        """Signed old and new rows of the groups a batch changes; only their ledger rows are settled.

        The old rows leave the batch itself out, so a replay gives the same changes.
        """
        names = [n for n, _ in self.mart.fields()]
        key = F.struct(PART, *self.mart.keys).alias("__key")
        stored = self.log.before(batch_id, parts)
        new = delta
        sides = []
        if stored is not None:
            touched = delta.select(key).distinct()
            stored = stored.withColumn("__key", key).join(touched, "__key", "left_semi").drop("__key")
            new = stored.unionByName(delta)
            sides.append(ledger.settle(stored, self.mart).withColumn("sign", F.lit(-1)))
        sides.append(ledger.settle(new, self.mart).withColumn("sign", F.lit(1)))
        rows = sides[0] if len(sides) == 1 else sides[0].unionByName(sides[1])
        rows = rows.groupBy(*names).agg(F.sum("sign").cast("int").alias("sign")).where("sign <> 0")
        return rows.select(F.lit(UPDATE).alias("op"), F.lit(batch(batch_id).number).cast("bigint").alias("pos"), "sign", *names)

    def table(self) -> DataFrame:
        return ledger.settle(self.log.entries(), self.mart).drop(PART)


def upserts(changed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """For a keyed sink: ``op`` u with the new row of a group, or d if it is gone."""
    rows = [c for c in changed.columns if c not in (*META, *keys)]
    newest = changed.groupBy(*keys).agg(
        F.max("sign").alias("__sign"), F.max_by(F.struct(*rows), "sign").alias("__row")
    )
    here = F.col("__sign") > 0
    return newest.select(
        F.when(here, "u").otherwise("d").alias("op"), *keys, *(F.when(here, F.col(f"__row.{c}")).alias(c) for c in rows)
    )


@dataclass(frozen=True)
class RowTable:
    """Current rows by key, fed by change rows in any order and any number of deliveries."""

    spark: SparkSession
    name: str
    keys: Sequence[str]
    root: str
    part: str = DAY
    # declared columns, for readers that come before the first change
    ddl: str | None = None
    gather: int = GATHER

    @property
    def log(self) -> BatchLog:
        # a row that moves to another day leaves a −1 there, so keys are compacted per part
        return BatchLog(
            self.spark, f"{self.root}/{self.name}/rows", lambda rows: compact(rows, [PART, *self.keys])
        )

    def apply(self, changes: DataFrame, batch_id: Batch | int) -> list[str]:
        """Store the batch and return the parts it touched."""
        tagged = changes.withColumn(PART, part_of(self.part))
        delta = compact(tagged, [PART, *self.keys]).persist()
        try:
            parts = touched_parts(delta)
            if parts:
                self.log.tidy(batch_id, parts, least=self.gather)
                self.log.append(delta, batch_id)
            return parts
        finally:
            delta.unpersist()

    def differences(self, changes: DataFrame, batch_id: Batch | int) -> DataFrame:
        """Store the batch and return what it changes, as exact signed images for a ``LedgerMart``.

        Each key's newest change of the batch is compared with the stored row: a
        change that is not newer (a repeated or late delivery) gives nothing, any
        other the stored row with −1 and the new one with +1, so updates need not
        carry the row before.  Only keys of the batch are read back.  The part must
        depend on the key alone.  A replayed batch is compared with the state without
        it.
        """
        keys = [PART, *self.keys]
        delta = compact(changes.withColumn(PART, part_of(self.part)), keys).persist()
        rows = [c for c in delta.columns if c not in (*keys, *META)]
        try:
            parts = touched_parts(delta)
            if parts:
                self.log.tidy(batch_id, parts, least=self.gather)
                self.log.append(delta, batch_id)
        finally:
            delta.unpersist()
        if not parts:
            return changes.where(F.lit(False)).withColumn("sign", F.lit(1)).select(*META, *(c for c in changes.columns if c not in META))
        logged = self.log.of(batch_id, parts)
        stored = self.log.before(batch_id, parts)
        new = logged.select(*keys, F.struct("op", "pos", *rows).alias("new"))
        if stored is None:
            pairs = new.withColumn("old", F.lit(None).cast(new.schema["new"].dataType))
        else:
            same = [F.col(f"n.{k}").eqNullSafe(F.col(f"o.{k}")) for k in keys]
            stored = stored.alias("o").join(logged.alias("n"), same, "left_semi")
            old = compact(stored, keys).select(*keys, F.struct("op", "pos", *rows).alias("old"))
            pairs = new.alias("n").join(old.alias("o"), same, "left").select("n.*", "o.old")
            pairs = pairs.where(F.col("old").isNull() | (F.col("new.pos") > F.col("old.pos")))
        sides = F.array(
            F.struct(F.lit(-1).alias("sign"), F.col("old").alias("row")), F.struct(F.lit(1).alias("sign"), F.col("new").alias("row"))
        )
        images = pairs.select(*self.keys, F.col("new.op").alias("op"), F.col("new.pos").alias("pos"), F.inline(sides))
        images = images.where("row IS NOT NULL AND row.op <> 'd'")
        return images.select("op", "pos", "sign", *self.keys, *(F.col(f"row.{c}") for c in rows)).select(*META, *(
            c for c in changes.columns if c not in META
        ))

    def current(self, parts: Sequence[str] | None = None) -> DataFrame:
        """Live rows of the given parts, with ``part``."""
        if self.ddl and self.log.is_empty():
            return self.spark.createDataFrame([], f"{self.ddl}, {PART} string")
        return current_state(self.log.read(parts), [PART, *self.keys])


@dataclass(frozen=True)
class SignedRows:
    """Rows with how often each is there, kept up from signed rows; ``part`` is SQL over their columns."""

    spark: SparkSession
    name: str
    root: str
    part: str
    gather: int = GATHER

    @property
    def log(self) -> BatchLog:
        return BatchLog(self.spark, f"{self.root}/{self.name}/signed", lambda rows: added_up(rows))

    def delta(self, images: DataFrame) -> DataFrame:
        """What a batch changes: distinct rows with their part and the sum of their signs."""
        rows = images.drop("op", "pos").withColumn(PART, part_of(self.part))
        return added_up(rows)

    def apply(self, images: DataFrame, batch_id: Batch | int) -> None:
        delta = self.delta(images).persist()
        try:
            parts = touched_parts(delta)
            if parts:
                self.log.tidy(batch_id, parts, least=self.gather)
                self.log.append(delta, batch_id)
        finally:
            delta.unpersist()

    def table(self) -> DataFrame:
        """Every row as often as it is there."""
        rows = self.log.read().where("sign > 0").withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("sign"))))
        return rows.drop(PART, "sign", "__copy")


def added_up(rows: DataFrame) -> DataFrame:
    columns = [c for c in rows.columns if c != "sign"]
    return rows.groupBy(*columns).agg(F.sum("sign").cast("int").alias("sign")).where("sign <> 0")


@dataclass(frozen=True)
class DeltaJoin:
    """Join of two sides of signed rows on equal keys, kept up from what changes on either side.

    The changes of the left side meet the new right side, the changes of the right
    side the old left side, so a pair that changes on both sides counts once.  Only
    rows of the batch's keys are joined.  Beside the keys the sides share no column.
    With ``missing`` (SQL for each right column) left rows without a partner stay.
    """

    spark: SparkSession
    name: str
    root: str
    keys: Sequence[str]
    missing: Mapping[str, str] | None = None
    buckets: int = 8

    def side(self, which: str) -> SignedRows:
        part = f"pmod(hash({', '.join(self.keys)}), {self.buckets})"
        return SignedRows(self.spark, f"{self.name}_{which}", self.root, part)

    def apply(self, left: DataFrame | None, right: DataFrame | None, batch_id: Batch | int, then: Handler) -> None:
        """Hand the signed pairs that the changes of the sides make or undo to ``then`` (None: a side without changes).

        Rows with a NULL key have no partner; on the left, with ``missing``, they stay.
        """
        sides = {"left": left, "right": right}
        logs = {n: self.side(n) for n in sides}
        deltas = {n: logs[n].delta(rows).persist() for n, rows in sides.items() if rows is not None}
        try:
            parts = sorted({p for d in deltas.values() for p in touched_parts(d)})
            if not parts:
                return
            for n in sides:
                logs[n].log.tidy(batch_id, parts, least=logs[n].gather)
            old = {n: logs[n].log.before(batch_id, parts) for n in sides}
            pairs = self._pairs(deltas.get("left"), deltas.get("right"), old["left"], old["right"])
            if pairs is not None:
                number = F.lit(batch(batch_id).number).cast("bigint").alias("pos")
                pairs = pairs.select(F.lit(UPDATE).alias("op"), number, *pairs.columns).persist()  # marts read them several times
                try:
                    then(pairs, batch_id)
                finally:
                    pairs.unpersist()
            for n, delta in deltas.items():
                logs[n].log.append(delta, batch_id)
        finally:
            for delta in deltas.values():
                delta.unpersist()

    def _pairs(self, dl: DataFrame | None, dr: DataFrame | None, old_l: DataFrame | None, old_r: DataFrame | None) -> DataFrame | None:
        known = lambda rows: None if rows is None else rows.drop(PART).dropna(subset=list(self.keys))
        lone = None if dl is None else dl.drop(PART)
        dl, dr, old_l, old_r = map(known, (dl, dr, old_l, old_r))
        out = []
        if dl is not None:
            new_r = _union(_matching(old_r, dl, self.keys), _matching(dr, dl, self.keys))
            if self.missing is not None:
                # rows with a NULL key match nothing and stay
                out.append(self._joined(lone, None if new_r is None else added_up(new_r), "left"))
            elif new_r is not None:
                out.append(self._joined(dl, added_up(new_r), "inner"))
        if dr is not None and old_l is not None:
            moved = dr
            if self.missing is not None:
                moved = _union(dr, self._filled(dr, _matching(old_r, dr, self.keys)))
            out.append(self._joined(added_up(_matching(old_l, dr, self.keys)), moved, "inner"))
        if not out:
            return None
        return added_up(out[0] if len(out) == 1 else out[0].unionByName(out[1]))

    def _joined(self, left: DataFrame, right: DataFrame | None, how: str) -> DataFrame:
        if right is None:  # nothing was ever on the right
            return left.withColumns({c: F.expr(sql) for c, sql in self.missing.items()})
        right = right.withColumnRenamed("sign", "__sign").withColumn("__here", F.lit(True))
        pairs = left.join(right, list(self.keys), how)
        sign = (F.col("sign") * F.coalesce("__sign", F.lit(1))).cast("int").alias("sign")
        others = [c for c in right.columns if c not in (*self.keys, "__sign", "__here")]
        empty = self.missing or {}
        kept = [F.when(F.col("__here"), F.col(c)).otherwise(F.expr(empty[c])).alias(c) if c in empty else F.col(c) for c in others]
        return pairs.select(*(c for c in left.columns if c != "sign"), *kept, sign)

    def _filled(self, dr: DataFrame, old_r: DataFrame | None) -> DataFrame:
        """The rows that stand for no partner: they go when a key's first partner comes and come when its last one goes."""
        counts = dr.groupBy(*self.keys).agg(F.sum("sign").alias("__moved"))
        if old_r is None:
            counts = counts.withColumn("__before", F.lit(0))
        else:
            counts = counts.join(old_r.groupBy(*self.keys).agg(F.sum("sign").alias("__before")), list(self.keys), "left")
        before, after = F.coalesce("__before", F.lit(0)), F.coalesce("__before", F.lit(0)) + F.col("__moved")
        sign = F.when((before == 0) & (after > 0), -1).when((before > 0) & (after == 0), 1)
        rows = counts.select(*self.keys, *(F.expr(sql).alias(c) for c, sql in self.missing.items()), sign.alias("sign"))
        return rows.where("sign IS NOT NULL")


def _matching(rows: DataFrame | None, other: DataFrame, keys: Sequence[str]) -> DataFrame | None:
    """The rows whose keys the other side has."""
    return None if rows is None else rows.join(other.select(*keys).distinct(), list(keys), "left_semi")


def _union(a: DataFrame | None, b: DataFrame | None) -> DataFrame | None:
    return (b if a is None else a) if a is None or b is None else a.unionByName(b)


def fan_out(prepare: Callable[[DataFrame], DataFrame], *targets: Handler) -> Handler:
    """One prepared batch, several targets: decoded and cleaned once, read by all."""

    def handle(batch: DataFrame, batch_id: Batch | int) -> None:
        rows = prepare(batch).persist()
        try:
            for target in targets:
                target(rows, batch_id)
        finally:
            rows.unpersist()

    return handle


def start(
    stream: DataFrame, handler: Handler, checkpoint: str, *, every: str | None = None
) -> StreamingQuery:
    """Run ``handler`` per micro-batch: everything available now, or on a fixed interval.

    Batches are named after the checkpoint's query id, so a lost or new checkpoint
    over the same tables adds to them and replaces nothing.
    """
    trigger = {"processingTime": every} if every else {"availableNow": True}
    return (
        stream.writeStream.foreachBatch(lambda rows, number: handler(rows, running(rows, number)))
        .option("checkpointLocation", checkpoint).trigger(**trigger).start()
    )
