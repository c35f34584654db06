"""What micro-batches contributed, as plain Parquet folders.

Rows lie by part (an event day, or a bucket of the key), by run and by batch.  A
run is the life of one checkpoint, so a new checkpoint, or a second stream into
the same table, adds folders of its own and meets no others.  Writing a batch
replaces exactly its own folders, so replaying it changes nothing.  A table is
what its rows add up to, whoever wrote them.

``compact`` adds up the finished batches of a run in a folder of its own, named
by the last of them; readers then pass over what it holds.  Nothing that a reader
may have planned is rewritten.  Atomic publishing to readers outside is left to a
table format.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

PART, RUN, BATCH, KIND = "part", "run", "batch", "kind"
ADDED, WHOLE = "added", "whole"
_FOLDERS = {PART: StringType(), RUN: StringType(), BATCH: LongType(), KIND: StringType()}


class Batch(NamedTuple):
    """A micro-batch: the run it belongs to, and its number there."""

    run: str
    number: int


def batch(value: Batch | int) -> Batch:
    """A plain number is a batch of the run ``main``."""
    return value if isinstance(value, Batch) else Batch("main", int(value))


def running(rows: DataFrame, number: int) -> Batch:
    """The batch a stream is handing out: its run is the query id that the checkpoint keeps."""
    return Batch(rows.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId"), number)


def part_of(expr: str) -> Column:
    """Part of a row; rows without a day or key share one named part."""
    return F.coalesce(F.expr(expr).cast("string"), F.lit("none"))


def touched_parts(rows: DataFrame) -> list[str]:
    """Parts named in a batch: calendar days or key buckets, so the list stays small."""
    return [r[PART] for r in rows.select(PART).distinct().collect()]


class Folder(NamedTuple):
    part: str
    run: str
    batch: int
    kind: str
    path: str


@dataclass(frozen=True)
class BatchLog:
    """``combine`` adds up rows of the same identity; it must be safe to apply repeatedly."""

    spark: SparkSession
    path: str
    combine: Callable[[DataFrame], DataFrame]

    def _folders(self, parts: Sequence[str] | None) -> list[Folder]:
        """All folders of the given parts; only those are listed."""
        names = self.spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
        root = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        files = root.getFileSystem(self.spark._jsc.hadoopConfiguration())
        found = []
        for part in ["*"] if parts is None else [names.escapePathName(str(p)) for p in parts]:
            pattern = f"{self.path}/{PART}={part}/{RUN}=*/{BATCH}=*/{KIND}=*"
            for status in files.globStatus(self.spark._jvm.org.apache.hadoop.fs.Path(pattern)) or []:
                path = status.getPath().toString()
                values = [names.unescapePathName(x.split("=", 1)[1]) for x in path.split("/")[-4:]]
                found.append(Folder(values[0], values[1], int(values[2]), values[3], path))
        return found

    @staticmethod
    def _live(folders: Sequence[Folder]) -> list[Folder]:
        """Of each part and run the newest compacted folder, and the batches after it."""
        held: dict[tuple[str, str], int] = {}
        for f in folders:
            if f.kind == WHOLE:
                held[f.part, f.run] = max(f.batch, held.get((f.part, f.run), -1))
        last = lambda f: held.get((f.part, f.run), -1)
        return [f for f in folders if (f.batch == last(f) if f.kind == WHOLE else f.batch > last(f))]

    def _read(self, folders: Sequence[Folder]) -> DataFrame | None:
        if not folders:
            return None
        # folder names are read back as declared, so part names may look like numbers or dates
        data = self.spark.read.parquet(folders[0].path).schema
        fields = [f for f in data if f.name not in _FOLDERS] + [StructField(n, t) for n, t in _FOLDERS.items()]
        rows = self.spark.read.schema(StructType(fields)).option("basePath", self.path)
        return rows.parquet(*(f.path for f in folders)).drop(RUN, BATCH, KIND)

    def _write(self, rows: DataFrame, name: Batch, kind: str) -> None:
        """Replace the named folders of the parts in ``rows``; hot parts are split, small ones merged."""
        named = rows.withColumns({RUN: F.lit(name.run), BATCH: F.lit(name.number).cast("bigint"), KIND: F.lit(kind)})
        (
            named.hint("rebalance", PART)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(*_FOLDERS)
            .parquet(self.path)
        )

    def is_empty(self) -> bool:
        """Whether nothing was ever logged."""
        return not self._folders(None)

    def append(self, rows: DataFrame, batch_id: Batch | int) -> None:
        self._write(rows, batch(batch_id), ADDED)

    def read(self, parts: Sequence[str] | None = None) -> DataFrame:
        """Combined rows of the given parts (all parts by default)."""
        return self.combine(self.entries(parts))

    def entries(self, parts: Sequence[str] | None = None) -> DataFrame:
        """Rows as logged or compacted, for readers that combine them anyway."""
        rows = self._read(self._live(self._folders(parts)))
        if rows is None:
            raise ValueError(f"nothing logged under {self.path}")
        return rows

    def before(self, batch_id: Batch | int, parts: Sequence[str]) -> DataFrame | None:
        """Entries of the parts but those of one batch (None if there are none), for a batch that may be a replay."""
        run, number = batch(batch_id)
        return self._read([f for f in self._live(self._folders(parts)) if (f.run, f.batch, f.kind) != (run, number, ADDED)])

    def of(self, batch_id: Batch | int, parts: Sequence[str]) -> DataFrame | None:
        """What one batch has logged in the parts."""
        run, number = batch(batch_id)
        return self._read([f for f in self._folders(parts) if (f.run, f.batch, f.kind) == (run, number, ADDED)])

    def compact(self, batch_id: Batch | int, parts: Sequence[str] | None = None, *, least: int = 2) -> list[str]:
        """Add up a run's batches, to the given one, in parts with ``least`` folders or more; returns these parts.

        The given batch must be finished: it is never replayed.  Doing it again changes nothing.
        """
        name = batch(batch_id)
        mine = [f for f in self._live(self._folders(parts)) if f.run == name.run and f.batch <= name.number]
        full = {p for p in {f.part for f in mine} if sum(f.part == p for f in mine) >= max(2, least)}
        if full:
            rows = self._read([f for f in mine if f.part in full])
            self._write(self.combine(rows), name, WHOLE)
        return sorted(full)

    def tidy(self, batch_id: Batch | int, parts: Sequence[str], *, least: int) -> None:
        """``compact`` what lies before a batch that is about to run."""
        run, number = batch(batch_id)
        if number > 0:
            self.compact(Batch(run, number - 1), parts, least=least)

    def prune(self) -> int:
        """Delete the folders that compacted ones have replaced; returns how many.

        Run it when no reader still works on a plan made before the compaction.
        """
        folders = self._folders(None)
        return self._delete(set(folders) - set(self._live(folders)))

    def expire(self, parts: Sequence[str]) -> int:
        """Forget the given parts; later changes to them start from nothing, like expired state."""
        return self._delete(self._folders(parts))

    def _delete(self, folders) -> int:
        made = lambda f: self.spark._jvm.org.apache.hadoop.fs.Path(f.path)
        conf = self.spark._jsc.hadoopConfiguration()
        return sum(bool(made(f).getFileSystem(conf).delete(made(f), True)) for f in folders)
