"""Sorted arrays of 64-bit keys: packed for shuffles, kept in files and mapped into memory.

A map task sends each shard one row with its own keys, already combined and
compressed; the shard's task merges the rows it gets and writes one file, so that
neither a hot key nor the number of keys costs a row each.
"""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

from rillmart.llm.common import U64, write_file

PACKED = "shard int, packed binary"


def combine(keys: np.ndarray, values: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, with the sums of their values (of ones, if none are given)."""
    if values is None:
        found, counts = np.unique(keys, return_counts=True)
        return found, counts.astype(np.int64)
    if not len(keys):
        return keys, values.astype(np.int64)
    order = np.argsort(keys, kind="stable")
    keys, values = keys[order], values[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[first], np.add.reduceat(values.astype(np.int64), first)


def _planes(values: np.ndarray) -> bytes:
    return np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8).T).tobytes()


def _values(planes: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(planes, dtype=np.uint8).reshape(8, -1).T).view("<u8").ravel()


def pack(*columns: np.ndarray) -> bytes:
    """Columns of equal length, the first in ascending order."""
    deltas = np.diff(columns[0].astype(U64), prepend=U64(0))
    return zstandard.ZstdCompressor(level=1).compress(b"".join([_planes(deltas), *map(_planes, columns[1:])]))


def unpack(data: bytes, columns: int = 2) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(data)
    size = len(raw) // columns
    out = [_values(raw[k * size : (k + 1) * size]) for k in range(columns)]
    out[0] = np.cumsum(out[0])
    return out


def by_shard(shard: np.ndarray, *columns: np.ndarray) -> pa.RecordBatch:
    """One packed row for each shard; ``shard`` is in ascending order."""
    cuts = np.flatnonzero(np.diff(shard)) + 1 if len(shard) else np.zeros(0, dtype=np.int64)
    bounds = list(zip([0, *cuts], [*cuts, len(shard)])) if len(shard) else []
    return pa.RecordBatch.from_arrays(
        [
            pa.array([int(shard[a]) for a, _ in bounds], pa.int32()),
            pa.array([pack(*(c[a:b] for c in columns)) for a, b in bounds], pa.binary()),
        ],
        ["shard", "packed"],
    )


def merged(rows: DataFrame, work: Callable[[int, list[bytes]], Iterator[pa.RecordBatch]], schema: str, shards: int) -> DataFrame:
    """``work`` once for each shard, with all the packed rows sent to it."""

    def run(batches):
        now, held = None, []
        for batch in batches:
            for shard, data in zip(batch.column("shard").to_pylist(), batch.column("packed").to_pylist()):
                if shard != now and held:
                    yield from work(now, held)
                    held = []
                now = shard
                held.append(data)
        if held:
            yield from work(now, held)

    dealt = rows.repartitionById(shards, rows["shard"]).sortWithinPartitions("shard")
    return dealt.mapInArrow(run, schema)


class Mapped:
    """Files ``name-<shard>`` of sorted keys with a column of values, mapped into memory when first used."""

    def __init__(self, path: str, name: str, kind: str = "<i8"):
        self.path, self.name, self.kind, self.open = path, name, np.dtype(kind), {}

    def __getstate__(self):
        return self.__dict__ | {"open": {}}

    def file(self, shard: int) -> str:
        return f"{self.path}/{self.name}-{shard:06d}"

    def write(self, shard: int, keys: np.ndarray, values: np.ndarray) -> None:
        write_file(self.file(shard), np.array([len(keys)], dtype="<u8"), keys.astype("<u8"), values.astype(self.kind))

    def shard(self, shard: int) -> tuple[np.ndarray, np.ndarray]:
        if shard not in self.open:
            name = self.file(shard)
            if os.path.exists(name):
                size = int(np.fromfile(name, dtype="<u8", count=1)[0])
                data = np.memmap(name, dtype=np.uint8, mode="r")
                self.open[shard] = (data[8 : 8 + 8 * size].view("<u8"), data[8 + 8 * size :].view(self.kind))
            else:
                self.open[shard] = (np.zeros(0, dtype="<u8"), np.zeros(0, dtype=self.kind))
        return self.open[shard]

    def find(self, keys: np.ndarray, shards: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place in its shard and value of each key (-1 and 0 where absent); both arrays are in ascending order."""
        place, value = np.full(len(keys), -1, dtype=np.int64), np.zeros(len(keys), dtype=self.kind)
        cuts = np.flatnonzero(np.diff(shards)) + 1
        for a, b in zip([0, *cuts], [*cuts, len(keys)]) if len(keys) else ():
            known, values = self.shard(int(shards[a]))
            if not len(known):
                continue
            at = np.minimum(np.searchsorted(known, keys[a:b]), len(known) - 1)
            hit = known[at] == keys[a:b]
            place[a:b][hit] = at[hit]
            value[a:b][hit] = values[at[hit]]
        return place, value
