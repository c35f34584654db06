"""Helpers shared by the operators: batches of text, word spans and vectorised hashes.

Texts are handled as UTF-8 bytes in numpy arrays.  Words are runs of bytes other
than space and ``\\x09-\\x0D``; a null text counts as empty.
"""

from __future__ import annotations

import ctypes
import os
import tempfile
import uuid
from collections.abc import Iterator
from functools import lru_cache
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

U64 = np.uint64
SLICE_BYTES = 1 << 20  # text handled at once inside a task; results do not depend on it


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder name under ``spark.checkpoint.dir``, which driver and executors share.

    Where the setting is unset a local session (tests) gets a temporary folder;
    any other master is refused, as its executors would not see each other's files.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        shared = f"file://{tempfile.gettempdir()}/llm-shared"
    return f"{shared.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def staged(rows: DataFrame, purpose: str, **options: str) -> DataFrame:
    """``rows`` written once to the shared folder and read back; cuts lineage, survives lost executors."""
    spark = rows.sparkSession
    path = shared_folder(spark, purpose)
    rows.write.options(**options).parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def mounted(path: str) -> str:
    """File path of a shared folder for code that maps files into memory."""
    parts = urlparse(path)
    if parts.scheme not in ("", "file"):
        raise ValueError(f"files are memory-mapped, so the shared folder must be mounted; got {path}")
    return parts.path


def write_file(path: str, *arrays: np.ndarray) -> None:
    """All arrays one after another, put in place in one step so that repeated tasks do no harm."""
    os.makedirs(os.path.dirname(path), exist_ok=True)
    part = f"{path}.{uuid.uuid4().hex}"
    with open(part, "wb") as out:
        for array in arrays:
            array.tofile(out)
    os.replace(part, path)


def text_slices(batches, column: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows in slices of about ``limit`` bytes of ``column``; a longer text is a slice of its own."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = np.asarray(
            pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False),
            dtype=np.int64,
        )
        turn = np.cumsum(sizes + 16) // limit
        cuts = np.flatnonzero(np.diff(turn)) + 1
        for start, end in zip([0, *cuts], [*cuts, batch.num_rows]):
            yield batch.slice(int(start), int(end - start))


def released(run):
    """``run``, after which its worker, which later stages use again, gives free memory back."""

    def wrapped(*args):
        yield from run(*args)
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # the allocator keeps what it could give back
        if trim:
            trim(0)

    return wrapped


def strings(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    return [x or "" for x in batch.column(column).to_pylist()]


class Words:
    """Word spans of several texts, ASCII letters lower-cased, words joined by one space.

    ``clean``, a table of 256 bytes, replaces the lower-casing.
    ``buf`` holds all texts with eight bytes of padding; word ``i`` is
    ``buf[start[i]:end[i]]``, and text ``d`` owns words ``first[d]`` to ``first[d + 1]``.
    """

    def __init__(self, texts: list[str], *, clean: bytes | None = None):
        parts = []
        for text in texts:
            raw = text.encode("utf-8", "replace")
            parts.append(b" ".join((raw.translate(clean) if clean else raw.lower()).split()))
        counts = np.array([p.count(b" ") + 1 if p else 0 for p in parts], dtype=np.int64)
        joined = b"\n".join(p for p in parts if p)
        self.raw = joined + bytes(8)
        self.buf = np.frombuffer(self.raw, dtype=np.uint8)
        used = self.buf[: len(joined)]
        gaps = np.flatnonzero((used == 32) | (used == 10))
        if joined:
            self.start = np.concatenate([[0], gaps + 1])
            self.end = np.concatenate([gaps, [len(joined)]])
        else:
            self.start = self.end = np.zeros(0, dtype=np.int64)
        self.first = np.concatenate([[0], np.cumsum(counts)])

    def hashes(self) -> np.ndarray:
        return span_hashes(self.buf, self.start, self.end)

    def text_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


BASE = U64(0x9E3779B97F4A7C15)


@lru_cache(maxsize=1)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    inverse = pow(int(BASE), -1, 1 << 64)
    up, down = np.full(n, BASE, dtype=U64), np.full(n, inverse, dtype=U64)
    up[0] = down[0] = 1
    return np.cumprod(up), np.cumprod(down)


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit values."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def prefix_sums(buf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Running polynomial sums of ``buf`` and the factors that move a span to the origin."""
    size = 1 << max(20, int(len(buf)).bit_length())
    up, down = _powers(size)
    sums = np.empty(len(buf) + 1, dtype=U64)
    sums[0] = 0
    np.cumsum((buf.astype(U64) + U64(1)) * up[: len(buf)], out=sums[1:])
    return sums, down


def span_hashes(buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of each span's bytes."""
    sums, down = prefix_sums(buf)
    return mix((sums[end] - sums[start]) * down[start] + (end - start).astype(U64))


def many_span_hashes(buf: np.ndarray, spans: list[tuple[np.ndarray, np.ndarray]]) -> list[np.ndarray]:
    """``span_hashes`` of several lists of spans of one buffer."""
    sums, down = prefix_sums(buf)
    return [mix((sums[end] - sums[start]) * down[start] + (end - start).astype(U64)) for start, end in spans]


_P1, _P2, _P3, _P4, _P5 = (
    U64(11400714785074694791),
    U64(14029467366897019727),
    U64(1609587929392839161),
    U64(9650029242287828579),
    U64(2870177450012600261),
)
_LONG_SPAN = 256  # longer spans are hashed one by one


def _turn(x: np.ndarray, bits: int) -> np.ndarray:
    return (x << U64(bits)) | (x >> U64(64 - bits))


def xxh64_spans(raw: bytes, start: np.ndarray, end: np.ndarray, seed: int = 42) -> np.ndarray:
    """XXH64 of ``raw[start:end]`` for all spans at once; ``raw`` ends with eight bytes of padding."""
    n = len(raw)
    eights = np.ndarray((n - 7,), dtype="<u8", buffer=raw, strides=(1,))
    fours = np.ndarray((n - 3,), dtype="<u4", buffer=raw, strides=(1,))
    ones = np.frombuffer(raw, dtype=np.uint8)
    size = (end - start).astype(np.int64)
    at = start.astype(np.int64).copy()
    out = np.full(len(size), U64(seed) + _P5, dtype=U64)
    wide = np.flatnonzero((size >= 32) & (size <= _LONG_SPAN))
    if len(wide):
        lanes = [np.full(len(wide), v, dtype=U64) for v in (
            (seed + int(_P1) + int(_P2)) % 2**64, (seed + int(_P2)) % 2**64, seed, (seed - int(_P1)) % 2**64)]
        stripes = size[wide] // 32
        for k in range(int(stripes.max())):
            on = np.flatnonzero(stripes > k)
            base = at[wide[on]] + 32 * k
            for j in range(4):
                lanes[j][on] = _turn(lanes[j][on] + eights[base + 8 * j] * _P2, 31) * _P1
        total = _turn(lanes[0], 1) + _turn(lanes[1], 7) + _turn(lanes[2], 12) + _turn(lanes[3], 18)
        for lane in lanes:
            total = (total ^ (_turn(lane * _P2, 31) * _P1)) * _P1 + _P4
        out[wide] = total
        at[wide] += 32 * stripes
    out += size.astype(U64)
    rest = np.where(size <= _LONG_SPAN, end - at, 0)
    while True:
        on = np.flatnonzero(rest >= 8)
        if not len(on):
            break
        step = _turn(eights[at[on]] * _P2, 31) * _P1
        out[on] = _turn(out[on] ^ step, 27) * _P1 + _P4
        at[on] += 8
        rest[on] -= 8
    on = np.flatnonzero(rest >= 4)
    if len(on):
        out[on] = _turn(out[on] ^ (fours[at[on]].astype(U64) * _P1), 23) * _P2 + _P3
        at[on] += 4
        rest[on] -= 4
    for k in range(3):
        on = np.flatnonzero(rest > k)
        if len(on):
            out[on] = _turn(out[on] ^ (ones[at[on] + k].astype(U64) * _P5), 11) * _P1
    out = (out ^ (out >> U64(33))) * _P2
    out = (out ^ (out >> U64(29))) * _P3
    out = out ^ (out >> U64(32))
    for i in np.flatnonzero(size > _LONG_SPAN):
        out[i] = xxhash.xxh64_intdigest(raw[start[i] : end[i]], seed)
    return out


def crc_part(column, parts: int):
    """``crc32`` of an id as text, modulo ``parts``; null ids count as part 0."""
    return F.coalesce(F.pmod(F.crc32(F.col(column).cast("string").cast("binary")), F.lit(parts)), F.lit(0))
