"""SimHash near-duplicates: pigeonhole blocks over 64-bit fingerprints."""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillmart.llm.common import U64, Words, staged, strings, text_slices, xxh64_spans
from rillmart.llm.components import components

FULL = (1 << 64) - 1
BUCKET = 1024  # fingerprints compared within one row; larger buckets are split further, none is cut


def fingerprints_of(texts: list[str], shingle: int = 3, seed: int = 42) -> np.ndarray:
    """Fingerprint of each text: bit set where over half of its shingles' XXH64 values have it."""
    words = Words(texts)
    counts = np.diff(words.first)
    out = np.zeros(len(texts), dtype=U64)
    used = np.flatnonzero(counts)
    if not len(used):
        return out
    per_text = np.maximum(counts[used] - shingle + 1, 1)
    begin = np.concatenate([[0], np.cumsum(per_text)[:-1]])
    at = np.arange(per_text.sum()) - np.repeat(begin, per_text) + np.repeat(words.first[:-1][used], per_text)
    last = np.repeat(words.first[1:][used] - 1, per_text)
    hashes = xxh64_spans(words.raw, words.start[at], words.end[np.minimum(at + shingle - 1, last)], seed)
    bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    ones = np.add.reduceat(bits, begin, axis=0, dtype=np.int64)
    packed = np.packbits(2 * ones > per_text[:, None], axis=1, bitorder="little")
    out[used] = packed.view("<u8").ravel()
    return out


def fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """``doc_id`` and ``fp`` (the fingerprint's 64 bits as a signed long) of each row."""

    def run(batches):
        for rows in text_slices(batches):
            fps = fingerprints_of(strings(rows), shingle).view(np.int64)
            yield pa.RecordBatch.from_arrays([rows.column("doc_id"), pa.array(fps)], ["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, fp long")


def _masks(free: int, blocks: int, alike: int) -> list[int]:
    """Masks of ``alike`` of ``blocks`` even blocks of the bits in ``free``."""
    bits = [b for b in range(64) if free >> b & 1]
    parts = [sum(1 << int(b) for b in part) for part in np.array_split(bits, blocks)]
    return [sum(chosen) for chosen in combinations(parts, alike)]


def levels(radius: int = 3) -> list[list[list[int]]]:
    """Masks by level and table.

    Two fingerprints within ``radius`` bits share 2 of ``radius + 2`` blocks.
    The bits outside a table's blocks are divided again, ``radius`` of
    ``2 * radius`` blocks each time, for buckets that are still large.  After the
    last level at most ``2 ** 12`` different fingerprints fit into a bucket.
    """
    out = [[_masks(FULL, radius + 2, 2)]]
    for _ in range(2):
        above = [mask for masks in out[-1] for mask in masks]
        out.append([[m | x for x in _masks(FULL & ~m, 2 * radius, radius)] for m in above])
    return out


def _expand(tables: list[list[int]]):
    """Rows of (``t``, ``fp``) to one row for each mask of table ``t``."""
    each = len(tables[0])
    masks = np.array(tables, dtype=U64)

    def run(batches):
        for batch in batches:
            t = np.asarray(batch.column("t"), dtype=np.int64)
            fp = np.asarray(batch.column("fp"), dtype=np.int64)
            bits = fp.view(U64)[:, None] & masks[t]
            own = t[:, None] * each + np.arange(each)
            yield pa.RecordBatch.from_arrays(
                [pa.array(own.ravel().astype(np.int32)), pa.array(bits.ravel().view(np.int64)), pa.array(np.repeat(fp, each))],
                ["t", "key", "fp"],
            )

    return run


def spanning(near: np.ndarray) -> np.ndarray:
    """Smallest index that each index of a symmetric matrix reaches: one link a member keeps them together."""
    label = np.arange(len(near))
    while True:
        low = np.where(near, label[None, :], len(near)).min(axis=1)
        low = np.minimum(low, label)
        low = low[low]
        if (low == label).all():
            return label
        label = low


def _links(radius: int):
    def run(batches):
        for batch in batches:
            a, b = [], []
            for members in batch.column("fps").to_pylist():
                fps = np.unique(np.array(members, dtype=np.int64)).view(U64)
                label = spanning(np.bitwise_count(fps[:, None] ^ fps[None, :]) <= radius)
                on = np.flatnonzero(label != np.arange(len(fps)))
                a.append(fps[on])
                b.append(fps[label[on]])
            if a:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(x).view(np.int64)) for x in (a, b)], ["a", "b"]
                )

    return run


def links(fps: DataFrame, radius: int = 3) -> DataFrame:
    """Links (``a``, ``b``) that connect the same fingerprints as all pairs within ``radius`` bits do.

    Buckets of equal blocks are verified by Hamming distance and give a spanning
    set of links.  A bucket of over ``BUCKET`` fingerprints is not compared as a
    whole: its members go on to the next level's finer blocks.
    """
    out = None
    rows = fps.select(F.lit(0).alias("t"), "fp")
    steps = levels(radius)
    for depth, tables in enumerate(steps):
        keys = rows.mapInArrow(_expand(tables), "t int, key long, fp long")
        sizes = keys.groupBy("t", "key").agg(F.count("*").alias("size")).where("size > 1")
        many = staged(keys.join(sizes, ["t", "key"]), f"blocks{depth}")
        last = depth == len(steps) - 1
        small = many if last else many.where(F.col("size") <= BUCKET)
        found = small.groupBy("t", "key").agg(F.collect_list("fp").alias("fps"))
        found = found.select("fps").mapInArrow(_links(radius), "a long, b long")
        out = found if out is None else out.union(found)
        rows = many.where(F.col("size") > BUCKET).select("t", "fp")
        if last or rows.isEmpty():
            return out
    return out


def near_duplicates(docs: DataFrame, *, shingle: int = 3, radius: int = 3) -> DataFrame:
    """``doc_id``, ``fp`` and ``component_id`` (smallest linked doc_id) for each row of ``docs``.

    Equal fingerprints are one node, so a group of copies costs one row however
    large it is.  Null texts count as empty; texts without words have fingerprint
    zero and link like any other.  Rows with a null doc_id are kept and never
    name a component unless all its rows are null.  Repeated rows stay repeated.
    """
    rows = staged(fingerprints(docs, shingle), "fingerprints")
    nodes = staged(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "nodes")
    joined = components(links(nodes, radius)).withColumnRenamed("node", "fp")
    linked = nodes.join(joined, "fp", "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    lowest = linked.groupBy("root").agg(F.min("least").alias("component_id"))
    labels = linked.join(lowest, "root").select("fp", "component_id")
    return rows.join(labels, "fp").select("doc_id", "fp", "component_id")
