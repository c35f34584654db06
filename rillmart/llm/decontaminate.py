"""Benchmark decontamination: SimHash over item-sized windows.

Windows as long as a benchmark item are fingerprinted by SimHash over their
five-word shingles, each as often as it occurs.  A window meets the items that
share a shingle with it, as no other can be similar; of these a multi-index over
eight blocks of the fingerprint takes those within ``RADIUS`` bits, and they are
verified by the exact weighted similarity of the shingles.  Items of fewer than
five words are one shingle of their own length, and windows are cut alike.
"""

from __future__ import annotations

import uuid
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillmart.llm.common import U64, Words, mix, strings, text_slices

SHINGLE = 5
SIMILARITY = 0.8
RADIUS = 23  # bits; a window as similar as 0.8 differs in about 10 of 64
BLOCKS = 8
NEAR = RADIUS // BLOCKS  # bits by which at least one block of a pair within RADIUS differs at most
BLOCK_BYTES = 16 << 20  # text of the benchmark held by a task at once; a larger benchmark takes more passes

#: Words are runs of letters and digits, lower-cased.
_CLEAN = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))


def _words(texts: list[str]) -> Words:
    return Words([text.lower() for text in texts], clean=_CLEAN)


def word_counts(texts: list[str]) -> np.ndarray:
    return np.diff(_words(texts).first)


def shingles(texts: list[str] | Words, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all texts' shingles of ``size`` words, and where each text's begin; a shorter text is one shingle."""
    words = texts if isinstance(texts, Words) else _words(texts)
    hashes = words.hashes()
    counts = np.diff(words.first)
    own = np.where(counts > 0, np.maximum(counts - size + 1, 1), 0)
    first = np.concatenate([[0], np.cumsum(own)])
    at = np.arange(first[-1]) - np.repeat(first[:-1], own) + np.repeat(words.first[:-1], own)
    last = np.repeat(words.first[1:] - 1, own)
    out = np.zeros(len(at), dtype=U64)
    for k in range(size):
        inside = at + k <= last
        out = np.where(inside, mix(out * U64(31) + hashes[np.minimum(at + k, last)] + U64(k)), out)
    return out, first


def _ones(hashes: np.ndarray) -> np.ndarray:
    return np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def window_prints(hashes: np.ndarray, size: int) -> np.ndarray:
    """SimHash of every window of ``size`` shingles."""
    sums = np.zeros((len(hashes) + 1, 64), dtype=np.int64)
    np.cumsum(_ones(hashes), axis=0, out=sums[1:])
    inside = sums[size:] - sums[:-size]
    return np.packbits(2 * inside > size, axis=1, bitorder="little").view("<u8").ravel()


class Group(NamedTuple):
    """The items of one size."""

    items: np.ndarray
    prints: np.ndarray


PAIRS = 1 << 16  # pairs of a window and an item compared at once


class Index:
    """Items by size with their fingerprints, and the items of each shingle."""

    def __init__(self, item_ids: list[int], texts: list[str]):
        found, first = shingles(texts)
        self.item_ids = item_ids
        self.counts: list[dict[int, int]] = []
        self.short: dict[int, dict[int, list[int]]] = {}  # number of words: hash: items
        by_size: dict[int, list[int]] = {}
        holders: dict[int, list[int]] = {}
        lengths = word_counts(texts)
        for i in range(len(texts)):
            own = found[first[i] : first[i + 1]]
            values, times = np.unique(own, return_counts=True)
            self.counts.append(dict(zip(values.tolist(), times.tolist())))
            if 0 < lengths[i] < SHINGLE:
                self.short.setdefault(int(lengths[i]), {}).setdefault(int(own[0]), []).append(i)
            elif len(own):
                by_size.setdefault(len(own), []).append(i)
                for value in values.tolist():
                    holders.setdefault(value, []).append(i)
        self.known = np.array(sorted(holders), dtype=U64)
        sizes = [len(holders[v]) for v in self.known.tolist()]
        self.begin = np.append(0, np.cumsum(sizes)).astype(np.int64)
        self.holders = np.array([i for v in self.known.tolist() for i in holders[v]], dtype=np.int64)
        self.maybe = np.zeros(1 << 20, dtype=bool)
        self.maybe[(self.known >> U64(44)).astype(np.int64)] = True
        self.size_of, self.place_of = np.zeros(len(texts), dtype=np.int64), np.zeros(len(texts), dtype=np.int64)
        self.groups = {}
        for size, items in by_size.items():
            prints = np.array([window_prints(found[first[i] : first[i + 1]], size)[0] for i in items], dtype="<u8")
            self.groups[size] = Group(np.array(items), prints)
            self.size_of[items], self.place_of[items] = size, np.arange(len(items))

    def search(self, hashes: np.ndarray) -> list[tuple[int, float, int]]:
        """(item, best similarity, first shingle of that window) of the items found in one text, from its five-word shingles."""
        on = np.flatnonzero(self.maybe[(hashes >> U64(44)).astype(np.int64)]) if len(self.known) else []
        if not len(on):
            return []
        at = np.minimum(np.searchsorted(self.known, hashes[on]), len(self.known) - 1)
        hit = self.known[at] == hashes[on]
        place, value = on[hit], at[hit]
        best: dict[int, tuple[float, int]] = {}
        each = np.diff(self.begin)[value]
        step = np.cumsum(each) // PAIRS
        for turn in np.unique(step):  # bounded memory for texts that repeat a shingle of many items
            some = step == turn
            count = each[some]
            which = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + np.repeat(self.begin[value[some]], count)
            items, places = self.holders[which], np.repeat(place[some], count)
            for size in np.unique(self.size_of[items]).tolist():
                mine = self.size_of[items] == size
                self._size(hashes, size, items[mine], places[mine], best)
        return [(i, sim, place) for i, (sim, place) in best.items()]

    def _size(self, hashes: np.ndarray, size: int, items: np.ndarray, places: np.ndarray, best: dict) -> None:
        """Windows of one size around the places of a shingle that they share with an item."""
        width = min(size, len(hashes))
        low, high = np.maximum(places - width + 1, 0), np.minimum(places, len(hashes) - width)
        order = np.lexsort((low, items))
        items, low, high = items[order], low[order], high[order]
        # neighbouring places of one item share windows: each is taken once
        same = np.append(False, items[1:] == items[:-1])
        low = np.where(same, np.maximum(low, np.append(0, high[:-1] + 1)), low)
        count = np.maximum(high - low + 1, 0)
        turn = np.cumsum(count) // PAIRS
        for t in np.unique(turn):
            some = turn == t
            if not count[some].any():
                continue
            windows = np.arange(count[some].sum()) - np.repeat(np.cumsum(count[some]) - count[some], count[some])
            windows += np.repeat(low[some], count[some])
            self._verify(hashes, windows, np.repeat(items[some], count[some]), width, self.groups[size], best)

    def _verify(self, hashes: np.ndarray, windows: np.ndarray, items: np.ndarray, width: int, group: Group, best: dict) -> None:
        distinct, back = np.unique(windows, return_inverse=True)
        prints = np.empty(len(distinct), dtype="<u8")
        cuts = np.flatnonzero(np.diff(distinct) > width) + 1
        for a, b in zip([0, *cuts], [*cuts, len(distinct)]):
            run = window_prints(hashes[distinct[a] : distinct[b - 1] + width], width)
            prints[a:b] = run[distinct[a:b] - distinct[a]]
        apart = prints[back] ^ group.prints[self.place_of[items]]
        near = (np.bitwise_count(apart.view(np.uint8).reshape(-1, BLOCKS)) <= NEAR).any(axis=1)
        keep = near & (np.bitwise_count(apart) <= RADIUS)
        for w, item in zip(windows[keep].tolist(), items[keep].tolist()):
            counts = self.counts[item]
            values, times = np.unique(hashes[w : w + width], return_counts=True)
            shared = sum(min(t, counts.get(v, 0)) for v, t in zip(values.tolist(), times.tolist()))
            similar = shared / (width + sum(counts.values()) - shared)
            before = best.get(item, (0.0, 0))
            if similar >= SIMILARITY and (similar > before[0] or similar == before[0] and w < before[1]):
                best[item] = (similar, w)


def indexes(benchmark: DataFrame) -> list:
    """Broadcast indexes of the benchmark's items, each of about ``BLOCK_BYTES`` of text at most.

    Items without words take no part.
    """
    spark = benchmark.sparkSession
    rows = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").where(F.col("text").isNotNull())
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = -(-total // BLOCK_BYTES)
    out = []
    for k in range(parts):
        own = rows.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == k).collect()
        out.append(spark.sparkContext.broadcast(([r.item_id for r in own], [r.text for r in own])))
    return out


_built: dict[str, Index] = {}


def _index(shared) -> Index:
    """The index of a broadcast block, built once by each worker."""
    if shared.id not in _built:
        _built.clear()
        _built[shared.id] = Index(*shared.value)
    return _built[shared.id]


class _Shared(NamedTuple):
    id: str  # made on the driver; a broadcast's memory address may return
    holder: object

    @property
    def value(self):
        return self.holder.value


def _found(rows: pa.RecordBatch, shared: _Shared):
    """(row, hits) of the rows in which items are found."""
    index = _index(shared)
    words = _words(strings(rows))
    hashes, first = shingles(words)
    short: dict[int, dict[int, int]] = {}  # text: item: first shingle
    for size, items in index.short.items():
        own, begin = shingles(words, size)
        hit = np.flatnonzero(np.isin(own, np.fromiter(items, dtype=U64, count=len(items))))
        for place, text in zip(hit.tolist(), (np.searchsorted(begin, hit, "right") - 1).tolist()):
            if begin[text + 1] - begin[text] > 1 or words.first[text + 1] - words.first[text] == size:
                for item in items[int(own[place])]:
                    short.setdefault(text, {}).setdefault(item, place - int(begin[text]))
    for k in range(rows.num_rows):
        hits = index.search(hashes[first[k] : first[k + 1]]) if words.first[k + 1] - words.first[k] >= SHINGLE else []
        hits += [(item, 1.0, place) for item, place in short.get(k, {}).items()]
        if hits:
            yield k, hits


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``doc_id``, ``item_id``, ``similarity`` and ``first_shingle`` of the best window of each pair found.

    Items of one to four words are found where their words stand next to each other;
    ``first_shingle`` then counts words.  Null texts are empty and null ids are kept.
    Repeated rows are each reported; of equally similar windows the first counts.  An empty benchmark finds nothing.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    schema = "doc_id long, item_id long, similarity double, first_shingle long"

    def finder(shared: _Shared):
        def run(batches):
            for part in text_slices(batches):
                ids, items = part.column("doc_id").to_pylist(), _index(shared).item_ids
                out = [(ids[k], items[i], sim, at) for k, hits in _found(part, shared) for i, sim, at in hits]
                if out:
                    columns = zip(*out)
                    kinds = (pa.int64(), pa.int64(), pa.float64(), pa.int64())
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(columns, kinds)],
                        ["doc_id", "item_id", "similarity", "first_shingle"],
                    )

        return run

    out = None
    for holder in indexes(benchmark):
        found = rows.mapInArrow(finder(_Shared(uuid.uuid4().hex, holder)), schema)
        out = found if out is None else out.union(found)
    return docs.sparkSession.createDataFrame([], schema) if out is None else out


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, in which no benchmark item is found; no shuffle."""

    def keeper(shared: _Shared):
        def run(batches):
            for part in text_slices(batches):
                keep = np.ones(part.num_rows, dtype=bool)
                keep[[k for k, _ in _found(part, shared)]] = False
                yield part.filter(pa.array(keep))

        return run

    for holder in indexes(benchmark):
        docs = docs.mapInArrow(keeper(_Shared(uuid.uuid4().hex, holder)), docs.schema)
    return docs
