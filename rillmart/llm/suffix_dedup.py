"""Removal of repeated passages by a sampled suffix array.

Every window of ``LENGTH`` bytes has one anchor: its leftmost 18-byte piece of
least hash, so equal windows have equal anchors at equal places.  Only suffixes
that begin at anchors are sorted, about one byte in 17, and of these only those
whose first 18 bytes occur in two documents.  Sampled splitters deal them out by
their leading bytes; a bucket sorts its suffixes, with the bytes before them, by
multikey quicksort, merges equal ones and compares their windows.  A value that
is a splitter may lie in several buckets, so its windows are compared once more
across them.  The windows found in two documents, with their smallest doc_id, are
stored as sorted hash arrays which the workers that cut the texts map into memory.
Windows are compared by 64-bit hashes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillmart.llm import arrays
from rillmart.llm.arrays import Mapped
from rillmart.llm.common import BASE, U64, mix, mounted, prefix_sums, released, shared_folder, text_slices

LENGTH = 50
PIECE = 18
REACH = LENGTH - PIECE  # bytes by which an anchor may follow its window's start
CONTEXT = REACH + LENGTH
WORDS = 12  # of eight bytes: the suffix, the bytes before it backwards, which windows it owns
STRETCH = 1 << 21  # starts handled at once
GROUP = 600_000  # anchors combined at once in a map task; results do not depend on it
SLICE = 1 << 18  # bytes of short texts handled at once
LONG_TEXT = 1 << 20  # bytes; longer texts are handled in pieces that overlap
SHARD_BYTES = 16 << 20  # of text for a shard of the hash arrays and for a bucket of suffixes
SAMPLE = 2_000  # suffixes that a task offers as splitters
SIGN = U64(1 << 63)


class Slice:
    """Several texts in one buffer: their windows' starts and anchors, and hashes of any span."""

    def __init__(self, texts: list[bytes], ids: list[int | None]):
        self.texts = texts
        self.raw = b"".join(texts)
        self.buf = np.frombuffer(self.raw, dtype=np.uint8)
        self.end = np.cumsum([len(t) for t in texts]).astype(np.int64)
        self.begin = np.append(0, self.end[:-1]).astype(np.int64)
        #: doc_id in an order that fits unsigned numbers
        self.doc = np.array([0 if i is None else i for i in ids], dtype=np.int64).view(U64) ^ SIGN
        counts = np.maximum(self.end - self.begin - LENGTH + 1, 0)
        counts[[i is None for i in ids]] = 0  # rows without an id neither lose nor cause anything
        first = np.cumsum(counts) - counts
        self.owner = np.repeat(np.arange(len(texts)), counts)
        self.start = np.arange(counts.sum()) - np.repeat(first, counts) + np.repeat(self.begin, counts)
        self.sums, self.down = prefix_sums(self.buf) if len(self.buf) else (np.zeros(1, dtype=U64), None)
        self.anchor = self._anchors()[self.start] if len(self.start) else np.zeros(0, dtype=np.int64)

    def hashes(self, at: np.ndarray, size: int) -> np.ndarray:
        return mix((self.sums[at + size] - self.sums[at]) * self.down[at] + U64(size))

    def _anchors(self) -> np.ndarray:
        n = len(self.buf) - LENGTH + 1
        out = np.empty(n, dtype=np.int64)
        low = U64((1 << 24) - 1)
        for begin in range(0, n, STRETCH):
            count = min(STRETCH, n - begin)
            at = np.arange(begin, begin + count + REACH)
            least = self.hashes(at, PIECE) & ~low | np.arange(len(at), dtype=U64)
            step = 1
            while 2 * step <= REACH + 1:
                least = np.minimum(least[:-step], least[step:])
                step *= 2
            rest = REACH + 1 - step
            if rest:
                least = np.minimum(least[:-rest], least[rest:])
            out[begin : begin + count] = (least[:count] & low).astype(np.int64) + begin
        return out

    def occurrences(self) -> tuple[np.ndarray, np.ndarray]:
        """First and last place in ``start`` of the windows of each anchor of each text."""
        if not len(self.start):
            return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        new = np.concatenate([[True], (self.anchor[1:] != self.anchor[:-1]) | (self.owner[1:] != self.owner[:-1])])
        first = np.flatnonzero(new)
        return first, np.append(first[1:], len(new)) - 1


def pieces(rows: pa.RecordBatch):
    """Several short texts, or a piece of a long one, at once, with the piece's place in its text.

    Pieces overlap by less than a window, so each window is in exactly one.
    """
    ids = rows.column("doc_id").to_pylist()
    texts = [b"" if x is None else x.encode("utf-8", "replace") for x in rows.column("text").to_pylist()]
    if len(texts) == 1 and len(texts[0]) > LONG_TEXT:
        for at in range(0, len(texts[0]) - LENGTH + 1, LONG_TEXT):
            yield Slice([texts[0][at : at + LONG_TEXT + LENGTH - 1]], ids), at
    else:
        yield Slice(texts, ids), 0


def slices(batches):
    for rows in text_slices(batches, limit=SLICE):
        yield from pieces(rows)


def _spread(keys: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys in order with the least ``low`` and the greatest ``high``."""
    if not len(keys):
        return keys, low, high
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[first], np.minimum.reduceat(low[order], first), np.maximum.reduceat(high[order], first)


def _shard(keys: np.ndarray, bits: int) -> np.ndarray:
    return (keys >> U64(64 - bits)).astype(np.int64)


def _send(keys: np.ndarray, low: np.ndarray, high: np.ndarray, bits: int) -> pa.RecordBatch:
    keys, low, high = _spread(keys, low, high)
    return arrays.by_shard(_shard(keys, bits), keys, low, high - low)


def _anchor_keys(bits: int):
    def run(batches):
        keys, docs, size = [], [], 0

        def flush():
            doc = np.concatenate(docs)
            return _send(np.concatenate(keys), doc, doc, bits)

        for part, _ in slices(batches):
            first, _ = part.occurrences()
            if not len(first):
                continue
            keys.append(part.hashes(part.anchor[first], PIECE))
            docs.append(part.doc[part.owner[first]])
            size += len(first)
            if size >= GROUP:
                yield flush()
                keys, docs, size = [], [], 0
        if size:
            yield flush()

    return run


def _store(path: str, name: str, kind: str):
    """Keeps the keys that occur in two documents, with the smallest doc_id."""

    def work(shard, held):
        keys, low, high = (np.zeros(0, dtype=U64),) * 3
        for begin in range(0, len(held), 16):  # a few rows at a time, so that copies stay small
            parts = [arrays.unpack(data, 3) for data in held[begin : begin + 16]]
            keys, low, high = _spread(
                np.concatenate([keys, *(p[0] for p in parts)]),
                np.concatenate([low, *(p[1] for p in parts)]),
                np.concatenate([high, *(p[1] + p[2] for p in parts)]),
            )
        keep = low < high
        Mapped(path, name, kind).write(shard, keys[keep], low[keep])
        yield pa.RecordBatch.from_arrays([pa.array([shard], pa.int32()), pa.array([int(keep.sum())])], ["shard", "n"])

    return work


def _flagged(part: Slice, keys: Mapped, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """``occurrences`` of the anchors that occur in two documents."""
    first, last = part.occurrences()
    if not len(first):
        return first, last
    unique, back = np.unique(part.hashes(part.anchor[first], PIECE), return_inverse=True)
    known = keys.find(unique, _shard(unique, bits))[0] >= 0
    return first[known[back]], last[known[back]]


def _contexts(part: Slice, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """One row of ``WORDS`` numbers an occurrence, ordered like the suffix; unused bytes are zero."""
    at = part.anchor[first]
    most, least = at - part.start[first], at - part.start[last]
    offsets = np.arange(-REACH, LENGTH)
    place = at[:, None] + offsets
    inside = (offsets >= -most[:, None]) & (offsets < LENGTH - least[:, None])
    data = np.where(inside, part.buf[np.clip(place, 0, len(part.buf) - 1)], 0).astype(np.uint8)
    out = np.zeros((len(at), 8 * WORDS), dtype=np.uint8)
    out[:, :LENGTH] = data[:, REACH:]
    out[:, 56 : 56 + REACH] = data[:, REACH - 1 :: -1]
    out[:, 94], out[:, 95] = least, most
    return out.view(">u8").astype(U64)


def context_hash(words: np.ndarray) -> np.ndarray:
    out = np.full(len(words), U64(WORDS), dtype=U64)
    for k in range(WORDS):
        out = mix(out * U64(31) + words[:, k])
    return out


def multikey_order(words: np.ndarray) -> np.ndarray:
    """Order of rows of eight-byte symbols: by the first symbol, then the rows that tie by the next, and so on."""
    order = np.argsort(words[:, 0], kind="stable")
    group = np.zeros(len(words), dtype=np.int64)
    for k in range(words.shape[1]):
        column = words[order, k]
        new = np.ones(len(order), dtype=bool)
        new[1:] = (column[1:] != column[:-1]) | (group[1:] != group[:-1])
        group = np.cumsum(new)
        tied = np.flatnonzero(~new | np.append(~new[1:], False))
        if not len(tied) or k + 1 == words.shape[1]:
            break
        inner = np.lexsort((words[order[tied], k + 1], group[tied]))
        order[tied] = order[tied][inner]
    return order


def _merge_rows(words: np.ndarray, low: np.ndarray, high: np.ndarray):
    """Distinct rows in order with the least ``low`` and the greatest ``high``."""
    order = multikey_order(words)
    words = words[order]
    new = np.ones(len(words), dtype=bool)
    new[1:] = (words[1:] != words[:-1]).any(axis=1)
    first = np.flatnonzero(new)
    return words[first], np.minimum.reduceat(low[order], first), np.maximum.reduceat(high[order], first)


def _send_contexts(keys: Mapped, bits: int, splitters: np.ndarray):
    def run(batches):
        held, size = [], 0

        def flush():
            words, low, high = _merge_rows(*(np.concatenate(x) for x in zip(*held)))
            a = np.searchsorted(splitters, words[:, 0], "left")
            b = np.searchsorted(splitters, words[:, 0], "right")
            bucket = a + (context_hash(words) % (b - a + 1).astype(U64)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            bucket, words, low, high = bucket[order], words[order], low[order], high[order]
            cuts = np.flatnonzero(np.diff(bucket)) + 1
            bounds = list(zip([0, *cuts], [*cuts, len(bucket)]))
            coder = zstandard.ZstdCompressor(level=3)
            data = [
                coder.compress(np.int64(e - s).tobytes() + words[s:e].tobytes() + low[s:e].tobytes() + (high - low)[s:e].tobytes())
                for s, e in bounds
            ]
            return pa.RecordBatch.from_arrays(
                [pa.array([int(bucket[s]) for s, _ in bounds], pa.int32()), pa.array(data, pa.binary())],
                ["shard", "packed"],
            )

        for part, _ in slices(batches):
            first, last = _flagged(part, keys, bits)
            if not len(first):
                continue
            doc = part.doc[part.owner[first]]
            held.append((_contexts(part, first, last), doc, doc))
            size += len(first)
            if size >= GROUP // 4:
                yield flush()
                held, size = [], 0
        if size:
            yield flush()

    return run


def _sample(keys: Mapped, bits: int):
    def run(batches):
        found, size = [], 0
        for part, _ in slices(batches):
            first, last = _flagged(part, keys, bits)
            if len(first):
                found.append(_contexts(part, first, last)[:, 0])
                size += len(first)
        values = np.concatenate(found) if found else np.zeros(0, dtype=U64)
        values = values[:: max(1, -(-size // SAMPLE))]
        yield pa.RecordBatch.from_arrays([pa.array((values ^ SIGN).view(np.int64))], ["value"])

    return run


def _compare(bits: int, splitters: np.ndarray):
    """What two documents share in a bucket: whole contexts, and windows that lie in different contexts.

    Windows of contexts that other buckets may hold too are all passed on.
    """

    def work(bucket, held):
        coder, parts = zstandard.ZstdDecompressor(), []
        for data in held:
            raw = coder.decompress(data)
            n = int(np.frombuffer(raw, dtype=np.int64, count=1)[0])
            flat = np.frombuffer(raw, dtype=U64, offset=8)
            least, gap = flat[n * WORDS : n * (WORDS + 1)], flat[n * (WORDS + 1) :]
            parts.append((flat[: n * WORDS].reshape(n, WORDS), least, least + gap))
        words, low, high = _merge_rows(*(np.concatenate(x) for x in zip(*parts)))
        cut = np.isin(words[:, 0], splitters)
        out = []
        for s in range(0, len(words), 20_000):
            raw = words[s : s + 20_000].astype(">u8").view(np.uint8).reshape(-1, 8 * WORDS)
            data = np.concatenate([raw[:, 56 + REACH - 1 : 55 : -1], raw[:, :LENGTH]], axis=1)
            least, most = raw[:, 94], raw[:, 95]
            _, down = prefix_sums(data[0])
            up = np.ones(CONTEXT, dtype=U64)
            np.cumprod(np.full(CONTEXT - 1, BASE, dtype=U64), out=up[1:])
            sums = np.zeros((len(data), CONTEXT + 1), dtype=U64)
            np.cumsum((data.astype(U64) + U64(1)) * up, axis=1, out=sums[:, 1:])
            for back in range(REACH + 1):
                on = np.flatnonzero((least <= back) & (back <= most))
                if len(on):
                    at = REACH - back
                    value = mix((sums[on, at + LENGTH] - sums[on, at]) * down[at] + U64(LENGTH))
                    out.append((value, low[s + on], high[s + on], cut[s + on]))
        value, least, most, cut = (np.concatenate(x) for x in zip(*out))
        edge = np.unique(value[cut])
        order = np.sort(value)
        several = order[1:][order[1:] == order[:-1]]
        value, least, most = _spread(value, least, most)
        keep = ((least < most) & np.isin(value, several)) | np.isin(value, edge)
        whole = low < high
        yield _send(
            np.concatenate([value[keep], context_hash(words[whole])]),
            np.concatenate([least[keep], low[whole]]),
            np.concatenate([most[keep], high[whole]]),
            bits,
        )

    return work


def repeats(docs: DataFrame) -> tuple[str, int]:
    """Folder and shard bits of the arrays of anchors and windows that two documents share."""
    spark = docs.sparkSession
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(2, -(-size // SHARD_BYTES))  # shards follow the text, not the session's settings
    bits = (parts - 1).bit_length()
    path = mounted(shared_folder(spark, "suffixes"))
    stored = "shard int, n long"
    found = docs.mapInArrow(released(_anchor_keys(bits)), arrays.PACKED)
    arrays.merged(found, released(_store(path, "anchors", "<u1")), stored, 1 << bits).agg(F.sum("n")).collect()
    keys = Mapped(path, "anchors", "<u1")
    some = docs.where(F.pmod(F.xxhash64("doc_id"), F.lit(50)) == 0)  # chooses splitters only
    values = [r.value for r in some.mapInArrow(released(_sample(keys, bits)), "value long").collect()]
    values = np.sort(np.array(values, dtype=np.int64)).view(U64) ^ SIGN
    splitters = values[[len(values) * k // parts for k in range(1, parts)]] if len(values) else values
    contexts = docs.mapInArrow(released(_send_contexts(keys, bits, splitters)), arrays.PACKED)
    windows = arrays.merged(contexts, released(_compare(bits, splitters)), arrays.PACKED, len(splitters) + 1)
    arrays.merged(windows, released(_store(path, "windows", "<u8")), stored, 1 << bits).agg(F.sum("n")).collect()
    return path, bits


def remove_repeats(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``n_bytes``, ``spans`` (begin, end in bytes) removed, and ``kept`` bytes of every row.

    A byte goes if a string of ``LENGTH`` bytes covers it that also starts in a
    document with a smaller doc_id; strings are judged on the input.  A null text
    is empty.  Rows without an id are kept whole and cause no removal; of rows
    that repeat an id neither is the earlier.  An empty table gives no rows.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    path, bits = repeats(rows)
    keys, windows = Mapped(path, "anchors", "<u1"), Mapped(path, "windows", "<u8")

    def cuts(part: Slice):
        """Begin and end of what goes, in the slice's bytes."""
        begins, ends = [], []
        first, last = _flagged(part, keys, bits)
        if len(first):
            doc = part.doc[part.owner[first]]
            unique, back = np.unique(context_hash(_contexts(part, first, last)), return_inverse=True)
            place, least = windows.find(unique, _shard(unique, bits))
            whole = (place >= 0)[back] & (least[back] < doc)
            begins.append(part.start[first[whole]])
            ends.append(part.start[last[whole]] + LENGTH)
            first, last = first[~whole], last[~whole]
        if len(first):
            sizes = last - first + 1
            at = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes) + np.repeat(first, sizes)
            unique, back = np.unique(part.hashes(part.start[at], LENGTH), return_inverse=True)
            place, least = windows.find(unique, _shard(unique, bits))
            cut = (place >= 0)[back] & (least[back] < part.doc[part.owner[at]])
            begins.append(part.start[at][cut])
            ends.append(part.start[at][cut] + LENGTH)
        nothing = [np.zeros(0, dtype=np.int64)]
        return np.concatenate(nothing + begins), np.concatenate(nothing + ends)

    def run(batches):
        span = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))
        for batch in text_slices(batches, limit=SLICE):
            sizes, texts, found = [], [], []
            for part, at in pieces(batch):
                begin, end = cuts(part)
                found.append((begin + at, end + at))
                texts, sizes = part.texts, (part.end - part.begin).tolist()
            if len(found) > 1:
                texts = [batch.column("text")[0].as_buffer().to_pybytes()]
                sizes = [len(texts[0])]
            ends = np.cumsum(sizes).tolist()
            steps = np.zeros(sum(sizes) + 1, dtype=np.int32)
            for begin, end in found:
                np.add.at(steps, begin, 1)
                np.add.at(steps, end, -1)
            gone = np.cumsum(steps[:-1], dtype=np.int32) > 0
            spans, kept = [], []
            for text, b in zip(texts, ends):
                own = gone[b - len(text) : b]
                if not own.any():
                    spans.append([])
                    kept.append(text)
                    continue
                edges = np.flatnonzero(np.diff(np.concatenate([[False], own, [False]]).astype(np.int8)))
                spans.append([{"begin": x, "end": y} for x, y in edges.reshape(-1, 2).tolist()])
                kept.append(np.frombuffer(text, dtype=np.uint8)[~own].tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(spans, span), pa.array(kept, pa.binary())],
                ["doc_id", "n_bytes", "spans", "kept"],
            )

    return rows.mapInArrow(run, "doc_id long, n_bytes long, spans array<struct<begin:long,end:long>>, kept binary")
