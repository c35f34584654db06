"""Removal of repeated passages by automata of recurring phrases.

Every window of ``WINDOW`` words has one anchor: its leftmost ``PIECE`` words of
least hash.  Anchors are counted first, then the windows whose anchor occurs in
two documents; what recurs is kept, with the smallest doc_id, in sorted hash
arrays that workers map into memory.  A passage is a run of recurring windows
with the same first document.  The passages of the first documents, as text, are
confirmed: dealt into shards and compiled, window by window, into Aho-Corasick
automata over word numbers.  The passages of all other documents stream past
the automata of their first document's shard, which locate every occurrence by
its words.  Hashes only point to a shard: nothing is removed that the automata
did not find.  A collision of two recurring windows' 64-bit hashes could hide
one of them.

Shards follow the bytes counted, and a shard that many documents point to is
dealt to several tasks, each with the shard's phrases.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from functools import lru_cache
from itertools import compress

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillmart.llm import arrays
from rillmart.llm.arrays import Mapped
from rillmart.llm.common import BASE, U64, mix, mounted, shared_folder, span_hashes, staged, text_slices, write_file

WINDOW = 13
PIECE = 5
PIECES = WINDOW - PIECE + 1
CHUNK = 1 << 18  # windows handled at once; results do not depend on it
LONG_WORD = 1 << 10  # bytes; longer words are hashed one by one
GROUP = 1_500_000  # keys combined at once in a map task
SHARD_BYTES = 64 << 20  # of text for a shard of the hash arrays
PHRASE_BYTES = 192 << 10  # of phrases for a shard of automata
STREAM_BYTES = 32 << 20  # of passages that one task streams past a shard's automata
BLOCK = 40_000  # windows of one automaton
PENDING = 4 << 20  # bytes of passages held while a shard has several automata
SIGN = U64(1 << 63)

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[32, *range(9, 14)]] = True


@lru_cache(maxsize=1)
def _powers() -> tuple[np.ndarray, np.ndarray]:
    size = CHUNK + WINDOW + 1
    up, down = np.full(size, BASE, dtype=U64), np.full(size, pow(int(BASE), -1, 1 << 64), dtype=U64)
    up[0] = down[0] = 1
    return np.cumprod(up), np.cumprod(down)


def word_hashes(buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of each word; the memory follows the short words."""
    if not len(start):
        return np.zeros(0, dtype=U64)
    long = np.flatnonzero(end - start > LONG_WORD)
    if not len(long):
        return span_hashes(buf[start[0] : end[-1]], start - start[0], end - start[0])
    parts, at = [], start[0]
    for i in long.tolist():
        parts.append(buf[at : start[i]])
        at = end[i]
    parts.append(buf[at : end[-1]])
    sizes = np.zeros(len(start), dtype=np.int64)
    sizes[long] = (end - start)[long]
    begin = start - start[0] - np.cumsum(sizes) + sizes
    out = span_hashes(np.concatenate([*parts, np.zeros(1, dtype=np.uint8)]), begin, begin + (end - start) - sizes)
    out[long] = [xxhash.xxh64_intdigest(buf[start[i] : end[i]].tobytes()) for i in long.tolist()]
    return out


class Texts:
    """Word spans of a slice of texts: word ``i`` is ``buf[start[i]:end[i]]``, text ``d`` owns ``first[d]`` to ``first[d + 1]``."""

    def __init__(self, rows: pa.RecordBatch):
        column = pc.fill_null(rows.column("text"), "").cast(pa.large_binary())
        _, offsets, data = column.buffers()
        at = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
        self.buf = np.frombuffer(data or b"", dtype=np.uint8)[at[0] : at[-1]]
        self.at = at - at[0]
        space = _SPACE[self.buf]
        edge = np.zeros(len(self.buf) + 1, dtype=bool)
        edge[self.at] = True
        before, after = edge[:-1].copy(), edge[1:].copy()
        before[1:] |= space[:-1]
        after[:-1] |= space[1:]
        self.start = np.flatnonzero(~space & before)
        self.end = np.flatnonzero(~space & after) + 1
        self.first = np.searchsorted(self.start, self.at)
        ids = rows.column("doc_id")
        self.named = ~np.asarray(ids.is_null())
        #: doc_id in an order that fits unsigned numbers
        self.doc = np.asarray(pc.fill_null(ids, 0)).astype(np.int64).view(U64) ^ SIGN

    def text(self, i: int) -> bytes:
        return self.buf[self.at[i] : self.at[i + 1]].tobytes()

    def row_keys(self, i: int) -> tuple[int, int]:
        """Names a row: its scrambled doc_id and a hash of its text."""
        return int(mix(self.doc[i : i + 1])[0]), xxhash.xxh64_intdigest(self.text(i))


class Chunk:
    """Windows of consecutive words, grouped into runs of one anchor."""

    def __init__(self, texts: Texts, begin: int):
        stop = min(len(texts.start), begin + CHUNK + WINDOW - 1)
        self.start, self.end, self.begin = texts.start[begin:stop], texts.end[begin:stop], begin
        self.owner = np.searchsorted(texts.first, np.arange(begin, stop), "right") - 1
        n = max(0, len(self.start) - WINDOW + 1)
        whole = self.owner[:n] == self.owner[WINDOW - 1 :][:n]
        #: places of the windows; those across texts and of rows without an id are left out
        self.window = np.flatnonzero(whole & texts.named[self.owner[:n]])
        self.doc = texts.doc[self.owner[self.window]]
        up, down = _powers()
        hashes = word_hashes(texts.buf, self.start, self.end)
        self.sums = np.zeros(len(hashes) + 1, dtype=U64)
        np.cumsum(hashes * up[: len(hashes)], out=self.sums[1:])
        self.down = down
        self.anchor = self._anchors()[self.window] if n else np.zeros(0, dtype=np.int64)
        new = np.ones(len(self.window), dtype=bool)
        new[1:] = (self.anchor[1:] != self.anchor[:-1]) | (np.diff(self.window) != 1)
        #: first window of each run, and the run of each window
        self.run = np.flatnonzero(new)
        self.run_of = np.cumsum(new) - 1

    def hashes(self, at: np.ndarray, words: int) -> np.ndarray:
        return mix((self.sums[at + words] - self.sums[at]) * self.down[at] + U64(words))

    def _anchors(self) -> np.ndarray:
        at = np.arange(len(self.start) - PIECE + 1)
        low = U64((1 << 24) - 1)
        least = self.hashes(at, PIECE) & ~low | at.astype(U64)
        step = 1
        while 2 * step <= PIECES:
            least = np.minimum(least[:-step], least[step:])
            step *= 2
        if PIECES > step:
            least = np.minimum(least[: step - PIECES], least[PIECES - step :])
        return (least & low).astype(np.int64)

    def flagged(self, anchors: Mapped, bits: int) -> np.ndarray:
        """Which windows have an anchor that occurs in two documents."""
        if not len(self.run):
            return np.zeros(0, dtype=np.int64)
        unique, back = np.unique(self.hashes(self.anchor[self.run], PIECE), return_inverse=True)
        known = anchors.find(unique, _shard(unique, bits))[0] >= 0
        return np.flatnonzero(known[back][self.run_of])


def chunks(batches) -> Iterator[tuple[Texts, Chunk]]:
    for rows in text_slices(batches):
        texts = Texts(rows)
        for begin in range(0, len(texts.start), CHUNK):
            yield texts, Chunk(texts, begin)


def _shard(keys: np.ndarray, bits: int) -> np.ndarray:
    return (keys >> U64(64 - bits)).astype(np.int64)


def _spread(keys: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys in order with the least ``low`` and the greatest ``high``."""
    if not len(keys):
        return keys, low, high
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[first], np.minimum.reduceat(low[order], first), np.maximum.reduceat(high[order], first)


def _counted(pick, bits: int):
    """Sends the keys that ``pick`` finds in a chunk, with their least and greatest document, to their shards."""

    def run(batches):
        held, size = [], 0

        def flush():
            keys, docs = (np.concatenate(x) for x in zip(*held))
            keys, low, high = _spread(keys, docs, docs)
            return arrays.by_shard(_shard(keys, bits), keys, low, high - low)

        for _, part in chunks(batches):
            keys, docs = pick(part)
            if len(keys):
                held.append((keys, docs))
                size += len(keys)
            if size >= GROUP:
                yield flush()
                held, size = [], 0
        if size:
            yield flush()

    return run


def _keep_recurring(store: Mapped):
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
        store.write(shard, keys[keep], low[keep])
        yield pa.RecordBatch.from_arrays([pa.array([shard], pa.int32()), pa.array([int(keep.sum())])], ["shard", "n"])

    return work


def _recurring(docs: DataFrame, pick, store: Mapped, bits: int) -> None:
    found = docs.mapInArrow(_counted(pick, bits), arrays.PACKED)
    arrays.merged(found, _keep_recurring(store), "shard int, n long", 1 << bits).agg(F.sum("n")).collect()


_PASSAGES = "first long, kind int, row long, text long, begin long, phrase binary"


def _passages(anchors: Mapped, windows: Mapped, bits: int):
    """Runs of recurring windows: phrases of first documents (kind 0) and passages of the others (kind 1)."""

    def run(batches):
        for rows in text_slices(batches):
            texts, out, keys = Texts(rows), [], {}
            for begin in range(0, len(texts.start), CHUNK):
                part = Chunk(texts, begin)
                on = part.flagged(anchors, bits)
                if not len(on):
                    continue
                unique, back = np.unique(part.hashes(part.window[on], WINDOW), return_inverse=True)
                place, low = windows.find(unique, _shard(unique, bits))
                hit = (place >= 0)[back]
                at, low, doc = part.window[on][hit], low[back][hit], part.doc[on][hit]
                if not len(at):
                    continue
                owner = part.owner[at]
                new = np.ones(len(at), dtype=bool)
                new[1:] = (np.diff(at) != 1) | (low[1:] != low[:-1]) | (owner[1:] != owner[:-1])
                first = np.flatnonzero(new)
                last = np.append(first[1:], len(at)) - 1
                for a, b in zip(first.tolist(), last.tolist()):
                    i, kind = int(owner[a]), int(low[a] < doc[a])
                    if i not in keys and kind:
                        keys[i] = texts.row_keys(i)
                    key, text = keys[i] if kind else (0, 0)
                    word = part.begin + int(at[a]) - int(texts.first[i])
                    phrase = texts.buf[part.start[at[a]] : part.end[at[b] + WINDOW - 1]].tobytes()
                    out.append((low[a], kind, key, text, word, phrase))
            if out:
                low, kind, key, text, word, phrase = zip(*out)
                signed = lambda x: pa.array(np.array(x, dtype=U64).view(np.int64))
                first = pa.array((np.array(low, dtype=U64) ^ SIGN).view(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [first, pa.array(kind, pa.int32()), signed(key), signed(text), pa.array(word, pa.int64()), pa.array(phrase, pa.binary())],
                    ["first", "kind", "row", "text", "begin", "phrase"],
                )

    return run


class Automaton:
    """Every window of some phrases, as sequences of word numbers."""

    def __init__(self, phrases: list[list[bytes]]):
        self.number: dict[bytes, int] = {}
        self.found = ahocorasick.Automaton(ahocorasick.STORE_INTS, ahocorasick.KEY_SEQUENCE)
        for words in phrases:
            numbers = tuple([self.number.setdefault(w, len(self.number) + 1) for w in words])
            for k in range(len(numbers) - WINDOW + 1):
                self.found.add_word(numbers[k : k + WINDOW], 1)
        self.found.make_automaton()

    def spans(self, words: list[bytes]) -> list[list[int]]:
        """Runs of words covered by occurrences, in order."""
        get, out = self.number.get, []
        if not len(self.found):
            return out
        for last, _ in self.found.iter(tuple([get(w, 0) for w in words])):
            begin = last - WINDOW + 1
            if out and begin <= out[-1][1]:
                out[-1][1] = last + 1
            else:
                out.append([begin, last + 1])
        return out


class Shard:
    """The phrases of one shard, in blocks with an automaton each, and the passages that wait for them."""

    def __init__(self):
        self.blocks, self.windows, self.only = [[]], 0, None
        self.waiting, self.size = [], 0

    def learn(self, phrase: bytes) -> None:
        words = phrase.split()
        for k in range(0, len(words) - WINDOW + 1, BLOCK):
            piece = words[k : k + BLOCK + WINDOW - 1]
            if self.windows and self.windows + len(piece) > BLOCK + WINDOW:
                self.blocks.append([])
                self.windows = 0
            self.blocks[-1].append(piece)
            self.windows += len(piece) - WINDOW + 1

    def drain(self) -> Iterator[tuple[int, int, int, int]]:
        """Row, text hash, begin and end of what the waiting passages repeat."""
        for block in self.blocks if self.waiting else ():
            automaton = self.only or Automaton(block)
            self.only = automaton if len(self.blocks) == 1 else None
            for row, text, begin, phrase in self.waiting:
                for a, b in automaton.spans(phrase.split()):
                    yield row, text, begin + a, begin + b
        self.waiting, self.size = [], 0


def _located(bits: int):
    """Streams the passages of each shard past its automata; spans go to the shard of their row."""

    def packed(found):
        row, text, begin, end = (np.array(x, dtype=np.int64) for x in zip(*found))
        row, span = row.view(U64), (begin.astype(U64) << U64(32)) | (end - begin).astype(U64)
        order = np.lexsort((span, row))
        row, text, span = row[order], text.view(U64)[order], span[order]
        return arrays.by_shard(_shard(row, bits), row, text, span)

    def run(batches):
        now, shard, found = None, Shard(), []
        columns = ("shard", "salt", "kind", "row", "text", "begin", "phrase")
        for batch in batches:
            for number, salt, kind, row, text, begin, phrase in zip(*(batch.column(c).to_pylist() for c in columns)):
                if (number, salt) != now:
                    found.extend(shard.drain())
                    now, shard = (number, salt), Shard()
                if kind == 0:
                    shard.learn(phrase)
                else:
                    shard.waiting.append((row, text, begin, phrase))
                    shard.size += len(phrase)
                    if shard.size >= PENDING:
                        found.extend(shard.drain())
            if len(found) >= GROUP // 10:
                yield packed(found)
                found = []
        found.extend(shard.drain())
        if found:
            yield packed(found)

    return run


class Spans:
    """Files of the spans to remove, ordered by row, mapped into memory when first used."""

    def __init__(self, path: str, bits: int):
        self.path, self.bits, self.open = path, bits, {}

    def __getstate__(self):
        return self.__dict__ | {"open": {}}

    def store(self, shard, held):
        parts = [arrays.unpack(data, 3) for data in held]
        rows = np.stack([np.concatenate([p[k] for p in parts]) for k in range(3)])
        rows = rows[:, np.lexsort(rows[::-1])]
        rows = rows[:, np.append(True, (np.diff(rows) != 0).any(axis=0))]  # repeated rows give the same spans
        write_file(f"{self.path}/spans-{shard:06d}", np.array([rows.shape[1]], dtype="<u8"), rows.astype("<u8"))
        yield pa.RecordBatch.from_arrays([pa.array([shard], pa.int32()), pa.array([rows.shape[1]])], ["shard", "n"])

    def of(self, row: int, text: int) -> np.ndarray:
        """Begin and end of the spans of a row."""
        shard = row >> (64 - self.bits)
        if shard not in self.open:
            name = f"{self.path}/spans-{shard:06d}"
            data = np.memmap(name, dtype="<u8", mode="r")[1:] if os.path.exists(name) else np.zeros(0, dtype="<u8")
            self.open[shard] = data.reshape(3, -1)
        rows, texts, spans = self.open[shard]
        a, b = np.searchsorted(rows, U64(row), "left"), np.searchsorted(rows, U64(row), "right")
        mine = spans[a:b][texts[a:b] == U64(text)]
        begin = (mine >> U64(32)).astype(np.int64)
        return np.stack([begin, begin + (mine & U64(0xFFFFFFFF)).astype(np.int64)])


def locate(docs: DataFrame) -> Spans:
    """The spans of words to remove from each row of ``doc_id`` and ``text``."""
    spark = docs.sparkSession
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = max(1, int(size // SHARD_BYTES).bit_length())
    path = mounted(shared_folder(spark, "phrases"))
    anchors, windows = Mapped(path, "anchors", "<u1"), Mapped(path, "windows", "<u8")
    _recurring(docs, lambda c: (c.hashes(c.anchor[c.run], PIECE), c.doc[c.run]), anchors, bits)

    def of_windows(part: Chunk):
        on = part.flagged(anchors, bits)
        return part.hashes(part.window[on], WINDOW), part.doc[on]

    _recurring(docs, of_windows, windows, bits)
    found = staged(docs.mapInArrow(_passages(anchors, windows, bits), _PASSAGES), "passages")
    weight = F.octet_length("phrase")
    learned = found.agg(F.sum(F.when(F.col("kind") == 0, weight))).first()[0] or 0
    shards = max(1, -(-learned // PHRASE_BYTES))
    found = found.withColumn("shard", F.pmod(F.xxhash64("first"), F.lit(shards)))
    streamed = F.sum(F.when(F.col("kind") == 1, weight).otherwise(0))
    tasks = found.groupBy("shard").agg((F.floor(streamed / STREAM_BYTES) + 1).cast("int").alias("tasks"))
    found = found.join(tasks, "shard")
    every, one = F.sequence(F.lit(0), F.col("tasks") - 1), F.array(F.pmod(F.xxhash64("row", "begin"), F.col("tasks")).cast("int"))
    found = found.withColumn("salt", F.explode(F.when(F.col("kind") == 0, every).otherwise(one))).drop("tasks", "first")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = found.repartition(parts, "shard", "salt").sortWithinPartitions("shard", "salt", "kind")
    spans = Spans(path, bits)
    located = dealt.mapInArrow(_located(bits), arrays.PACKED)
    arrays.merged(located, spans.store, "shard int, n long", 1 << bits).agg(F.sum("n")).collect()
    return spans


def remove_phrases(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``n_words``, ``spans`` (begin, end in words) removed, and the ``kept`` words of every row.

    A word goes if a window of ``WINDOW`` words covers it whose words, in order,
    also start in a document with a smaller doc_id; windows are judged on the
    input and do not cross documents.  Kept words are joined by one space.  A null
    text has no words.  Rows without an id are kept whole and cause no removal; of
    rows that repeat an id neither is the earlier.  An empty table gives no rows,
    and other columns of the input are ignored.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    spans = locate(rows)
    kind = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))

    def run(batches):
        for batch in text_slices(batches):
            texts = Texts(batch)
            removed, kept = [], []
            for i, named in enumerate(texts.named.tolist()):
                words = texts.text(i).split()
                mine = spans.of(*texts.row_keys(i)) if named and len(words) >= WINDOW else np.zeros((2, 0), dtype=np.int64)
                if mine.shape[1]:
                    steps = np.bincount(mine[0], minlength=len(words) + 1) - np.bincount(mine[1], minlength=len(words) + 1)
                    gone = np.cumsum(steps)[:-1] > 0
                    edges = np.flatnonzero(np.diff(np.concatenate([[False], gone, [False]]).astype(np.int8)))
                    removed.append([{"begin": a, "end": b} for a, b in edges.reshape(-1, 2).tolist()])
                    words = list(compress(words, (~gone).tolist()))
                else:
                    removed.append([])
                kept.append(b" ".join(words))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(np.diff(texts.first)), pa.array(removed, kind), pa.array(kept, pa.binary()).cast(pa.string())],
                ["doc_id", "n_words", "spans", "kept"],
            )

    return rows.mapInArrow(run, "doc_id long, n_words long, spans array<struct<begin:long,end:long>>, kept string")
