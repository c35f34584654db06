"""Token-id files coded with a static range asymmetric numeral system.

One frequency table, counted over all tokens, serves every block.  A block holds
whole documents; its tokens are dealt over interleaved lanes, each with a 64-bit
state that gives off 32-bit words.  Checkpoints keep the lanes' states and the
place in the words, so that a reader can start at any of them.  Blocks carry
checksums of their bytes and of their tokens.
"""

from __future__ import annotations

import struct
import zlib
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillmart.llm.bpe_trie import _byte_letters as byte_letters
from rillmart.llm.common import U64, shared_folder, text_slices
from rillmart.llm.phrase_automata import word_hashes

SCALE_BITS = 20  # frequencies add up to 2 ** SCALE_BITS
LOW = 1 << 31  # smallest state
LANES = 1024
INTERVAL = 128  # steps between checkpoints
BLOCK_TOKENS = 1 << 18
_HEAD = struct.Struct("<4sIIIIIQII")
_MAGIC = b"RLN1"


class Frequencies:
    """Counts scaled to ``2 ** SCALE_BITS``; every token that occurs keeps at least one slot."""

    def __init__(self, counts: np.ndarray):
        counts = np.asarray(counts, dtype=np.int64)
        total = int(counts.sum())
        size = 1 << SCALE_BITS
        if np.count_nonzero(counts) > size:
            raise ValueError("more tokens than slots")
        exact = counts * (size / max(total, 1))
        freq = np.where(counts > 0, np.maximum(exact.astype(np.int64), 1), 0)
        spare = size - int(freq.sum()) if total else 0
        order = np.argsort(-freq, kind="stable")
        if spare > 0:
            freq[order[0]] += spare
        for i in order:
            if spare >= 0:
                break
            take = min(-spare, int(freq[i]) - 1)
            freq[i] -= take
            spare += take
        self.freq = freq.astype(U64)
        self.begin = (np.cumsum(freq) - freq).astype(U64)
        self.token = np.repeat(np.arange(len(freq)), freq).astype(np.uint32)


def pack(table: Frequencies, doc_ids: np.ndarray, lengths: np.ndarray, tokens: np.ndarray, offset: int) -> bytes:
    """One block: documents' ids and lengths, checkpoints and coded tokens."""
    lanes = min(LANES, max(len(tokens), 1))
    steps = -(-len(tokens) // lanes)
    grid = np.zeros(steps * lanes, dtype=np.uint32)
    grid[: len(tokens)] = tokens
    if len(tokens) < len(grid):
        grid[len(tokens) :] = tokens[0]
    grid = grid.reshape(steps, lanes)
    state = np.full(lanes, LOW, dtype=U64)
    words, written, marks = [], 0, []
    for step in range(steps - 1, -1, -1):
        freq = table.freq[grid[step]]
        full = state >= freq << U64(63 - SCALE_BITS)
        if full.any():
            out = state[full].astype(np.uint32)
            words.append(out)
            written += len(out)
            state[full] >>= U64(32)
        part = state // freq
        state = (part << U64(SCALE_BITS)) + (state - part * freq) + table.begin[grid[step]]
        if step % INTERVAL == 0:
            marks.append((written, state.copy()))
    stream = np.concatenate(words[::-1]).astype("<u4").tobytes() if words else b""
    body = b"".join(
        [
            np.asarray(doc_ids, dtype="<i8").tobytes(),
            np.asarray(lengths, dtype="<u4").tobytes(),
            np.array([written - w for w, _ in marks[::-1]], dtype="<u4").tobytes(),
            b"".join(s.astype("<u8").tobytes() for _, s in marks[::-1]),
            stream,
        ]
    )
    plain = zlib.crc32(tokens.astype("<u4").tobytes())
    return _HEAD.pack(_MAGIC, len(doc_ids), len(tokens), lanes, steps, written, offset, plain, zlib.crc32(body)) + body


class Block:
    """A block read back; ``segment`` decodes from one checkpoint to the next."""

    def __init__(self, data: bytes):
        magic, docs, self.n, self.lanes, self.steps, written, self.offset, self.plain, check = _HEAD.unpack_from(data)
        body = memoryview(data)[_HEAD.size :]
        if magic != _MAGIC or zlib.crc32(body) != check:
            raise ValueError("damaged block")
        self.segments = -(-self.steps // INTERVAL)
        at = 0

        def take(kind: str, count: int) -> np.ndarray:
            nonlocal at
            out = np.frombuffer(body, dtype=kind, count=count, offset=at)
            at += out.nbytes
            return out

        self.doc_ids = take("<i8", docs)
        self.lengths = take("<u4", docs).astype(np.int64)
        self.places = take("<u4", self.segments)
        self.states = take("<u8", self.segments * self.lanes).reshape(self.segments, self.lanes)
        self.words = take("<u4", written)

    def segment(self, table: Frequencies, k: int) -> np.ndarray:
        first, last = k * INTERVAL, min((k + 1) * INTERVAL, self.steps)
        out = np.empty((last - first, self.lanes), dtype=np.uint32)
        state, at = self.states[k].astype(U64), int(self.places[k])
        for row in out:
            slot = state & U64((1 << SCALE_BITS) - 1)
            token = table.token[slot]
            row[:] = token
            state = table.freq[token] * (state >> U64(SCALE_BITS)) + slot - table.begin[token]
            need = np.flatnonzero(state < U64(LOW))
            if len(need):
                state[need] = state[need] << U64(32) | self.words[at : at + len(need)].astype(U64)
                at += len(need)
        return out.ravel()

    def tokens(self, table: Frequencies) -> np.ndarray:
        parts = [self.segment(table, k) for k in range(self.segments)]
        out = np.concatenate(parts)[: self.n] if parts else np.zeros(0, dtype=np.uint32)
        if zlib.crc32(out.astype("<u4").tobytes()) != self.plain:
            raise ValueError("tokens differ from those written")
        return out


_BREAK = "<|endoftext|>"
SLICE = 1_900_000
KNOWN = 1_500_000  # chunks remembered by a worker; forgotten all at once beyond, never skipped
KNOWN_BYTES = 64 << 20  # and bytes of them

#: Bytes that begin a character which is surely not white space; a space before one is a place to cut.
_OPENS = np.ones(256, dtype=bool)
_OPENS[[*range(9, 14), *range(28, 33), 0xC2, 0xE1, 0xE2, 0xE3]] = False
_LETTER = np.zeros(256, dtype=bool)
_LETTER[[*range(65, 91), *range(97, 123)]] = True
_MARK = np.zeros(256, dtype=bool)
_MARK[[c for c in range(33, 127) if not chr(c).isalnum()]] = True


def cuts(buf: np.ndarray) -> np.ndarray:
    """Places where the byte-level pattern always cuts, so that what lies between can be encoded alone.

    These are a space before a character that is surely not white, a mark or line's
    end after a letter, and a letter after a line's end that follows a letter or mark.
    """
    cut = np.zeros(len(buf) + 1, dtype=bool)
    if not len(buf):
        return cut
    line, letter = buf == 10, _LETTER[buf]
    cut[: len(buf) - 1] = (buf[:-1] == 32) & _OPENS[buf[1:]]
    cut[1:-1] |= letter[:-1] & (_MARK[buf[1:]] | line[1:])
    cut[2:-1] |= (letter | _MARK[buf])[:-2] & line[1:-1] & letter[2:]
    raw, at = buf.tobytes(), -1
    while (at := raw.find(_BREAK.encode(), at + 1)) >= 0:
        cut[at + 1 : at + len(_BREAK)] = False
    return cut


def _flat(begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Places of the spans ``begin`` to ``begin + size``, one after another."""
    done = np.cumsum(size, dtype=np.int64)
    return np.repeat(begin - done + size, size) + np.arange(int(done[-1]) if len(done) else 0)


class Memory:
    """Encodings of chunks in flat arrays: hashes in order, and for each the chunk's bytes and its ids."""

    def __init__(self, kind: str):
        self.keys = np.zeros(0, dtype=U64)
        self.row, self.begin, self.size, self.at, self.count = (np.zeros(0, dtype=np.int32) for _ in range(5))
        self.bytes, self.ids = np.zeros(0, dtype=np.uint8), np.zeros(0, dtype=kind)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Row of each key, -1 where it is new; ``keys`` are distinct and in order."""
        if not len(self.keys):
            return np.full(len(keys), -1)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.row[at], -1)

    def add(self, keys: np.ndarray, chunks: list[bytes], ids: list[list[int]]) -> None:
        place, new = np.searchsorted(self.keys, keys), len(self.size) + np.arange(len(keys), dtype=np.int32)
        self.keys, self.row = np.insert(self.keys, place, keys), np.insert(self.row, place, new)
        size, count = np.array(list(map(len, chunks))), np.array(list(map(len, ids)))
        held = lambda old, values: np.concatenate([old, values.astype(old.dtype)])
        self.begin = held(self.begin, len(self.bytes) + np.cumsum(size) - size)
        self.at = held(self.at, len(self.ids) + np.cumsum(count) - count)
        self.size, self.count = held(self.size, size), held(self.count, count)
        self.bytes = held(self.bytes, np.frombuffer(b"".join(chunks), dtype=np.uint8))
        self.ids = held(self.ids, np.fromiter(chain.from_iterable(ids), dtype=np.int64))


class Tokens:
    """The tokenizers library with a memory of chunks.

    A chunk is what lies between two ``cuts``.  Chunks are found and hashed for a
    whole slice of texts at once, the library encodes new ones only, and the bytes of
    every chunk are compared with those remembered.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.size = self.library.get_vocab_size()
        self.kind = "<u2" if self.size <= 1 << 16 else "<u4"
        self.break_id = self.library.token_to_id(_BREAK)
        self.known = Memory(self.kind)
        self.letters = {b: c for c, b in byte_letters().items()}

    def _library(self, chunks: list[bytes]) -> list[list[int]]:
        """Encode distinct chunks: words by the library's model alone, others in calls of some at once.

        The pattern takes a word and the space before it as one piece.  The special
        token between other chunks keeps them apart.
        """
        out: list = [None] * len(chunks)
        model, letters, others = self.library.model, self.letters, []
        for k, chunk in enumerate(chunks):
            text = chunk.decode()
            word = text[1:] if text[:1] == " " else text
            if word.isalpha() and max(word) < "ɐ":
                piece = "".join([letters[b] for b in chunk]) if not chunk.isascii() else letters[32] + word if word != text else word
                out[k] = [t.id for t in model.tokenize(piece)]
            elif self.break_id is not None and _BREAK not in text:
                others.append((k, text))
            else:
                out[k] = self.library.encode(text, add_special_tokens=False).ids
        for begin in range(0, len(others), 200):
            some = others[begin : begin + 200]
            ids = self.library.encode(_BREAK.join([x for _, x in some]), add_special_tokens=False).ids
            breaks = [n for n, i in enumerate(ids) if i == self.break_id]
            for (k, _), a, b in zip(some, [0, *(n + 1 for n in breaks)], [*breaks, len(ids)]):
                out[k] = ids[a:b]
        return out

    def _group(self, buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of neighbouring chunks, and how many each has."""
        raw = buf[start[0] : end[-1]].tobytes()
        begin, size = start - start[0], end - start
        chunk = lambda k: raw[begin[k] : begin[k] + size[k]]
        keys, first, back = np.unique(word_hashes(buf, start, end), return_index=True, return_inverse=True)
        known = self.known
        if len(known.keys) > KNOWN or len(known.bytes) > KNOWN_BYTES:
            known = self.known = Memory(self.kind)
        rows = known.find(keys)
        new = np.flatnonzero(rows < 0)
        if len(new):
            some = first[new]
            chunks = [raw[a:b] for a, b in zip(begin[some].tolist(), (begin + size)[some].tolist())]
            known.add(keys[new], chunks, self._library(chunks))
            rows = known.find(keys)
        rows = rows[back]
        same = known.size[rows] == size
        if same.all():
            told = known.bytes[_flat(known.begin[rows], size)] == np.frombuffer(raw, dtype=np.uint8)
            same = np.logical_and.reduceat(told, begin)
        else:
            same = np.array([known.bytes[known.begin[r] : known.begin[r] + known.size[r]].tobytes() == chunk(k) for k, r in enumerate(rows.tolist())])
        count = known.count[rows]
        if same.all():
            return known.ids[_flat(known.at[rows], count)], count
        # equal hashes of different chunks: these are encoded one by one
        parts = [
            known.ids[known.at[r] : known.at[r] + known.count[r]] if fits else np.array(self._library([chunk(k)])[0], dtype=self.kind)
            for k, (r, fits) in enumerate(zip(rows.tolist(), same.tolist()))
        ]
        return np.concatenate(parts), np.array([len(p) for p in parts])

    def encode_rows(self, column: pa.Array, end: int) -> pa.Array:
        """Ids of each text with ``end`` after them, in the smallest kind of number that holds the vocabulary."""
        column = pc.fill_null(column, "").cast(pa.large_binary())
        _, offsets, data = column.buffers()
        at = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
        buf = np.frombuffer(data or b"", dtype=np.uint8)[at[0] : at[-1]]
        at = at - at[0]
        cut = cuts(buf)
        cut[np.maximum(at[1:] - 1, 0)] = False  # a last byte is judged without the text that follows
        cut[at[:-1]] = True
        start = np.flatnonzero(cut[:-1])
        stop = np.append(start[1:], len(buf))[: len(start)]
        bounds = np.flatnonzero(np.diff(start // SLICE)) + 1 if len(start) else []
        parts, counts = [np.zeros(0, dtype=self.kind)], [np.zeros(0, dtype=np.int64)]
        for a, b in zip([0, *bounds], [*bounds, len(start)]) if len(start) else ():
            ids, count = self._group(buf, start[a:b], stop[a:b])
            parts.append(ids)
            counts.append(count)
        before = np.append(0, np.cumsum(np.concatenate(counts)))
        # ids before each text, and one end for each text before
        whole = before[np.searchsorted(start, at)]
        ids = np.insert(np.concatenate(parts), whole[1:], end)
        offsets = (whole + np.arange(len(whole))) * np.dtype(self.kind).itemsize
        places = pa.py_buffer(offsets.astype(np.int64).tobytes())
        return pa.Array.from_buffers(pa.large_binary(), len(column), [None, places, pa.py_buffer(ids.astype(self.kind).tobytes())]).cast(pa.binary())

    def encode(self, texts: list[str], end: int) -> list[bytes]:
        """``encode_rows`` of plain texts, as unsigned 32-bit numbers."""
        found = self.encode_rows(pa.array(texts, pa.string()), end).to_pylist()
        return [np.frombuffer(x, dtype=self.kind).astype("<u4").tobytes() for x in found]


@lru_cache(maxsize=1)
def tokenizer(path: str) -> Tokens:
    return Tokens(path)


def _tokenise(vocabulary: str, end: int, bounds: np.ndarray):
    def run(batches):
        coder = tokenizer(vocabulary)
        for rows in text_slices(batches, limit=SLICE):
            ids = coder.encode_rows(rows.column("text"), end)
            keys = np.asarray(pc.fill_null(rows.column("doc_id"), -(1 << 63)))
            part = np.searchsorted(bounds, keys, side="left").astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [pa.array(part), rows.column("doc_id"), ids], ["part", "doc_id", "ids"]
            )

    return run


def _place(kind: str):
    """Adds to each row of a sorted part the number of tokens before it."""

    def run(batches):
        tokenizer.cache_clear()  # reused workers need its memory of chunks no more
        width, offset, last = np.dtype(kind).itemsize, 0, None
        for rows in batches:
            sizes = np.asarray(pc.binary_length(rows.column("ids")), dtype=np.int64) // width
            parts = np.asarray(rows.column("part"))
            begin = np.empty(len(sizes), dtype=np.int64)
            for k, (part, size) in enumerate(zip(parts.tolist(), sizes.tolist())):
                offset, last = (offset, last) if part == last else (0, part)
                begin[k] = offset
                offset += size
            yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(begin)], ["part", "doc_id", "ids", "begin"])

    return run


def _count(kind: str, size: int):
    def run(batches):
        tokenizer.cache_clear()
        counts = np.zeros(size, dtype=np.int64)
        for rows in batches:
            for ids in rows.column("ids"):
                counts += np.bincount(np.frombuffer(ids.as_buffer(), dtype=kind), minlength=size)
        on = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(on), pa.array(counts[on])], ["token", "n"])

    return run


def _write(counts, kind: str):
    def run(batches):
        tokenizer.cache_clear()
        table = Frequencies(counts.value)
        docs, held, size, offset, part, due = [], [], 0, 0, None, None

        def flush():
            nonlocal docs, held, size
            tokens = np.concatenate(held).astype(np.uint32)
            data = pack(table, np.array(docs), np.array([len(x) for x in held]), tokens, offset)
            docs, held, size = [], [], 0
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([offset], pa.int64()), pa.array([len(tokens)], pa.int64()),
                 pa.array([data], pa.binary())],
                ["part", "begin", "n_tokens", "block"],
            )

        for rows in batches:
            for p, doc, ids, begin in zip(*(rows.column(k) for k in ("part", "doc_id", "ids", "begin"))):
                p, doc, begin = p.as_py(), doc.as_py(), begin.as_py()
                if size and (size >= BLOCK_TOKENS or p != part or begin != due):
                    yield flush()
                if not size:
                    part, offset = p, begin
                ids = np.frombuffer(ids.as_buffer(), dtype=kind)
                docs.append(-(1 << 63) if doc is None else doc)
                held.append(ids)
                size += len(ids)
                due = begin + len(ids)
        if size:
            yield flush()

    return run


def write_tokens(docs: DataFrame, path: str, vocabulary: str, *, end: int = 0) -> None:
    """Write all documents' ids, ``end`` after each, to ``path`` in ascending doc_id order.

    Folders ``part=k`` are ranges of ids in order; their files hold blocks as
    rows (``begin``, ``n_tokens``, ``block``), so that Spark's committer and any
    of its file systems serve them.  The counts by token lie beside them, so that
    the files can be read alone.  Null ids come first, rows with the same id in the
    order of their ids.  A null text is empty and has the end id only.
    """
    spark = docs.sparkSession
    kind, size = tokenizer(vocabulary).kind, tokenizer(vocabulary).size
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    cuts = rows.select(F.percentile_approx("doc_id", [k / parts for k in range(1, parts)] or [0.5], 10_000)).first()[0]
    bounds = np.unique(np.array(cuts or [0], dtype=np.int64))
    dealt = rows.mapInArrow(_tokenise(vocabulary, end, bounds), "part int, doc_id long, ids binary")
    dealt = dealt.repartitionById(len(bounds) + 1, F.col("part")).sortWithinPartitions("part", "doc_id", "ids")
    # written once, closely packed, for the count and for the blocks
    raw = shared_folder(spark, "tokens")
    schema = "part int, doc_id long, ids binary, begin long"
    dealt.mapInArrow(_place(kind), schema).write.option("compression", "zstd").parquet(raw)
    placed = spark.read.schema(schema).parquet(raw)
    found = placed.select("ids").mapInArrow(_count(kind, size), "token long, n long")
    found.groupBy("token").agg(F.sum("n").alias("n")).coalesce(1).write.parquet(f"{path}/table")
    shared = spark.sparkContext.broadcast(_counts(spark, path, size))
    blocks = placed.mapInArrow(_write(shared, kind), "part int, begin long, n_tokens long, block binary")
    blocks.write.option("compression", "none").partitionBy("part").parquet(f"{path}/blocks")


def _counts(spark, path: str, size: int = 0) -> np.ndarray:
    """Counts by token, as stored beside the blocks: at most one row a token."""
    rows = spark.read.schema("token long, n long").parquet(f"{path}/table").collect()
    counts = np.zeros(max([size, *(r.token + 1 for r in rows)]), dtype=np.int64)
    for row in rows:
        counts[row.token] = row.n
    return counts


def read_tokens(spark, path: str) -> DataFrame:
    """``doc_id``, ``start`` (ids of all documents before), and ``ids`` of the documents in the files at ``path``."""
    blocks = spark.read.schema("begin long, n_tokens long, block binary, part int").parquet(f"{path}/blocks")
    sizes = blocks.groupBy("part").agg(F.sum("n_tokens").alias("n")).collect()  # one row a file
    before, total = {}, 0
    for row in sorted(sizes, key=lambda r: r.part):
        before[row.part] = total
        total += row.n
    shared = spark.sparkContext.broadcast((_counts(spark, path), before))

    def run(batches):
        tokenizer.cache_clear()
        table, starts = Frequencies(shared.value[0]), shared.value[1]
        for rows in batches:
            for part, data in zip(rows.column("part").to_pylist(), rows.column("block")):
                block = Block(data.as_buffer())
                tokens = block.tokens(table).astype("<u4")
                ends = np.cumsum(block.lengths)
                begin = ends - block.lengths
                texts = [tokens[i:j].tobytes() for i, j in zip(begin, ends)]
                ids = pa.array(block.doc_ids.astype(np.int64), mask=block.doc_ids == -(1 << 63))
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array(starts[part] + block.offset + begin), pa.array(texts, pa.binary())],
                    ["doc_id", "start", "ids"],
                )

    return blocks.select("part", "block").mapInArrow(run, "doc_id long, start long, ids binary")


def round_trip(docs: DataFrame, vocabulary: str, *, end: int = 0) -> DataFrame:
    """``write_tokens`` to the shared folder, then ``read_tokens``.

    An empty table gives no rows.  Repeated rows are kept; of two with the same
    doc_id each has its own ``start``.
    """
    path = shared_folder(docs.sparkSession, "tokens")
    write_tokens(docs, path, vocabulary, end=end)
    return read_tokens(docs.sparkSession, path)
