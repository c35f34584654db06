"""Interpolated modified Kneser-Ney bigram model, counted in Spark.

Words and pairs are counted in the tasks that read the text, merged by shard and
stored as sorted hash arrays in the shared folder; the workers that score texts
map the files into memory.  A word's number is its place in the hash order, and a
pair's key is made of two numbers, so that the pairs of a context lie together.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillmart.llm import arrays
from rillmart.llm.arrays import Mapped
from rillmart.llm.common import U64, Words, mounted, shared_folder, staged, strings, text_slices

END = U64(0x1F83D9ABFB41BD6B)  # hash of the token that ends every text
GROUP = 5_000_000  # tokens combined at once in a task; results do not depend on it


def tokens(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of all texts, each with its end token, and where each text begins."""
    words = Words(texts)
    counts = np.diff(words.first) + 1
    first = np.concatenate([[0], np.cumsum(counts)])
    out = np.full(first[-1], END, dtype=U64)
    if len(words.start):
        out[np.arange(len(words.start)) + words.text_of_word()] = words.hashes()
    return out, first


class Discounts(NamedTuple):
    """Modified Kneser-Ney discounts of counts 1, 2 and 3 or more."""

    one: float
    two: float
    more: float

    @classmethod
    def of(cls, n: list[int]) -> Discounts:
        """From the numbers of keys counted once, twice, three and four times."""
        n1, n2, n3, n4 = (float(x) for x in n)
        y = n1 / (n1 + 2 * n2) if n1 + 2 * n2 else 0.5
        found = [k - (k + 1) * y * (b / a) if a else y * k for k, (a, b) in enumerate([(n1, n2), (n2, n3), (n3, n4)], 1)]
        return cls(*(float(min(max(d, 0.05 * k), 0.95 * k)) for k, d in enumerate(found, 1)))

    def take(self, counts: np.ndarray) -> np.ndarray:
        return np.choose(np.minimum(counts, 3).astype(np.int64), [0.0, self.one, self.two, self.more])


class Model:
    """A trained model: totals, and the folder of its arrays."""

    def __init__(self, path: str, bits: int):
        self.path, self.bits = path, bits
        self.offsets = np.zeros((1 << bits) + 1, dtype=np.int64)
        self.n_tokens = self.n_pairs = 0
        self.high = self.low = Discounts(0.5, 1.0, 1.5)
        self.low_mass = 1.0
        self.tables: dict[str, Mapped] = {}

    def __getstate__(self):
        return self.__dict__ | {"tables": {}}

    def _table(self, name: str, kind: str) -> Mapped:
        if name not in self.tables:
            self.tables[name] = Mapped(self.path, name, kind)
        return self.tables[name]

    @property
    def n_words(self) -> int:
        return int(self.offsets[-1])

    def shard_of_hash(self, hashes: np.ndarray) -> np.ndarray:
        return (hashes >> U64(64 - self.bits)).astype(np.int64)

    def shard_of_number(self, numbers: np.ndarray) -> np.ndarray:
        """Ranges of numbers; contexts also include one beyond the words, the beginning of a text."""
        return numbers.astype(np.int64) * (1 << self.bits) // (self.n_words + 1)

    def numbers(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number (-1 if unknown) and count in training of each word."""
        unique, back = np.unique(hashes, return_inverse=True)
        shards = self.shard_of_hash(unique)
        place, count = self._table("words", "<i8").find(unique, shards)
        return np.where(place >= 0, place + self.offsets[shards], -1)[back], count[back]

    def pairs(self, numbers: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Context and word of each token; a text's first token follows the beginning."""
        context = np.empty_like(numbers)
        context[1:] = numbers[:-1]
        context[first[:-1]] = self.n_words
        return context, numbers

    def probabilities(self, context: np.ndarray, word: np.ndarray) -> np.ndarray:
        unique, back = np.unique(word, return_inverse=True)
        ends = np.zeros(len(unique))
        ok = unique >= 0
        ends[ok] = self._table("ends", "<i8").find(unique[ok].astype(U64), self.shard_of_number(unique[ok]))[1]
        low = np.full(len(unique), self.low_mass / (self.n_words + 1))
        if self.n_pairs:
            low += (ends - self.low.take(ends)) / self.n_pairs
        low = low[back]
        unique, back = np.unique(context, return_inverse=True)
        stats = np.zeros((len(unique), 4))
        ok = unique >= 0
        keys, shards = unique[ok].astype(U64), self.shard_of_number(unique[ok])
        for k, name in enumerate(("total", "once", "twice", "often")):
            stats[ok, k] = self._table(name, "<i8").find(keys, shards)[1]
        total = np.maximum(stats[:, 0], 1)
        left = np.where(stats[:, 0] > 0, stats[:, 1:] @ np.array(self.high) / total, 1.0)[back]
        out = left * low
        both = np.flatnonzero((context >= 0) & (word >= 0))
        if len(both):
            keys = context[both].astype(U64) << U64(32) | word[both].astype(U64)
            unique, inner = np.unique(keys, return_inverse=True)
            count = self._table("pairs", "<u4").find(unique, self.shard_of_number(unique >> U64(32)))[1][inner]
            out[both] += (count - self.high.take(count)) / total[back][both]
        return out


def _count_words(model: Model):
    def run(batches):
        held, size = [], 0

        def flush():
            found, counts = arrays.combine(np.concatenate(held))
            return arrays.by_shard(model.shard_of_hash(found), found, counts)

        for rows in text_slices(batches):
            held.append(tokens(strings(rows))[0])
            size += len(held[-1])
            if size >= GROUP:
                yield flush()
                held, size = [], 0
        if held:
            yield flush()

    return run


def _count_pairs(model: Model):
    def run(batches):
        held, size = [], 0

        def flush():
            found, counts = arrays.combine(np.concatenate(held))
            return arrays.by_shard(model.shard_of_number(found >> U64(32)), found, counts)

        for rows in text_slices(batches):
            hashes, first = tokens(strings(rows))
            context, word = model.pairs(model.numbers(hashes)[0], first)
            held.append(context.astype(U64) << U64(32) | word.astype(U64))
            size += len(word)
            if size >= GROUP:
                yield flush()
                held, size = [], 0
        if held:
            yield flush()

    return run


def _merge(held: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    parts = [arrays.unpack(data) for data in held]
    return arrays.combine(np.concatenate([k for k, _ in parts]), np.concatenate([v for _, v in parts]))


def _summary(shard: int, counts: np.ndarray) -> list[int]:
    return [shard, len(counts), int(counts.sum()), *(int((counts == k).sum()) for k in (1, 2, 3, 4))]


_SUMMARY = "shard int, n long, total long, n1 long, n2 long, n3 long, n4 long"
_NAMES = [part.split()[0] for part in _SUMMARY.split(", ")]


def _summary_row(values: list[int], **more) -> pa.RecordBatch:
    columns = {n: pa.array([v], pa.int32() if n == "shard" else pa.int64()) for n, v in zip(_NAMES, values)}
    columns |= more
    return pa.RecordBatch.from_arrays(list(columns.values()), list(columns))


def _store(model: Model, name: str):
    def work(shard, held):
        keys, counts = _merge(held)
        model._table(name, "<i8").write(shard, keys, counts)
        yield _summary_row(_summary(shard, counts))

    return work


def _store_pairs(model: Model):
    """Writes a shard's pairs and contexts; passes on how many contexts each word ends."""

    def work(shard, held):
        keys, counts = _merge(held)
        model._table("pairs", "<u4").write(shard, keys, counts)
        context = keys >> U64(32)
        first = np.flatnonzero(np.concatenate([[True], context[1:] != context[:-1]]))
        for name, values in (
            ("total", counts), ("once", counts == 1), ("twice", counts == 2), ("often", counts >= 3)
        ):
            model._table(name, "<i8").write(shard, context[first], np.add.reduceat(values.astype(np.int64), first))
        words, ends = arrays.combine(keys & U64(0xFFFFFFFF))
        sent = arrays.by_shard(model.shard_of_number(words), words, ends)
        yield _summary_row(_summary(shard, counts), to=pa.array([-1], pa.int32()), packed=pa.array([b""], pa.binary()))
        for to, data in zip(sent.column("shard").to_pylist(), sent.column("packed").to_pylist()):
            yield _summary_row([shard, 0, 0, 0, 0, 0, 0], to=pa.array([to], pa.int32()), packed=pa.array([data], pa.binary()))

    return work


def train(docs: DataFrame) -> Model:
    """Count the words and pairs of ``docs`` (``text``); a null text is empty.

    What is gathered grows with the text, and so do the files; the driver gets a
    few numbers for each shard.
    """
    spark = docs.sparkSession
    shards = max(2, int(spark.conf.get("spark.sql.shuffle.partitions")))
    model = Model(mounted(shared_folder(spark, "kneser-ney")), (shards - 1).bit_length())
    shards = 1 << model.bits
    texts = docs.select("text")
    words = texts.mapInArrow(_count_words(model), arrays.PACKED)
    sizes = np.zeros(shards, dtype=np.int64)
    for row in arrays.merged(words, _store(model, "words"), _SUMMARY, shards).collect():
        sizes[row.shard] = row.n
        model.n_tokens += row.total
    model.offsets = np.concatenate([[0], np.cumsum(sizes)])
    if not model.n_tokens:
        return model
    pairs = texts.mapInArrow(_count_pairs(model), arrays.PACKED)
    found = staged(arrays.merged(pairs, _store_pairs(model), f"{_SUMMARY}, to int, packed binary", shards), "pairs")
    sums = found.where("to = -1").agg(*(F.sum(c).alias(c) for c in _NAMES[1:])).first()
    model.high = Discounts.of([sums.n1, sums.n2, sums.n3, sums.n4])
    ends = found.where("to >= 0").select(F.col("to").alias("shard"), "packed")
    ends = arrays.merged(ends, _store(model, "ends"), _SUMMARY, shards)
    sums = ends.agg(*(F.sum(c).alias(c) for c in _NAMES[1:])).first()
    model.n_pairs, model.low = sums.total, Discounts.of([sums.n1, sums.n2, sums.n3, sums.n4])
    often = sums.n - sums.n1 - sums.n2
    model.low_mass = float(np.dot(model.low, [sums.n1, sums.n2, often]) / sums.total)
    return model


def score(docs: DataFrame, model: Model, held_out: Column) -> DataFrame:
    """Each text's log10 probability, and that of a smoothed unigram model for comparison.

    ``doc_id``, ``held_out``, ``n_tokens`` (words and the end), ``n_known`` (those
    seen in training), ``train_tokens``, ``base_score`` and ``score``.  A null text
    is empty and has its end token only.  Null ids and repeated rows are kept; a
    model trained on nothing gives probability 1 to every token.
    """
    schema = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"

    def run(batches):
        for rows in text_slices(batches, limit=4 << 20):
            hashes, first = tokens(strings(rows))
            numbers, counts = model.numbers(hashes)
            base = np.log10((counts + 1) / (model.n_tokens + model.n_words + 1))
            log = np.log10(model.probabilities(*model.pairs(numbers, first)))
            begin, n = first[:-1], rows.num_rows
            yield pa.RecordBatch.from_arrays(
                [
                    rows.column("doc_id"),
                    rows.column("held_out"),
                    pa.array(np.diff(first)),
                    pa.array(np.add.reduceat((counts > 0).astype(np.int64), begin)),
                    pa.array(np.full(n, model.n_tokens)),
                    pa.array(np.add.reduceat(base, begin)),
                    pa.array(np.add.reduceat(log, begin)),
                ],
                [part.split()[0] for part in schema.split(", ")],
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out.alias("held_out"), "text")
    return rows.mapInArrow(run, schema)
