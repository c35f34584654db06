"""Toxicity: a convolutional text classifier over hashed word embeddings.

Training starts on the driver and goes on in Spark tasks, each over a shard of the
labelled rows, whose networks are averaged.

A word's vector is the sum of hashed embeddings of the word, its beginnings and
its ending; filters of several widths run over the vectors, and each keeps its
largest answer in the text and, on average, in the text's segments.  Thresholds are
calibrated by language, guessed from the text's own function words, and the
score is shifted so that 0.7 is the threshold of the guessed language.  Labels,
language columns, sources and ids are never inputs of a score.
"""

from __future__ import annotations

import copy
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, DoubleType, IntegerType, LongType, StructField, StructType

from rillmart.llm.common import SLICE_BYTES, U64, Words, crc_part, many_span_hashes, mix, released, staged, strings, text_slices

TRAIN_ROWS = 6000  # labelled rows that training starts from, at most; it goes on with all
TRAIN_BYTES = 24 << 20  # and their text; rows are taken in the order of a hash of their ids
LONG_BYTES = TRAIN_BYTES // 100  # longer texts are taken last, so that a few do not fill the start
SHARD_BYTES = 32 << 20  # text, about, that one task learns from before the networks are averaged
ROUNDS = 4  # averages at most
BLOCK = 1 << 12  # buckets whose changes travel together
SCALE = 1024  # of squares sent as half floats
BINS = 64  # in a logit's unit, for the thresholds
SEEN = 3  # training texts in which a piece of a word occurs at least; other pieces have a zero vector
DROPPED = 0.15  # share of the words left out at random in training
BUCKETS = 1 << 17
DIM = 16
PREFIXES = (4, 5, 6, 7)  # bytes of a word's beginnings that are hashed beside the word
SUFFIX = 5  # and of its ending
WIDTHS = (1, 2, 3)
FILTERS = 4  # of each width
SEGMENT = 32  # words; each filter keeps its largest answer in each
EPOCHS = 8  # passes over the rows of each network's training
STEPS = 160  # and batches at least
FOLDS = 3
BATCH = 64
DECISION = 0.7
SUMS = StructType(
    [
        StructField("net", IntegerType()),
        StructField("task", IntegerType()),
        StructField("block", IntegerType()),  # -1: all but the embeddings, -2: texts of the network's own fold by piece
        StructField("sums", BinaryType()),
    ]
)
LOGITS = StructType([StructField(name, LongType()) for name in ("language", "toxic", "bin", "n")])
PAD = BUCKETS  # index of the zero vector between texts

#: Frequent function words of each language.
FUNCTION_WORDS = {
    "en": "the of and to in is that it for was on with as by at from this an are be",
    "de": "der die und das ist von den mit zu im für auf ein eine nicht auch es dem sich des",
    "fr": "le la les de des et un une que qui dans pour pas est sur au aux du en ce",
    "es": "el la los las de que y en un una por con para es del se lo su al como",
}
_CLEAN = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or chr(b).isalnum() else 32 for b in range(256)
)


class Texts(NamedTuple):
    """Buckets of several texts' words, each text filled up to whole segments with at least two zero vectors."""

    words: np.ndarray  # distinct words x pieces; the first is no word, all zero vectors
    index: np.ndarray  # word at each place
    segments: np.ndarray  # of each text
    language: np.ndarray  # index into FUNCTION_WORDS, or their number


@lru_cache(maxsize=1)
def _function_hashes() -> list[np.ndarray]:
    lists = [words.split() for words in FUNCTION_WORDS.values()]
    seen = [w for words in lists for w in words]
    own = [[w for w in words if seen.count(w) == 1] for words in lists]
    return [np.sort(Words([" ".join(words)], clean=_CLEAN).hashes()) for words in own]


def prepare(texts: list[str]) -> Texts:
    words = Words([text.lower() for text in texts], clean=_CLEAN)
    counts = np.diff(words.first)
    segments = (counts + 2 + SEGMENT - 1) // SEGMENT
    owner = words.text_of_word()
    begin = (np.cumsum(segments) - segments) * SEGMENT
    place = np.arange(len(owner)) - words.first[:-1][owner] + begin[owner]
    hashes = words.hashes()
    unique, where, back = np.unique(hashes, return_index=True, return_inverse=True)
    start, end = words.start[where], words.end[where]
    spans = [(start, np.minimum(start + k, end)) for k in PREFIXES] + [(np.maximum(end - SUFFIX, start), end)]
    table = np.full((len(unique) + 1, 2 + len(PREFIXES)), PAD, dtype=np.int32)
    table[1:, 0] = unique >> U64(47)
    for k, found in enumerate(many_span_hashes(words.buf, spans)):
        table[1:, k + 1] = mix(found + U64(k + 1)) >> U64(47)
    index = np.zeros(int(segments.sum()) * SEGMENT, dtype=np.int32)
    index[place] = back + 1
    votes = np.zeros((len(counts), len(FUNCTION_WORDS)))
    for k, own in enumerate(_function_hashes()):
        near = np.minimum(np.searchsorted(own, unique), len(own) - 1)
        votes[:, k] = np.bincount(owner[(own[near] == unique)[back]], minlength=len(counts))
    language = np.where(votes.max(axis=1) > 0, votes.argmax(axis=1), len(FUNCTION_WORDS))
    return Texts(table, index, segments, language)


def merge(parts: list[Texts]) -> Texts:
    """Several groups of texts as one."""
    words, index, offset = [parts[0].words[:1]], [], 0
    for part in parts:
        words.append(part.words[1:])
        index.append(np.where(part.index > 0, part.index + offset, 0).astype(np.int32))
        offset += len(part.words) - 1
    return Texts(
        np.concatenate(words),
        np.concatenate(index),
        np.concatenate([p.segments for p in parts]),
        np.concatenate([p.language for p in parts]),
    )


class Network:
    def __init__(self, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.embed = rng.normal(0, 0.1, (BUCKETS + 1, DIM)).astype(np.float32)
        self.embed[PAD] = 0
        self.filters = [rng.normal(0, 0.25, (w, DIM, FILTERS)).astype(np.float32) for w in WIDTHS]
        self.bias = np.zeros(FILTERS * len(WIDTHS), dtype=np.float32)
        self.of_text = rng.normal(0, 0.2, FILTERS * len(WIDTHS)).astype(np.float32)
        self.of_segments = rng.normal(0, 0.2, FILTERS * len(WIDTHS)).astype(np.float32)
        self.base = np.float32(-1.5)
        self.known = np.arange(BUCKETS + 1) != PAD

    def keep(self, texts: Texts, chosen: np.ndarray) -> None:
        """Leave a vector only to the pieces that occur in ``SEEN`` of the chosen texts."""
        seen = np.zeros(BUCKETS + 1, dtype=np.int64)
        count_pieces(texts, chosen, np.zeros(len(texts.segments), dtype=np.int64), seen[None])
        self.forget(seen)

    def forget(self, seen: np.ndarray) -> None:
        """Leave a vector only to the pieces that were seen in ``SEEN`` texts."""
        self.known = (seen >= SEEN) & (np.arange(BUCKETS + 1) != PAD)
        self.embed[~self.known] = 0

    def answers(self, texts: Texts) -> tuple[np.ndarray, np.ndarray]:
        """Vectors of the distinct words, and each filter's answer at each place of each segment."""
        vectors = self.embed[texts.words[:, 0]]
        for k in range(1, texts.words.shape[1]):
            vectors += self.embed[texts.words[:, k]]
        index = texts.index.astype(np.intp)
        maps = np.empty((len(self.bias), len(index)), dtype=np.float32)
        for w, (width, bank) in enumerate(zip(WIDTHS, self.filters)):
            for j in range(width):
                for f, row in enumerate(np.ascontiguousarray((vectors @ bank[j]).T), start=w * FILTERS):
                    if j:
                        maps[f, :-j] += row[index[j:]]
                    else:
                        np.take(row, index, out=maps[f], mode="clip")
        return vectors, maps.reshape(len(self.bias), -1, SEGMENT)

    def pool(self, largest: np.ndarray, texts: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Largest answers of each text, mean of its segments' largest answers, and the logit."""
        first = np.cumsum(texts.segments) - texts.segments
        whole = np.maximum.reduceat(largest, first, axis=0) + self.bias
        mean = np.add.reduceat(np.maximum(largest + self.bias, 0), first, axis=0) / texts.segments[:, None]
        return whole, mean, np.maximum(whole, 0) @ self.of_text + mean @ self.of_segments + self.base

    def logits(self, texts: Texts) -> np.ndarray:
        if not len(texts.segments):
            return np.zeros(0)
        return self.pool(self.answers(texts)[1].max(axis=2).T, texts)[2].astype(np.float64)


def _subset(texts: Texts, chosen: np.ndarray) -> Texts:
    first = np.cumsum(texts.segments) - texts.segments
    segments = texts.segments[chosen]
    own = np.repeat(first[chosen] - (np.cumsum(segments) - segments), segments) + np.arange(segments.sum())
    index = texts.index.reshape(-1, SEGMENT)[own].ravel()
    used, index = np.unique(np.append(0, index), return_inverse=True)
    return Texts(texts.words[used], index[1:], segments, texts.language[chosen])


def count_pieces(texts: Texts, chosen: np.ndarray, fold: np.ndarray, seen: np.ndarray) -> None:
    """Add to ``seen[fold]`` the pieces of each chosen text, once a text."""
    ends = np.cumsum(texts.segments) * SEGMENT
    begins = ends - texts.segments * SEGMENT
    turn = np.empty(max(BUCKETS + 1, len(texts.words)), dtype=np.int64)

    def distinct(values: np.ndarray) -> np.ndarray:
        turn[values] = np.arange(len(values))
        return values[turn[values] == np.arange(len(values))]

    for row in chosen:
        words = distinct(texts.index[begins[row] : ends[row]])
        seen[fold[row], distinct(texts.words[words].ravel())] += 1


def toxic_weight(rows: int, toxic: int) -> float:
    """Weight of a toxic row among ``rows``."""
    return min(4.0, max(1.0, (rows - toxic) / max(toxic, 1) / 2))


class Learner:
    """A network with the state of its training: Adam for the filters, AdaGrad for the embeddings."""

    def __init__(self, net: Network):
        self.net, self.steps = net, 0
        self.first, self.second = [np.zeros_like(p) for p in self.dense()], [np.zeros_like(p) for p in self.dense()]
        self.squares = np.full(len(net.embed), 1e-3, dtype=np.float32)

    def dense(self) -> list[np.ndarray]:
        return [*self.net.filters, self.net.bias, self.net.of_text, self.net.of_segments]

    def flat(self) -> np.ndarray:
        """All numbers but the embeddings' in one row."""
        arrays = [*self.dense(), *self.first, *self.second]
        return np.concatenate([np.ravel(x).astype(np.float64) for x in arrays] + [[self.net.base, self.steps]])

    def restore(self, flat: np.ndarray) -> None:
        arrays = [*self.dense(), *self.first, *self.second]
        for array, values in zip(arrays, np.split(flat, np.cumsum([x.size for x in arrays]))):
            array[...] = values.reshape(array.shape)
        self.net.base, self.steps = np.float32(flat[-2]), round(flat[-1])

    def step(self, part: Texts, toxic: np.ndarray, weight: float, rate: float, embed_rate: float = 0.05) -> np.ndarray:
        """One step on a batch; the buckets of the words that changed come back."""
        net = self.net
        self.steps += 1
        vectors, maps = net.answers(part)
        where = maps.argmax(axis=2)
        largest = np.take_along_axis(maps, where[:, :, None], axis=2)[:, :, 0].T
        whole, mean, logit = net.pool(largest, part)
        slope = 1 / (1 + np.exp(-np.clip(logit, -30, 30))) - toxic
        slope = (slope * np.where(toxic == 1, weight, 1.0) / len(toxic)).astype(np.float32)
        owner = np.repeat(np.arange(len(toxic)), part.segments)
        back_text = np.where(whole > 0, slope[:, None] * net.of_text, 0).astype(np.float32)
        back_mean = (slope / part.segments)[:, None] * net.of_segments
        inner = np.where(largest + net.bias > 0, back_mean[owner], 0)
        inner += np.where(largest + net.bias == whole[owner], back_text[owner], 0)
        inner = inner.astype(np.float32)
        dense = self.dense()
        grads = [np.zeros_like(p) for p in dense]
        grads[-1], grads[-2] = slope @ mean, slope @ np.maximum(whole, 0)
        grads[-3] = inner.sum(axis=0)
        places = where.T + SEGMENT * np.arange(where.shape[1])[:, None]
        back = np.zeros_like(vectors)
        for w, width in enumerate(WIDTHS):
            for f in range(FILTERS):
                delta = inner[:, w * FILTERS + f]
                on = np.flatnonzero(delta)
                for j in range(width):
                    at = part.index[np.minimum(places[on, w * FILTERS + f] + j, len(part.index) - 1)]
                    pushed = np.bincount(at, delta[on], minlength=len(vectors)).astype(np.float32)
                    grads[w][j, :, f] = pushed @ vectors
                    back += pushed[:, None] * net.filters[w][j, :, f]
        touched = np.flatnonzero(np.abs(back).max(axis=1) > 1e-7)
        pieces = part.words[touched].ravel()
        order = np.argsort(pieces, kind="stable")
        begin = np.flatnonzero(np.diff(pieces[order], prepend=-1))
        unique = pieces[order][begin]
        if len(unique):
            push = np.add.reduceat(back[touched[order // part.words.shape[1]]], begin, axis=0)
            self.squares[unique] += (push**2).mean(axis=1)
            net.embed[unique] -= embed_rate * push / np.sqrt(self.squares[unique])[:, None]
            net.embed[unique[~net.known[unique]]] = 0
        for p, g, m, v in zip(dense, grads, self.first, self.second):
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            p -= rate * (m / (1 - 0.9**self.steps)) / (np.sqrt(v / (1 - 0.99**self.steps)) + 1e-6)
        net.base -= np.float32(rate * slope.sum())
        return unique


def train_one(texts: Texts, toxic: np.ndarray, fit: np.ndarray, seed: int) -> Learner:
    """A network fitted on the rows ``fit``."""
    net, rng = Network(seed), np.random.default_rng(seed)
    net.keep(texts, fit)
    weight = toxic_weight(len(fit), toxic[fit].sum())
    learner = Learner(net)
    queue = np.zeros(0, dtype=np.int64)
    steps = max(STEPS, -(-EPOCHS * len(fit) // BATCH))
    for step in range(1, steps + 1):
        while len(queue) < BATCH:
            queue = np.concatenate([queue, rng.permutation(fit)])
        chosen, queue = queue[:BATCH], queue[BATCH:]
        part = _subset(texts, chosen)
        part.index[rng.random(len(part.index)) < DROPPED] = 0
        learner.step(part, toxic[chosen], weight, 0.02 * (1 - step / steps) + 0.002)
    return learner


class Classifier:
    """``FOLDS`` networks whose answers are averaged, with calibrated thresholds."""

    def __init__(self, nets: list[Network]):
        self.nets = nets
        self.learners: list[Learner] = []
        self.threshold = np.zeros(len(FUNCTION_WORDS) + 1)
        self.scale = 1.0

    def scores(self, texts: Texts) -> np.ndarray:
        logits = np.mean([net.logits(texts) for net in self.nets], axis=0)
        shifted = (logits - self.threshold[texts.language]) / self.scale
        return 1 / (1 + np.exp(-np.clip(shifted + np.log(DECISION / (1 - DECISION)), -60, 60)))


def folds(n: int, seed: int = 7) -> np.ndarray:
    """Fold of each of ``n`` rows."""
    return np.random.default_rng(seed).permutation(n) % FOLDS


def train(texts: Texts, toxic: np.ndarray, seed: int = 7) -> Classifier:
    """Each network is fitted without one fold of the rows; thresholds are calibrated on the folds left out."""
    n = len(toxic)
    fold = folds(n, seed)
    learners, logits = [], np.zeros(n)
    for k in range(FOLDS):
        fit, held = np.flatnonzero(fold != k), np.flatnonzero(fold == k)
        learners.append(train_one(texts, toxic, fit, seed + k) if len(fit) else Learner(Network(seed + k)))
        for part in np.array_split(held, len(held) // 200 + 1):
            logits[part] = learners[-1].net.logits(_subset(texts, part)) if len(part) else 0
    out = Classifier([learner.net for learner in learners])
    out.learners = learners
    calibrate(out, logits, texts.language, toxic)
    return out


def _best_threshold(logits: np.ndarray, toxic: np.ndarray, rows: np.ndarray) -> float:
    """Middle of the cuts with the largest F1; each logit stands for a number of rows."""
    values, at = np.unique(logits, return_inverse=True)
    cuts = np.concatenate([[values[0] - 1], (values[1:] + values[:-1]) / 2, [values[-1] + 1]])
    above, hit = (
        np.append(np.cumsum(np.bincount(at, rows * chosen)[::-1])[::-1], 0) for chosen in (np.ones(len(at)), toxic == 1)
    )
    f1 = 2 * hit / np.maximum(above + hit[0], 1)
    good = cuts[f1 >= f1.max() - 1e-9]
    return float(np.median(good))


def calibrate(
    model: Classifier, logits: np.ndarray, language: np.ndarray, toxic: np.ndarray, rows: np.ndarray | None = None
) -> None:
    """Thresholds of largest F1, by guessed language where it has ten rows of either label."""
    rows = np.ones(len(toxic)) if rows is None else rows
    if not 0 < rows[toxic == 1].sum() < rows.sum():
        return
    model.threshold[:] = _best_threshold(logits, toxic, rows)
    for k in range(len(model.threshold)):
        own = language == k
        if min(rows[own & (toxic == 1)].sum(), rows[own & (toxic == 0)].sum()) >= 10:
            model.threshold[k] = _best_threshold(logits[own], toxic[own], rows[own])
    apart = np.average(logits[toxic == 1], weights=rows[toxic == 1]) - np.average(logits[toxic == 0], weights=rows[toxic == 0])
    model.scale = float(max(apart / 6, 0.05))


def labelled(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id``, ``mark`` (hash of the text), ``size``, ``toxic`` and ``text`` of all rows to learn from."""
    usable = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & (crc_part("doc_id", 3) != 1))
    usable = usable.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).distinct()
    texts = docs.where(F.col("text").isNotNull() & F.col("doc_id").isNotNull() & (crc_part("doc_id", 3) != 1))
    texts = texts.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.xxhash64("text").alias("mark"),
        F.octet_length("text").alias("size"),
        "text",
    )
    return texts.join(usable.hint("merge"), "doc_id").select("doc_id", "mark", "size", "toxic", "text")


def _choose(rows: DataFrame) -> list[tuple[int, int, int]]:
    rows = rows.select("doc_id", "mark", "size", "toxic").distinct()
    rows = rows.orderBy(F.col("size") > LONG_BYTES, F.xxhash64("doc_id"), "doc_id", "mark", "toxic").limit(TRAIN_ROWS).collect()
    out, left = [], TRAIN_BYTES
    for r in rows:
        if r["size"] <= left:
            out.append((r.doc_id, r.mark, r.toxic))
            left -= r["size"]
    return out


def sample(docs: DataFrame, labels: DataFrame) -> list[tuple[int, int, int]]:
    """``doc_id``, hash of the text and label of the rows that training starts from, chosen by sizes alone.

    Rows are taken in the order of a hash of their ids; one that does not fit into
    what is left of ``TRAIN_BYTES`` is passed over.  Repeated rows count once.
    """
    rows = labelled(docs, labels)
    out = _choose(rows)
    if not out and not rows.isEmpty():
        raise ValueError(f"each labelled text is over {TRAIN_BYTES} bytes, so there is none to start from")
    return out


def fit(docs: DataFrame, labels: DataFrame) -> Classifier:
    """Train on all labelled rows whose ``crc32(doc_id)`` modulo 3 is not 1.

    Training starts on the driver from at most ``TRAIN_ROWS`` of them; if there are
    more, the networks then learn from all rows in Spark tasks, and the thresholds
    are calibrated on all.  Rows with a null id, label or text do not take part;
    repeated rows count once.  Without any row the classifier is left as
    initialised and its scores mean nothing.
    """
    key = ["doc_id", "mark", "toxic"]
    order = F.xxhash64(F.lit("order"), *key)
    rows = staged(labelled(docs, labels).sortWithinPartitions(order, *key), "toxicity-rows")
    count = rows.agg(F.count(F.lit(1)).alias("n"), F.count_distinct(*key).alias("different")).first()
    if not count.n:
        return Classifier([Network()])
    if count.different < count.n:
        rows = staged(rows.dropDuplicates(key).sortWithinPartitions(order, *key), "toxicity-rows")
    wanted = rows.sparkSession.createDataFrame(_choose(rows), "doc_id long, mark long, toxic int")
    chosen = rows.join(F.broadcast(wanted), key).select(*key, "text").collect()
    chosen.sort(key=lambda r: (r.doc_id, r.text, r.toxic))
    places = [(r.doc_id, r.mark, r.toxic, int(k)) for r, k in zip(chosen, folds(len(chosen)))]
    texts = [r.text for r in chosen]
    del chosen
    start = None
    if texts:
        sizes = np.cumsum([len(text) for text in texts]) // SLICE_BYTES
        cuts = (np.flatnonzero(np.diff(sizes)) + 1).tolist()
        parts = [prepare(texts[a:b]) for a, b in zip([0, *cuts], [*cuts, len(texts)])]
        del texts
        whole = merge(parts)
        del parts
        start = train(whole, np.array([toxic for _, _, toxic, _ in places]))
        del whole
    return learn(rows, start, places) if len(places) < count.different else start


def learn(rows: DataFrame, start: Classifier | None, places: list[tuple[int, int, int, int]]) -> Classifier:
    """The networks of ``start`` trained further on all rows, each without its own fold of them.

    Each row is in one of at most ``ROUNDS`` rounds, and a task goes through its share
    of a round, batch by batch.  After a round the networks are averaged: a piece's
    vector over the tasks that changed it, by the number of changes; the filters by
    rows.  ``places`` holds the folds that the start gave to its rows; without a
    start the networks begin as initialised.
    """
    spark = rows.sparkSession
    key = ["doc_id", "mark", "toxic"]
    given = F.broadcast(spark.createDataFrame(places, "doc_id long, mark long, toxic int, given int"))
    fold = F.coalesce("given", F.pmod(F.xxhash64(F.lit("fold"), *key), F.lit(FOLDS)).cast("int"))
    rows = rows.join(given, key, "left").withColumn("fold", fold).drop("given")
    counts = np.zeros((FOLDS, 2), dtype=np.int64)
    size = 0
    for r in rows.groupBy("fold", "toxic").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("bytes")).collect():
        counts[r.fold, r.toxic] = r.n
        size += r.bytes
    other = counts.sum(axis=0) - counts
    weights = [toxic_weight(int(n.sum()), int(n[1])) for n in other]
    shards = max(1, -(-size // SHARD_BYTES))
    rounds = min(ROUNDS, shards)
    turns = F.pmod(F.xxhash64(F.lit("turn"), *key), F.lit(rounds))
    learners = start.learners if start else [Learner(Network(7 + k)) for k in range(FOLDS)]
    known = [learner.net.known if start else np.zeros(BUCKETS + 1, dtype=bool) for learner in learners]
    seen = np.zeros((FOLDS, BUCKETS + 1), dtype=np.int64)
    for turn in range(rounds):
        shared = spark.sparkContext.broadcast(learners)
        rate = 0.01 * (1 - turn / rounds) + 0.002
        own = rows.where(turns == turn).select("fold", "toxic", "text").coalesce(-(-shards // rounds))
        sums = own.mapInArrow(released(_pass(shared, weights, rate)), SUMS)
        for r in sums.groupBy("net", "block").applyInArrow(_added, SUMS).collect():
            _apply(learners[r.net], seen[r.net], r.block, r.sums)
        shared.destroy()
        for k, learner in enumerate(learners):
            known[k] = known[k] | (seen.sum(axis=0) - seen[k] >= SEEN)
            learner.net.forget(np.where(known[k], SEEN, 0))
    model = Classifier([learner.net for learner in learners])
    shared = spark.sparkContext.broadcast(model.nets)
    found = rows.select("fold", "toxic", "text").mapInArrow(released(_held_logits(shared)), LOGITS)
    found = found.groupBy("language", "toxic", "bin").agg(F.sum("n").alias("n")).orderBy("language", "toxic", "bin").collect()
    shared.destroy()
    language, toxic, bins, n = np.array([tuple(r) for r in found], dtype=np.int64).T
    calibrate(model, (bins + 0.5) / BINS, language, toxic, n)
    return model


def _pass(shared, weights: list[float], rate: float):
    """Learn from the rows in turn; what changed is sent as one row a network and ``BLOCK`` buckets."""

    def run(batches):
        learners, n, task = None, 0, TaskContext.get().partitionId()
        for part in text_slices(batches):
            if learners is None:
                learners = copy.deepcopy(shared.value)
                for learner in learners:
                    learner.net.known = np.arange(BUCKETS + 1) != PAD
                changes = np.zeros((FOLDS, BUCKETS + 1), dtype=np.int32)
                seen = np.zeros((FOLDS, BUCKETS + 1), dtype=np.int64)
                rng = np.random.default_rng(task)
            texts, toxic, fold = prepare(strings(part)), np.asarray(part.column("toxic")), np.asarray(part.column("fold"))
            n += len(toxic)
            count_pieces(texts, np.arange(len(toxic)), fold, seen)
            for k, learner in enumerate(learners):
                chosen = np.flatnonzero(fold != k)
                for batch in np.array_split(chosen, -(-len(chosen) // BATCH)) if len(chosen) else ():
                    sub = _subset(texts, batch)
                    sub.index[rng.random(len(sub.index)) < DROPPED] = 0
                    share = len(batch) / BATCH  # a small batch moves the network less
                    changes[k, learner.step(sub, toxic[batch], weights[k], rate * share, 0.05 * share)] += 1
        if learners is None:
            return
        for k, (learner, old) in enumerate(zip(learners, shared.value)):
            out = [(-2, seen[k].tobytes()), (-1, np.append(n, n * learner.flat()).tobytes())]
            touched = np.flatnonzero(changes[k])
            for own in np.split(touched, np.flatnonzero(np.diff(touched // BLOCK)) + 1) if len(touched) else ():
                sums = np.zeros((BLOCK, DIM + 2), dtype=np.float16)
                sums[own % BLOCK, 0] = np.minimum(changes[k, own], 2000)
                sums[own % BLOCK, 1] = np.minimum((learner.squares[own] - old.squares[own]) * SCALE, 60_000)
                sums[own % BLOCK, 2:] = learner.net.embed[own] - old.net.embed[own]
                out.append((int(own[0]) // BLOCK, sums.tobytes()))
            blocks, sums = zip(*out)
            columns = [pa.array([k] * len(out), pa.int32()), pa.array([task] * len(out), pa.int32())]
            columns += [pa.array(blocks, pa.int32()), pa.array(sums, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, SUMS.names)

    return run


def _kind(block: int) -> type:
    return {-2: np.int64, -1: np.float64}.get(block, np.float32)


def _added(rows: pa.Table) -> pa.Table:
    """Sums over the tasks, added in the order of their numbers; changes times their number."""
    rows = rows.sort_by("task")
    block = rows.column("block")[0].as_py()
    total = 0
    for sums in rows.column("sums"):
        if block < 0:
            total = total + np.frombuffer(sums.as_buffer(), dtype=_kind(block))
        else:
            sums = np.frombuffer(sums.as_buffer(), dtype=np.float16).reshape(BLOCK, DIM + 2).astype(np.float32)
            sums[:, 2:] *= sums[:, :1]
            total = total + sums
    return rows.slice(0, 1).set_column(3, "sums", pa.array([total.tobytes()], pa.binary()))


def _apply(learner: Learner, seen: np.ndarray, block: int, sums: bytes) -> None:
    sums = np.frombuffer(sums, dtype=_kind(block))
    if block == -2:
        seen += sums
    elif block == -1:
        learner.restore(sums[1:] / sums[0])
    else:
        sums = sums.reshape(BLOCK, DIM + 2)
        at = np.flatnonzero(sums[:, 0])
        learner.squares[at + block * BLOCK] += sums[at, 1] / SCALE
        learner.net.embed[at + block * BLOCK] += sums[at, 2:] / sums[at, :1]


def _held_logits(shared):
    """Numbers of rows by language, label and logit, each row's by the network that never saw it."""

    def run(batches):
        nets = shared.value
        for part in text_slices(batches):
            texts, fold = prepare(strings(part)), np.asarray(part.column("fold"))
            logits = np.zeros(len(fold))
            for k, net in enumerate(nets):
                own = np.flatnonzero(fold == k)
                if len(own):
                    logits[own] = net.logits(_subset(texts, own))
            bins = np.floor(np.clip(logits, -60, 60) * BINS).astype(np.int64)
            found = np.stack([texts.language, np.asarray(part.column("toxic")), bins])
            different, n = np.unique(found, axis=1, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(x.astype(np.int64)) for x in (*different, n)], LOGITS.names)

    return run


def score(docs: DataFrame, net: Classifier) -> DataFrame:
    """All rows and columns of ``docs`` with ``score`` and ``predicted`` added, or replaced where they exist.

    ``score`` is between 0 and 1, for null and empty texts too.  Ties, repeated
    rows and null ids are scored like any other row.
    """
    shared = docs.sparkSession.sparkContext.broadcast(net)
    kept = [f for f in docs.schema.fields if f.name not in ("score", "predicted")]

    def run(batches):
        net = shared.value
        for rows in text_slices(batches):
            got = net.scores(prepare(strings(rows)))
            columns = {f.name: rows.column(f.name) for f in kept}
            columns["score"], columns["predicted"] = pa.array(got), pa.array((got >= DECISION).astype(np.int32))
            yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    schema = StructType([*kept, StructField("score", DoubleType()), StructField("predicted", IntegerType())])
    return docs.mapInArrow(released(run), schema)
