"""Spelling variants by pivotal grams.

Words within one inserted, deleted or replaced character are found through their
bigrams.  Bigrams are ordered by how many words hold them, rarest first.  A
word's prefix are its three rarest bigrams; one edit spoils at most two of them,
which overlap, so of two bigrams that do not overlap at least one survives.
Two such pivots, the cheapest pair in the prefix by dynamic programming, are
joined with the other words' prefixes.

A surviving pivot leaves the edit on one of its sides, so its place is fixed by
the two lengths, the text on the other side is equal, and so is one half of the
text on the edit's side.  All that is part of the join key.  Keys that very many
words share go on to keys that leave out one character each, which at most as many
words can share as there are letters.  Every candidate pair is verified by its edit
distance.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillmart.llm.common import staged, text_slices

SHORTEST = 6  # characters of a word
LEAST = 5  # occurrences of a word
LEAD = 5  # times as often as the word a form must occur
SPOIL = 199  # runs whose checksum this divides lose a character
BUCKET = 1_000  # prefix rows of a key; above it finer keys take over
HELD = 200_000  # distinct words counted at once in a map task

_RUN = re.compile("[A-Za-zÀ-ÿ]{%d,}" % SHORTEST)
_LOWER = {c: c + 32 for c in range(65, 91)}


def spoiled(doc_id, run: str) -> str:
    """The run itself, or without one character if its document and letters say so."""
    h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
    if h % SPOIL:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1 :]


def _counts(batches):
    """Words of the texts with their counts, added up for many texts at once."""
    total: Counter = Counter()

    def flush():
        return pa.RecordBatch.from_arrays(
            [pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())], ["word", "n"]
        )

    for rows in text_slices(batches):
        for doc_id, text in zip(rows.column("doc_id").to_pylist(), rows.column("text").to_pylist()):
            if text:
                for run, n in Counter(_RUN.findall(text)).items():
                    word = spoiled(doc_id, run.lower() if run.isascii() else run.translate(_LOWER))
                    if len(word) >= SHORTEST:
                        total[word] += n
        if len(total) >= HELD:
            yield flush()
            total.clear()
    if total:
        yield flush()


def words(docs: DataFrame) -> DataFrame:
    """``word`` and ``n`` (long) of the words that occur often enough."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    found = rows.mapInArrow(_counts, "word string, n long")
    return found.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST)


def grams(word: str) -> list[str]:
    return [word[i : i + 2] for i in range(len(word) - 1)]


def prefix(word: str, weight: dict[str, int]) -> list[tuple[int, int]]:
    """Weight and place of the three rarest bigrams in the global order, with all equal to the third."""
    order = sorted((weight[g], g, i) for i, g in enumerate(grams(word)))
    return [(w, i) for w, g, i in order if (w, g) <= order[2][:2]]


def pivots(chosen: list[tuple[int, int]], need: int = 2) -> list[int]:
    """Places of ``need`` bigrams that do not overlap and weigh least together.

    From left to right: the best choice of ``k`` bigrams that ends with this one adds
    it to the best choice of ``k - 1`` that ends two places or more before it.
    """
    by_place = sorted((i, w) for w, i in chosen)
    rows: list[list] = []  # for each bigram: the best choice of k + 1 bigrams that ends with it
    for n, (i, w) in enumerate(by_place):
        ends = [(w, (i,))]
        for k in range(1, need):
            before = [rows[m][k - 1] for m in range(n) if by_place[m][0] <= i - 2 and len(rows[m]) >= k]
            if not before:
                break
            total, places = min(before)
            ends.append((total + w, (*places, i)))
        rows.append(ends)
    return list(min(r[need - 1] for r in rows if len(r) >= need)[1])


def keys(word: str, at: int):
    """Join keys of the bigram at a place, for pairs whose longer word is this long or one longer.

    If the edit is right of the bigram, all up to its end is equal, and of the rest
    either the first half or what follows it; likewise to the left.
    """
    size = len(word)
    for longer in (size, size + 1):
        head, rest = word[: at + 2], longer - at - 2
        half = rest // 2
        yield f"a{longer}|{word[: at + 2 + half]}|{at}"
        yield f"b{longer}|{head}|{at}|{word[size - (rest - half) :] if rest > half else ''}"
        # counted from the right, the place of a bigram left of which the edit lies is the same in both words
        behind = size - at
        tail, lead = word[at:], longer - behind
        half = lead // 2
        yield f"c{longer}|{word[at - half :] if half else tail}|{behind}"
        yield f"d{longer}|{tail}|{behind}|{word[: lead - half]}"


def _entries(weight: dict[str, int]):
    """A row for each key of a word's prefix; ``pivot`` tells the pivots among them."""

    def run(batches):
        for batch in batches:
            out: dict[tuple[str, str], bool] = {}
            for word in batch.column("word").to_pylist():
                chosen = prefix(word, weight)
                best = set(pivots(chosen))
                for _, at in chosen:
                    for key in keys(word, at):
                        out[key, word] = out.get((key, word), False) or at in best
            yield pa.RecordBatch.from_arrays(
                [pa.array([k for k, _ in out], pa.string()), pa.array([w for _, w in out], pa.string()), pa.array(list(out.values()), pa.bool_())],
                ["key", "word", "pivot"],
            )

    return run


def _wildcards(batches):
    """Finer keys: the word without one character, with its place, or the word itself, for a partner longer at that place."""
    for batch in batches:
        rows = []
        for key, word, pivot in zip(*(batch.column(c).to_pylist() for c in ("key", "word", "pivot"))):
            for i in range(len(word) + 1):
                less = word[:i] + word[i + 1 :]
                rows.append((f"{key}|-{i}|{word}", word, pivot))
                if i < len(word):
                    rows += (f"{key}|={i}|{less}", word, pivot), (f"{key}|-{i}|{less}", word, pivot)
        key, word, pivot = zip(*rows) if rows else ((), (), ())
        yield pa.RecordBatch.from_arrays(
            [pa.array(key, pa.string()), pa.array(word, pa.string()), pa.array(pivot, pa.bool_())], ["key", "word", "pivot"]
        )


def _pairs(entries: DataFrame) -> DataFrame:
    """Verified pairs, smaller word first, of a pivot with any prefix bigram of the same key."""
    a = entries.where("pivot").select("key", F.col("word").alias("a"))
    b = entries.select("key", F.col("word").alias("b"))
    near = (F.col("a") != F.col("b")) & (F.abs(F.length("a") - F.length("b")) <= 1)
    found = a.join(b, "key").where(near & (F.levenshtein("a", "b", 1) == 1))
    return found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))


def links(counted: DataFrame) -> DataFrame:
    """``a`` and ``b`` of the words that differ by one edit, each pair once, for words of at least ``SHORTEST`` characters."""
    # at most one row for each pair of letters: 90 letters, 8,100 rows
    pairs = counted.select(F.explode(F.array_distinct(F.transform(
        F.sequence(F.lit(1), F.length("word") - 1), lambda i: F.substring("word", i, 2)
    ))).alias("gram"))
    weight = {r["gram"]: r["n"] for r in pairs.groupBy("gram").agg(F.count(F.lit(1)).alias("n")).collect()}
    entries = staged(counted.select("word").mapInArrow(_entries(weight), "key string, word string, pivot boolean"), "grams")
    full = entries.groupBy("key").agg(F.count(F.lit(1)).alias("size")).where(F.col("size") > BUCKET).select("key")
    full = staged(full, "full-keys")
    finer = entries.join(full, "key", "left_semi").mapInArrow(_wildcards, "key string, word string, pivot boolean")
    plain = entries.join(full, "key", "left_anti")
    return _pairs(plain).union(_pairs(finer)).distinct()


def _roots(forms: DataFrame, highest: int) -> DataFrame:
    """``word`` and ``root``, the last word that the forms lead to.

    A form occurs ``LEAD`` times as often as its word, so chains are short; each
    round replaces a root by its own root and halves what is left of them.
    """
    steps, n = 1, LEAST
    while n * LEAD <= highest:
        n, steps = n * LEAD, steps + 1
    found = forms.select("word", F.col("form").alias("root"))
    for _ in range(steps.bit_length()):
        further = found.select(F.col("word").alias("root"), F.col("root").alias("next"))
        found = staged(found.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root")), "roots")
    return found


def variants(docs: DataFrame) -> DataFrame:
    """``word``, ``form``, ``root``, ``n``, ``n_near`` and ``form_n`` of every word.

    Words are letter runs, A to Z lower-cased, some without one character (see
    ``spoiled``), of at least ``SHORTEST`` characters and ``LEAST`` occurrences.  A
    word's form is its near word of largest ``n`` (ties: the smallest in code-point
    order) if that is ``LEAD`` times its own.  A null text has no words; a null
    doc_id counts as an empty one.  Repeated rows count each.  An empty table gives
    no rows, and other columns of the input are ignored.
    """
    counted = staged(words(docs), "words")
    found = staged(links(counted), "near")
    both = found.union(found.select(F.col("b").alias("a"), F.col("a").alias("b")))
    counts = counted.select(F.col("word").alias("b"), F.col("n").alias("n_b"))
    best = both.join(counts, "b").groupBy(F.col("a").alias("word")).agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("n_b")).alias("less"), "b")).alias("best")
    )
    led = -F.col("best.less") >= LEAD * F.col("n")
    rows = counted.join(best, "word", "left").select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(led, F.col("best.b")).alias("form"),
        F.when(led, -F.col("best.less")).alias("form_n"),
    )
    rows = staged(rows, "variants")
    highest = counted.agg(F.max("n")).first()[0] or 0
    roots = _roots(rows.where("form IS NOT NULL"), highest)
    return rows.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
