"""SimHash near-copies at a shingle similarity: wide fingerprints and blocks of portions.

At a similarity of 0.8 a tenth or more of a fingerprint's bits differ, so no block
of its bits is both shared and selective.  Here a text's five-word shingles are
split into portions by their hashes, a few shingles each; two similar texts have
several whole portions in common, and a block is the fingerprint of a portion.
Texts are joined on blocks, the Hamming distance of SimHash fingerprints of
``BITS`` bits chooses candidates, and candidates are verified by the exact
similarity of their sets of shingles.  Only texts that have a candidate get
their sets written, to files that the verifying tasks map into memory.
"""

from __future__ import annotations

import os
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillmart.llm.arrays import PACKED, Mapped, by_shard, merged, unpack
from rillmart.llm.common import U64, Words, mix, mounted, released, shared_folder, staged, strings, text_slices
from rillmart.llm.components import components

SHINGLE = 5
SIMILARITY = 0.8  # shared shingles among all of two texts', at least
BITS = 1024
#: Differing bits of candidates; texts of similarity 0.8 differ in 160 on average and, of 4 and 5 shingles, in 192.
RADIUS = 256
SHARD_BITS = 6  # of the ids of candidates
FIRST = 30  # bits that differ at most in the first 64, a cheap test before the others
PORTIONS = 12  # portions of each level that become blocks
STRIPE = 64  # members of a bucket compared with the others at once
BUCKET = 1024  # fingerprints compared at once; larger buckets are compared in all pairs of such parts


def shingle_sets(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of all texts, in order within each text; how many each text has; a hash of each text's set."""
    words = Words(texts)
    hashes = words.hashes()
    counts = np.diff(words.first)
    own = np.where(counts > 0, np.maximum(counts - SHINGLE + 1, 1), 0)
    at = np.arange(own.sum()) - np.repeat(np.cumsum(own) - own, own) + np.repeat(words.first[:-1], own)
    last = np.repeat(words.first[1:] - 1, own)
    found = np.zeros(len(at), dtype=U64)
    for k in range(SHINGLE):
        inside = at + k <= last
        found = np.where(inside, mix(found * U64(31) + hashes[np.minimum(at + k, last)] + U64(k)), found)
    text = np.repeat(np.arange(len(texts)), own)
    order = np.lexsort((found, text))
    found, text = found[order], text[order]
    new = np.ones(len(found), dtype=bool)
    new[1:] = (found[1:] != found[:-1]) | (text[1:] != text[:-1])
    found, text = found[new], text[new]
    n = np.bincount(text, minlength=len(texts))
    used = np.flatnonzero(n)
    whole = np.zeros(len(texts), dtype=U64)
    if len(used):
        whole[used] = np.add.reduceat(mix(found), np.cumsum(n[used]) - n[used])
    return found, n, whole


def sketches(texts: list[str]) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Of each text: a hash of its set of shingles, its wide fingerprint, and its blocks."""
    found, n, whole = shingle_sets(texts)
    text = np.repeat(np.arange(len(texts)), n)
    used = np.flatnonzero(n)
    begin = np.cumsum(n[used]) - n[used]
    prints = np.zeros((len(texts), BITS // 64), dtype=U64)
    if len(used):
        for k in range(BITS // 64):
            bits = np.unpackbits(mix(found + U64(k + 1)).astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            ones = np.add.reduceat(bits, begin, axis=0, dtype=np.int64)
            prints[used, k] = np.packbits(2 * ones > n[used][:, None], axis=1, bitorder="little").view("<u8").ravel()
    level = np.maximum(np.floor(np.log2(np.maximum(n, 1) / 4)), 0).astype(np.int64)
    keys, owners = [], []
    for more in range(3):
        on = np.flatnonzero((more < 2) | (n[text] < 16))
        depth = level[text[on]] + more
        portion = (found[on] >> U64(33)).astype(np.int64) & ((1 << depth) - 1)
        near = portion < PORTIONS
        on, depth, portion = on[near], depth[near], portion[near]
        slot = text[on] * PORTIONS + portion
        order = np.argsort(slot, kind="stable")
        slot, members, depth = slot[order], found[on][order], depth[order]
        if len(slot):
            first = np.flatnonzero(np.concatenate([[True], slot[1:] != slot[:-1]]))
            sums = np.add.reduceat(mix(members + U64(77)), first)
            keys.append(mix(sums + mix((depth[first] * 64 + slot[first] % PORTIONS).astype(U64))))
            owners.append(slot[first] // PORTIONS)
    blocks = [np.zeros(0, dtype=U64)] * len(texts)
    if keys:
        keys, owners = np.concatenate(keys), np.concatenate(owners)
        order = np.argsort(owners, kind="stable")
        blocks = np.split(keys[order], np.cumsum(np.bincount(owners, minlength=len(texts)))[:-1])
    return whole, prints, blocks


def _pairs(members: list[dict]) -> tuple[np.ndarray, np.ndarray]:
    """Candidates among the members of a bucket, the nearest first; found for ``STRIPE`` members at a time."""
    prints = np.frombuffer(b"".join(m["print"] for m in members), dtype="<u8").reshape(len(members), -1)
    lefts, rights, aparts = [], [], []
    for s in range(0, len(members), STRIPE):
        near = np.bitwise_count(prints[s : s + STRIPE, None, 0] ^ prints[None, s:, 0]) <= FIRST
        x, y = (at + s for at in np.nonzero(np.triu(near, 1)))
        apart = np.bitwise_count(prints[x] ^ prints[y]).sum(axis=1, dtype=np.int16)
        on = apart <= RADIUS
        lefts.append(x[on].astype(np.int32))
        rights.append(y[on].astype(np.int32))
        aparts.append(apart[on])
    order = np.argsort(np.concatenate(aparts), kind="stable")
    return np.concatenate(lefts)[order], np.concatenate(rights)[order]


def _members(batch: pa.RecordBatch):
    """The buckets of a batch, turned into Python values one at a time."""
    for bucket in batch.column("members"):
        yield bucket.as_py()


def _candidates(batches):
    """Ids of the members that have a candidate."""
    for batch in batches:
        found = set()
        for members in _members(batch):
            found.update(members[k]["node"] for k in np.unique(np.concatenate(_pairs(members))).tolist())
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(sorted(found), pa.int64())], ["node"])


def _deal(batches):
    for batch in batches:
        keys = np.unique(mix(np.asarray(batch.column("node"), dtype=np.int64).view(U64)))
        yield by_shard((keys >> U64(64 - SHARD_BITS)).astype(np.int64), keys)


def _mapped_sets(docs: DataFrame, nodes: DataFrame) -> tuple[str, DataFrame]:
    """A folder, and ``whole``, ``file``, ``at`` and ``n``: where in its files the sets of the texts named by ``nodes`` lie."""
    path = mounted(shared_folder(docs.sparkSession, "sets"))
    wanted = Mapped(path, "wanted", "u1")

    def write(shard, packed):
        keys = np.unique(np.concatenate([unpack(data, 1)[0] for data in packed]))
        wanted.write(shard, keys, np.zeros(len(keys)))
        yield pa.RecordBatch.from_arrays([pa.array([shard], pa.int32())], ["shard"])

    merged(nodes.mapInArrow(released(_deal), PACKED), write, "shard int", 1 << SHARD_BITS).count()

    def chosen(rows: pa.RecordBatch) -> np.ndarray:
        keys = mix(np.asarray(rows.column("doc_id"), dtype=np.int64).view(U64))
        order = np.argsort(keys)
        place = wanted.find(keys[order], (keys[order] >> U64(64 - SHARD_BITS)).astype(np.int64))[0]
        return np.sort(order[place >= 0])

    def run(batches):
        os.makedirs(path, exist_ok=True)
        name, at = f"sets-{uuid.uuid4().hex}", 0
        with open(f"{path}/{name}", "wb") as out:
            for batch in batches:
                for rows in text_slices([batch.take(pa.array(chosen(batch)))]):
                    found, n, whole = shingle_sets(strings(rows))
                    found.astype("<u8").tofile(out)
                    begin = at + np.cumsum(n) - n
                    at += len(found)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(whole.view(np.int64)), pa.array([name] * len(n)), pa.array(begin), pa.array(n.astype(np.int64))],
                        ["whole", "file", "at", "n"],
                    )

    found = docs.mapInArrow(released(run), "whole long, file string, at long, n long")
    found = found.groupBy("whole").agg(F.first(F.struct("file", "at", "n")).alias("s")).select("whole", "s.*")
    return path, staged(found, "sets")


def _similar(a: np.ndarray, b: np.ndarray) -> bool:
    shared = len(np.intersect1d(a, b, assume_unique=True))
    return shared / max(len(a) + len(b) - shared, 1) >= SIMILARITY


def _links(path: str):
    """Links that connect the same members of a bucket as all its candidates of ``SIMILARITY`` do."""

    def run(batches):
        files: dict[str, np.ndarray] = {}
        for batch in batches:
            a, b = [], []
            for members in _members(batch):
                left, right = _pairs(members)
                n = np.array([m["n"] for m in members])
                able = np.minimum(n[left], n[right]) >= SIMILARITY * np.maximum(n[left], n[right])
                left, right = left[able], right[able]
                sets = []
                for m in members:
                    name = f"{path}/{m['file']}"
                    if name not in files:
                        files[name] = np.memmap(name, dtype="<u8", mode="r")
                    sets.append(files[name][m["at"] : m["at"] + m["n"]])
                label = np.arange(len(members))
                for s in range(0, len(left), 4096):
                    x, y = left[s : s + 4096], right[s : s + 4096]
                    apart = label[x] != label[y]
                    for i, j in zip(x[apart].tolist(), y[apart].tolist()):
                        if label[i] != label[j] and _similar(sets[i], sets[j]):
                            label[label == label[j]] = label[i]
                            a.append(members[i]["node"])
                            b.append(members[j]["node"])
            if a:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (a, b)], ["a", "b"])

    return run


def _buckets(nodes: DataFrame, *fields: str) -> DataFrame:
    """``members`` (structs of ``fields``) of the buckets of equal blocks, large ones as all pairs of their parts."""
    keys = nodes.select("whole", F.explode("blocks").alias("key"))
    sizes = keys.groupBy("key").agg(F.count("*").alias("size")).where("size > 1")
    parts = F.ceil(F.col("size") / BUCKET).cast("int")
    shared = keys.join(sizes, "key").select("key", "whole", parts.alias("parts"))
    shared = shared.join(nodes.select("whole", *fields), "whole")
    own = F.pmod(F.xxhash64("whole"), F.col("parts")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("other")
    shared = shared.select("key", *fields, own.alias("own"), other)
    pair = [F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high")]
    grouped = shared.groupBy("key", *pair).agg(F.collect_list(F.struct(*fields)).alias("members"))
    return grouped.where(F.size("members") > 1).select("members")


def near_copies(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``component_id`` (smallest linked doc_id) of the rows of ``docs`` with an id.

    Texts with the same set of shingles are one node, so exact copies cost a row
    for each task at most.  Null texts are empty; all texts without words are copies of each other.
    Rows that repeat an id count as one document.
    """

    def run(batches):
        for rows in text_slices(batches):
            whole, prints, blocks = sketches(strings(rows))
            yield pa.RecordBatch.from_arrays(
                [
                    rows.column("doc_id"),
                    pa.array(whole.view(np.int64)),
                    pa.array([p.tobytes() for p in prints], pa.binary()),
                    pa.array([b.view(np.int64) for b in blocks], pa.list_(pa.int64())),
                ],
                ["doc_id", "whole", "print", "blocks"],
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("doc_id is not null")
    rows = staged(rows.mapInArrow(released(run), "doc_id long, whole long, print binary, blocks array<long>"), "sketches")
    nodes = rows.groupBy("whole").agg(
        F.min("doc_id").alias("node"), F.first("print").alias("print"), F.first("blocks").alias("blocks")
    )
    nodes = staged(nodes, "nodes")
    near = staged(_buckets(nodes, "node", "print").mapInArrow(released(_candidates), "node long").distinct(), "candidates")
    path, sets = _mapped_sets(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("doc_id is not null"), near)
    able = staged(nodes.join(sets, "whole"), "candidates")
    links = _buckets(able, "node", "print", "file", "at", "n").mapInArrow(released(_links(path)), "a long, b long").distinct()
    roots = components(links)
    labels = nodes.select("whole", "node").join(roots, "node", "left")
    labels = labels.select("whole", F.coalesce("root", "node").alias("component_id"))
    return rows.select("doc_id", "whole").join(labels, "whole").groupBy("doc_id").agg(F.min("component_id").alias("component_id"))


def deduplicate(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` but those with a near-copy of a smaller doc_id, directly or through others.

    Rows without an id stay.
    """
    gone = near_copies(docs).where("component_id < doc_id").select(F.col("doc_id").alias("gone_id"))
    return docs.join(gone, docs["doc_id"] == gone["gone_id"], "left_anti")
