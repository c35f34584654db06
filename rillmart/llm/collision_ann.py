"""Approximate nearest neighbours by collision counting.

Each of ``PROJECTIONS`` random lines has an array of the vectors sorted by their
projection.  A query opens a window around its own projection in every array; a
vector inside a window collides.  Virtual rehashing widens the windows step by
step, and vectors with enough collisions are verified by their exact cosine.
Collisions are counted on bitmaps, 64 vectors at once.
Vectors are dealt into blocks with arrays of their own, and the queries, in
blocks, go to all of them.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

PROJECTIONS = 64
WIDTH = 0.3  # half of the first window, for vectors of length 1
GROWTH = 1.3
THRESHOLD = 0.6  # share of the lines in which a vector must collide to be verified
REACH = 1.1  # windows grow until half of one is this times the distance of the k-th found
BLOCK_ROWS = 20_000
QUERY_ROWS = 2_000
QUERY_BATCH = 64  # queries that are counted and verified together
STRIPS = 256  # parts of a sorted array, to which windows are widened
CLOSE = 1e-9  # the product's cosines are off by less
SEED = 11


def usable(vectors: DataFrame, key: str, column: str) -> DataFrame:
    """``vec_id`` and ``vector`` (array of double) of the vectors that take part.

    Null, zero and empty vectors, and those with a null or non-finite component,
    take no part; nor do rows with a null id.
    """
    values = F.transform(column, lambda x: x.cast("double"))
    rows = vectors.select(F.col(key).cast("long").alias("vec_id"), values.alias("vector"))
    fine = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return rows.where(
        F.col("vec_id").isNotNull() & F.col("vector").isNotNull() & fine & F.exists("vector", lambda x: x != 0)
    )


def _lines(dims: int) -> np.ndarray:
    return np.random.default_rng(SEED).normal(size=(PROJECTIONS, dims)) / np.sqrt(dims)


def _enough(lines, need: int) -> np.ndarray:
    """Bits that at least ``need`` of the bitmaps hold, counted by adders for 64 rows at once."""
    places: list[list[np.ndarray]] = [[]]  # bitmaps that stand for 1, 2, 4, ...

    def add(bits: np.ndarray, k: int) -> None:
        if k == len(places):
            places.append([])
        places[k].append(bits)
        if len(places[k]) == 3:
            x, y, z = places[k]
            either = x ^ y
            places[k] = [either ^ z]
            add((x & y) | (either & z), k + 1)

    for bits in lines:
        add(bits, 0)
    k, more = 0, None
    while k < len(places):
        if len(places[k]) == 2:
            x, y = places[k]
            places[k] = [x ^ y]
            add(x & y, k + 1)
        count = places[k][0] if places[k] else np.uint64(0)
        more = np.zeros_like(bits) if more is None else more
        more = more & count if (need - 1) >> k & 1 else more | count
        k += 1
    return more if (need - 1) >> k == 0 else np.zeros_like(bits)


class Arrays:
    """Sorted projections of a block of vectors.

    Every sorted array is cut into ``STRIPS`` parts, and the rows before each cut are
    kept as a bitmap; the rows of a window, widened to whole parts, are the
    difference of two bitmaps.
    """

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids, self.vectors = ids[order], vectors[order]
        self.norms = np.sqrt((self.vectors**2).sum(axis=1))
        self.unit = self.vectors / self.norms[:, None]
        self.lines = _lines(vectors.shape[1])
        spread = self.unit @ self.lines.T * np.sqrt(vectors.shape[1])
        n = len(ids)
        strips = min(STRIPS, n)
        self.cuts = np.arange(strips + 1) * n // strips
        self.places = np.empty((PROJECTIONS, n))
        self.before = np.zeros((PROJECTIONS, strips + 1, -(-n // 64)), dtype=np.uint64)
        for j in range(PROJECTIONS):
            sorting = np.argsort(spread[:, j])
            self.places[j] = spread[sorting, j]
            strip = np.empty(n, dtype=np.int16)
            strip[sorting] = np.repeat(np.arange(strips), np.diff(self.cuts))
            rows = np.packbits(strip < np.arange(strips + 1)[:, None], axis=1, bitorder="little")
            self.before[j].view(np.uint8)[:, : rows.shape[1]] = rows

    def search(self, ids: np.ndarray, queries: np.ndarray, k: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """Nearest ids and cosines of each query, its own row left out."""
        out = []
        for start in range(0, len(ids), QUERY_BATCH):
            out += self._search(ids[start : start + QUERY_BATCH], queries[start : start + QUERY_BATCH], k)
        return out

    def _search(self, ids: np.ndarray, queries: np.ndarray, k: int) -> list[tuple[np.ndarray, np.ndarray]]:
        norms = np.sqrt((queries**2).sum(axis=1))
        unit = queries / norms[:, None]
        places = unit @ self.lines.T * np.sqrt(queries.shape[1])
        need = int(np.ceil(THRESHOLD * PROJECTIONS))
        first, last = np.searchsorted(self.ids, ids, "left"), np.searchsorted(self.ids, ids, "right")
        found = [(np.zeros(0, dtype=np.int64), np.zeros(0)) for _ in ids]
        tried = np.zeros((len(ids), self.before.shape[2]), dtype=np.uint64)
        active, width = np.arange(len(ids)), WIDTH
        while len(active):
            hits = _enough(self._windows(places[active], width), need)
            fresh = hits & ~tried[active]
            tried[active] |= hits
            self._verify(active, fresh, ids, first, last, queries, norms, unit, found, k)
            # a vector at distance d collides in a line with probability P(|N| d <= width)
            near = [
                len(found[q][0]) == k and width >= REACH * np.sqrt(max(0.0, 2 - 2 * found[q][1][-1])) for q in active
            ]
            whole = np.bitwise_count(tried[active]).sum(axis=1) == len(self.ids)
            wide = width >= 8 * np.sqrt(queries.shape[1])
            active, width = active[~(np.array(near) | whole | wide)], width * GROWTH
        return found

    def _windows(self, places: np.ndarray, width: float):
        """For each line the rows in the windows around the places, a bitmap a query."""
        for j in range(PROJECTIONS):
            low = np.searchsorted(self.places[j], places[:, j] - width, "left")
            high = np.searchsorted(self.places[j], places[:, j] + width, "right")
            low = np.searchsorted(self.cuts, low, "right") - 1
            high = np.searchsorted(self.cuts, high, "left")
            yield self.before[j][high] & ~self.before[j][low]

    def _verify(self, active, fresh, ids, first, last, queries, norms, unit, found, k: int) -> None:
        """Put the nearest of the fresh rows into ``found``; one product serves all queries, close calls are summed anew."""
        rows = np.flatnonzero(np.unpackbits(np.bitwise_or.reduce(fresh).view(np.uint8), bitorder="little", count=len(self.ids)))
        if not len(rows):
            return
        collided = np.unpackbits(fresh.view(np.uint8), axis=1, bitorder="little", count=len(self.ids))
        for bits, q in zip(collided, active):
            bits[first[q] : last[q]] = 0
        about = np.where(collided[:, rows], unit[active] @ self.unit[rows].T, -2)
        least = np.partition(about, -k, axis=1)[:, -k] if len(rows) > k else np.full(len(active), -2.0)
        for mine, q, bound in zip(about, active, least):
            ids_before, scores_before = found[q]
            if len(scores_before) == k:
                bound = max(bound, scores_before[-1])
            close = rows[(mine >= bound - CLOSE) & (mine > -1.5)]
            # summed row by row, so that equal vectors tie wherever they lie
            cosines = (self.vectors[close] * queries[q]).sum(axis=1) / (self.norms[close] * norms[q])
            got, scores = np.append(ids_before, self.ids[close]), np.append(scores_before, cosines)
            best = np.lexsort((got, -scores))[:k]
            found[q] = got[best], scores[best]


def nearest(vectors: DataFrame, *, key: str = "vec_id", column: str = "embedding", every: int = 50, k: int = 5) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id`` and ``score`` of the ``k`` nearest found to each query.

    Queries are the rows whose id is divisible by ``every``; candidates are all
    rows but the query's own.  Ties go to the smaller id.  Vectors of another
    length than the query's are no candidates.  Rows that repeat an id are one
    candidate each; repeated query rows are one query, and rows with the id of one
    and another vector are a query with ranks of its own.  An empty table gives no
    rows.
    """
    spark = vectors.sparkSession
    rows = usable(vectors, key, column)
    rows = rows.withColumn("dims", F.size("vector"))
    count = rows.count()
    blocks, groups = max(1, -(-count // BLOCK_ROWS)), max(1, -(-count // every // QUERY_ROWS))
    data = rows.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int"))
    asked = rows.where(F.col("vec_id") % every == 0).withColumn("part", F.pmod(F.xxhash64("vec_id"), F.lit(groups)).cast("int"))
    asked = asked.dropDuplicates(["vec_id", "vector"]).withColumn("asked", F.xxhash64("vec_id", "vector"))
    asked = asked.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    data = data.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(groups - 1)))) if groups > 1 else data.withColumn("part", F.lit(0))

    def run(left, right):
        data, asked = left.combine_chunks(), right.combine_chunks()
        out = [*(np.zeros(0, dtype=np.int64) for _ in range(3)), np.zeros(0)]
        if data.num_rows and asked.num_rows:
            grid = lambda t: np.asarray(pc.list_flatten(t.column("vector"))).reshape(t.num_rows, -1)
            arrays = Arrays(np.asarray(data.column("vec_id")), grid(data))
            ids = np.asarray(asked.column("vec_id"))
            found = arrays.search(ids, grid(asked), k)
            sizes = [len(f) for f, _ in found]
            out = [
                np.repeat(ids, sizes),
                np.repeat(np.asarray(asked.column("asked")), sizes),
                np.concatenate([f for f, _ in found]),
                np.concatenate([s for _, s in found]),
            ]
        return pa.table(dict(zip(("query_id", "asked", "vec_id", "score"), out)))

    keys = ["block", "part", "dims"]
    found = data.groupBy(*keys).cogroup(asked.groupBy(*keys)).applyInArrow(run, "query_id long, asked long, vec_id long, score double")
    order = Window.partitionBy("query_id", "asked").orderBy(F.desc("score"), "vec_id")
    found = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return found.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
