"""Embedding whitening by Golub-Kahan-Lanczos bidiagonalisation.

Entries become whole numbers; each distinct vector is fitted once.  With X the
centred rows, the recurrences X v = alpha u + beta u' and X'u = alpha v + beta v'
alternate two products over all rows.  Every left vector is a combination of the
rows, u = X w, so only w (as long as a vector) is kept: the entry of u that
belongs to a row is made again from the row, and one pass a step gives the
product X'u and the projections on all earlier left vectors.  Right and left
vectors are orthogonalised in full against all earlier ones.  The singular
values of the small bidiagonal matrix give the deviations, its right vectors the
components.  Tasks return sums as long as a vector; the driver holds matrices of
the vectors' length only.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillmart.llm.common import staged

COMPONENTS = 16
SCALE, SHIFT = 64, 1_000_000
LARGEST = float(1 << 40)  # entries are held within this, so that sums of them fit whole numbers
FLAT = 1e-13  # deviations squared below this part of the largest count as none
SETTLED = 1e-15  # residual, as a part of the largest deviation, at which a component is found
SEED = 5


def whole_vectors(vectors: DataFrame, key: str, column: str) -> DataFrame:
    """``vec_id`` and ``x`` (array of long) of the rows whose vector has only finite entries."""
    entries = F.transform(column, lambda c: c.cast("double"))
    rows = vectors.select(F.col(key).cast("long").alias("vec_id"), entries.alias("v")).where(F.col("v").isNotNull())
    rows = rows.where(F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf"))))
    held = lambda c: F.greatest(F.least(c * SCALE, F.lit(LARGEST)), F.lit(-LARGEST))
    return rows.select("vec_id", F.transform("v", lambda c: F.floor(held(c)).cast("long") + SHIFT).alias("x"))


def _grid(batch: pa.RecordBatch) -> np.ndarray:
    return np.asarray(pc.list_flatten(batch.column("x")), dtype=np.int64).reshape(batch.num_rows, -1)


def _sums(rows: DataFrame, work, kind: str) -> np.ndarray:
    """Sum over all rows of the numbers that ``work`` makes of a block of them; tasks add up their own first."""
    numbers = np.int64 if kind == "long" else np.float64

    def run(batches):
        total = None
        for batch in batches:
            if batch.num_rows:
                part = work(_grid(batch))
                total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), pa.array(total.astype(numbers))], ["i", "v"])

    found = rows.mapInArrow(run, f"i long, v {kind}").groupBy("i").agg(F.sum("v").alias("v")).collect()
    return np.array([r["v"] for r in sorted(found, key=lambda r: r["i"])], dtype=numbers)


class Fit:
    """The centred fit list: number of vectors, their sums, components and deviations."""

    def __init__(self, rows: DataFrame, dims: int):
        self.rows, self.dims = rows, dims
        first = _sums(rows, lambda x: np.concatenate([[len(x)], x.sum(axis=0)]), "long")
        self.n, self.sums = int(first[0]), first[1:]
        centred = self.centred
        self.trace = float(_sums(rows, lambda x: np.array([(centred(x) ** 2).sum()]), "double")[0])
        self.vectors, self.squares = self._components()

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k != "rows"}

    def centred(self, x: np.ndarray) -> np.ndarray:
        return self.exact(x) / self.n

    def exact(self, x: np.ndarray) -> np.ndarray:
        """``n * x`` less the sums, in whole numbers (of any size where 64 bits are too few)."""
        if x.size and self.n * int(np.abs(x).max()) < 1 << 62 > int(np.abs(self.sums).max()):
            return self.n * x - self.sums
        return self.n * x.astype(object) - self.sums.astype(object)

    def project(self, along: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For t = X ``along[0]``: the products X't, and t'X w for the other rows w of ``along``."""
        exact, n = self.exact, self.n

        def work(x):
            rows = (exact(x) / n).astype(np.float64)
            made = rows @ along.T
            return np.concatenate([rows.T @ made[:, 0], made.T @ made[:, 0]])

        out = _sums(self.rows, work, "double")
        return out[: self.dims], out[self.dims :]

    def _components(self) -> tuple[np.ndarray, np.ndarray]:
        dims, rng = self.dims, np.random.default_rng(SEED)
        right: list[np.ndarray] = []  # v
        left: list[np.ndarray] = []  # w, with u = X w
        images: list[np.ndarray] = []  # X'u
        alphas: list[float] = []
        betas: list[float] = []
        least = np.sqrt(self.trace * FLAT) * 1e-3
        v, beta = self._fresh(rng, right), 0.0
        while v is not None and self.trace > 0:
            w = v - beta * left[-1] if left else v.copy()
            back, made = self.project(np.array([w, *left]))
            # made[0] is the squared length of X w, the rest its projections on earlier left vectors
            for _ in range(2):
                part = made[1:] if len(left) else np.zeros(0)
                if len(left):
                    w = w - part @ np.array(left)
                    back = back - part @ np.array(images)
                    made = np.append(made[0] - (part**2).sum(), np.array(left) @ back)
            alpha = float(np.sqrt(max(made[0], 0.0)))
            if alpha > least:
                w, back = w / alpha, back / alpha
            else:  # v lies where the rows do not reach
                alpha, w, back = 0.0, np.zeros(dims), np.zeros(dims)
            right.append(v)
            left.append(w)
            images.append(back)
            alphas.append(alpha)
            if len(right) == dims:
                break
            following = back - alpha * v
            for _ in range(2):
                following = following - np.array(right).T @ (np.array(right) @ following)
            beta = float(np.linalg.norm(following))
            if beta <= least:
                v, beta = self._fresh(rng, right), 0.0  # an invariant space is exhausted: go on beside it
            else:
                v = following / beta
            if self._settled(alphas, betas, beta):
                break
            betas.append(beta)
        if not alphas:
            return np.zeros((0, dims)), np.zeros(0)
        spread, turned = self._small(alphas, betas[: len(alphas) - 1])
        squares = spread**2 / self.n
        keep = squares > FLAT * squares[0] if squares[0] > 0 else np.zeros(len(squares), dtype=bool)
        count = min(COMPONENTS, int(keep.sum()))
        found = turned[:count] @ np.array(right)
        return found / np.linalg.norm(found, axis=1, keepdims=True), squares[:count]

    @staticmethod
    def _small(alphas: list[float], betas: list[float]) -> tuple[np.ndarray, np.ndarray]:
        """Singular values, falling, and right singular vectors (rows) of the bidiagonal matrix."""
        small = np.diag(alphas) + (np.diag(betas, 1) if betas else 0)
        _, spread, turned = np.linalg.svd(small)
        return spread, turned

    def _fresh(self, rng, right: list[np.ndarray]) -> np.ndarray | None:
        if len(right) == self.dims:
            return None
        v = rng.normal(size=self.dims)
        for _ in range(3):
            if right:
                v = v - np.array(right).T @ (np.array(right) @ v)
            v = v / np.linalg.norm(v)
        return v

    def _settled(self, alphas: list[float], betas: list[float], beta: float) -> bool:
        """Whether the wanted components are found and what is left is too little to hold a larger one."""
        if len(alphas) <= COMPONENTS:
            return False
        small = np.diag(alphas) + np.diag(betas, 1)
        outer, spread, _ = np.linalg.svd(small)
        rest = self.trace - (spread**2).sum() - beta**2
        residual = beta * np.abs(outer[-1, :COMPONENTS])
        return bool(rest < spread[COMPONENTS - 1] ** 2 and (residual <= SETTLED * spread[0]).all())

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return (self.exact(x) / self.n).astype(np.float64) @ self.vectors.T / np.sqrt(self.squares)

    def identity_error(self) -> float:
        """Largest entry of the whitened vectors' covariance less the identity."""
        size = len(self.squares)

        def work(x):
            z = self.whitened(x)
            return np.concatenate([z.sum(axis=0), (z.T @ z).ravel()])

        out = _sums(self.rows, work, "double") / self.n
        mean, square = out[:size], out[size:].reshape(size, size)
        return float(np.abs(square - np.outer(mean, mean) - np.eye(size)).max())

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Exact sums of squares; null where a long is too small for one."""
        parts = self.exact(x)
        largest = int(np.abs(parts).max()) if parts.size else 0
        if largest**2 * self.dims < 1 << 63:
            return (parts.astype(np.int64) ** 2).sum(axis=1).tolist()
        exact = (parts.astype(object) ** 2).sum(axis=1).tolist()
        return [d if d < 1 << 63 else None for d in exact]


_COLUMNS = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def whiten(vectors: DataFrame, *, key: str = "vec_id", column: str = "embedding") -> DataFrame:
    """``vec_id``, ``component`` and the component's whitened coordinate of every row, with the figures of the fit.

    Rows whose vector is null or holds a null or non-finite entry are left out;
    rows with a null id, equal vectors and repeated rows all get their coordinates.
    Vectors of different lengths are fitted apart.  Directions without deviation
    are no components, so equal vectors alone, empty vectors and an empty table
    give no rows.  ``deviation`` is null where 64 bits do not hold it; entries
    beyond 2 ** 40 after scaling count as that.  Other columns are ignored.
    """
    spark = vectors.sparkSession
    rows = staged(whole_vectors(vectors, key, column), "vectors")
    out = None
    for dims in sorted(r["dims"] for r in rows.select(F.size("x").alias("dims")).distinct().collect()):
        mine = rows.where(F.size("x") == dims)
        fit = Fit(staged(mine.select("x").distinct(), "fit"), dims) if dims else None
        if fit is None or not len(fit.squares):
            continue
        found = mine.mapInArrow(_coordinates(fit, fit.identity_error()), _COLUMNS)
        out = found if out is None else out.unionByName(found)
    return spark.createDataFrame([], _COLUMNS) if out is None else out


def _coordinates(fit: Fit, error: float):
    size = len(fit.squares)
    explained = fit.squares * fit.n / fit.trace

    def run(batches):
        for batch in batches:
            for begin in range(0, batch.num_rows, 4096):
                rows = batch.slice(begin, 4096)
                x, count = _grid(rows), rows.num_rows
                each = np.repeat(np.arange(count), size)
                deviations = pa.array(fit.deviations(x), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [
                        rows.column("vec_id").take(pa.array(each)),
                        pa.array(np.tile(np.arange(1, size + 1), count), pa.int32()),
                        pa.array(np.full(count * size, fit.n)),
                        deviations.take(pa.array(each)),
                        pa.array(fit.whitened(x).ravel()),
                        pa.array(np.tile(explained, count)),
                        pa.array(np.full(count * size, error)),
                    ],
                    ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
                )

    return run
