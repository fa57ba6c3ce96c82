"""Whitening of embeddings by mixed-precision eigenvectors of a distributed covariance.

Method. Vectors are turned into integers, so that sums over the cluster are exact and do not depend on the order of tasks. A
first pass adds up the entries of each dimension; a second one centres every vector at the integers nearest to the mean and adds
up the products of centred entries; the rest of the mean, at most 1/2 per entry, is taken off at the end. The covariance is then
known to the last bit. Its eigenvectors come from a float32 solver and are corrected by iterations of matrix products in extended
precision (Ogita and Aishima, "Iterative refinement for symmetric eigenvalue decomposition", 2018; for eigenvalues too close
together for the iteration, part II, 2019: the covariance, shifted and projected on the vectors of such a cluster, is a small
problem of its own, whose solution rotates them; what stays equal after that is one eigenvalue, and any basis of its vectors
is right).

The driver holds the covariance: its size is the square of the dimension, whatever the number of rows, and dimensions above
``MAX_DIMENSION`` are refused. Vectors are not shuffled; tasks add up their batches, and a grouping adds the tasks, one row of
the matrix per key.

Rows are left out if their vector is null, or has null or non-finite entries, or has another number of entries than most of
the others (ties: the larger number). Entries beyond 2^40 (10^12) count as 2^40. Repeated rows and null ids count and appear as often as they are there; an empty table, and
one without a usable vector, gives an empty table. Components exist for eigenvalues above 1e-12 of the largest (a single row or
equal rows have none, and give no output row). ``deviation`` is null where it does not fit 64 bits. Signs: the entry of a
component with the greatest absolute value is positive (ties: the first such entry). Extra columns are left out.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.workspace import materialise

SCALE, OFFSET = 1024, 100_000
COMPONENTS = 8
MAX_DIMENSION = 2048
#: Eigenvalues below this share of the largest one count as none.
RANK_TOLERANCE = 1e-12
ROUNDS = 40
_WIDE = np.longdouble
#: Sums of products of entries below 2^24, 2^12 rows at a time, fit 64 bits.
_ROWS, _SMALL = 1 << 12, 1 << 24
#: Scaled entries are clipped here, so that exact sums fit 38 digits.
_LARGEST = 1 << 50


# ------------------------------------------------------------------ eigenvectors
def _rotated(matrix: np.ndarray, vectors: np.ndarray, values: np.ndarray, near: np.ndarray) -> np.ndarray:
    """The vectors with those of every cluster of close eigenvalues turned by the solution of their own small problem."""
    edges = np.flatnonzero(np.concatenate(([True], ~near, [True])))
    out = vectors.copy()
    for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
        if b - a > 1:
            basis = vectors[:, a:b]
            small = basis.T @ (matrix @ basis) - values[a:b].mean() * (basis.T @ basis)
            small = (small + small.T) / 2
            size = np.abs(small).max()
            if size > 0:
                out[:, a:b] = basis @ np.linalg.eigh((small / size).astype(np.float64))[1].astype(_WIDE)
    return out


def eigen(matrix: np.ndarray, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors (columns) of a symmetric matrix in extended precision, to double precision at
    least: float32 vectors, refined."""
    matrix = np.asarray(matrix, _WIDE)
    scale = np.abs(matrix).max(initial=0)
    if not scale:
        return np.zeros(len(matrix), _WIDE), np.eye(len(matrix), dtype=_WIDE)
    matrix = matrix / scale
    vectors = np.linalg.eigh(matrix.astype(np.float32))[1].astype(_WIDE)
    one, tiny = np.eye(len(matrix), dtype=_WIDE), np.finfo(_WIDE).eps
    norm = np.abs(matrix).sum(axis=0).max()
    best = None
    for _ in range(rounds):
        product = matrix @ vectors
        lack, inner = one - vectors.T @ vectors, vectors.T @ product
        lack, inner = (lack + lack.T) / 2, (inner + inner.T) / 2  # else rounding is blown up where eigenvalues are close
        values = np.diag(inner) / (1 - np.diag(lack))
        order = np.argsort(values, kind="stable")
        vectors, values = vectors[:, order], values[order]
        lack, inner = lack[np.ix_(order, order)], inner[np.ix_(order, order)]
        off = inner - np.diag(values)
        error = np.abs(off).sum(axis=0).max() + norm * np.abs(lack).sum(axis=0).max()
        settled = error <= len(matrix) * 16 * tiny * norm
        if best is not None and error >= best / 2 and settled:
            break
        best = error if best is None else min(best, error)
        gap = values[None, :] - values[:, None]
        apart = np.abs(gap) > 2 * error
        step = np.where(apart, (inner + values[None, :] * lack) / np.where(apart, gap, 1), lack / 2)
        vectors = vectors + vectors @ step
        near = ~apart[np.arange(len(values) - 1), np.arange(1, len(values))]
        if near.any() and not settled:
            vectors = _rotated(matrix, vectors, values, near)
    order = np.argsort(-values, kind="stable")
    values, vectors = values[order] * scale, vectors[:, order]
    for _ in range(2):
        vectors = vectors + vectors @ (one - vectors.T @ vectors) / 2  # orthonormal to the last bit
    main = np.abs(vectors).argmax(axis=0)
    return values, vectors * np.sign(vectors[main, np.arange(len(values))])


# ------------------------------------------------------------------ vectors as integers
def _matrix(batch: pa.RecordBatch, column: str, dimension: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows of a batch that have a usable vector of this dimension, and their entries as integers."""
    vectors = batch.column(column)
    lengths = vectors.value_lengths().fill_null(-1).to_numpy(zero_copy_only=False)
    rows = np.flatnonzero(lengths == dimension)
    entries = vectors.take(pa.array(rows)).flatten().cast(pa.float64())
    entries = entries.to_numpy(zero_copy_only=False).reshape(len(rows), dimension)  # a null entry becomes NaN
    whole = np.isfinite(entries).all(axis=1)
    return rows[whole], np.clip(np.floor(SCALE * entries[whole]), -_LARGEST, _LARGEST).astype(np.int64) + OFFSET


def _sliced(batches):
    for batch in batches:
        for at in range(0, batch.num_rows, _ROWS):
            yield batch.slice(at, _ROWS)


def _total(parts: DataFrame, dimension: int) -> np.ndarray:
    """Integers per key, added over tasks: the keys are rows of the matrix, the entries positions in it."""
    summed = parts.select("i", F.posexplode("sums").alias("j", "s")).groupBy("i", "j").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s"))
    out = np.zeros((dimension, dimension), object)
    for row in summed.collect():  # the square of the dimension, however many rows there are
        out[row.i, row.j] = int(row.s)
    return out


def _sums(vectors: DataFrame, column: str) -> tuple[int, list[int]]:
    """Number of vectors and sums of their entries, for the number of entries that most usable vectors have."""

    def added(batches):
        sums: dict[int, list] = {}
        for batch in _sliced(batches):
            for dimension in set(batch.column(column).value_lengths().to_pylist()) - {None, 0}:
                x = _matrix(batch, column, dimension)[1]
                if len(x):
                    of = sums.setdefault(dimension, [0, 0])
                    of[0] += len(x)
                    of[1] += x.sum(axis=0) if np.abs(x).max() < 1 << 50 else x.astype(object).sum(axis=0)
        if sums:
            yield _rows(sums, [[n, *of.tolist()] for n, of in sums.values()])

    parts = materialise(vectors.mapInArrow(added, "i int, sums array<string>"), "vector-sums")
    count = F.sum(F.get("sums", 0).cast("bigint"))
    top = parts.groupBy("i").agg(count.alias("n")).orderBy(F.desc("n"), F.desc("i")).limit(1).first()
    if top is None:
        return 0, []
    if top.i > MAX_DIMENSION:
        raise ValueError(f"vectors have {top.i} entries, more than {MAX_DIMENSION}")
    of_top = parts.where(F.col("i") == top.i).select(F.posexplode("sums").alias("j", "s"))
    rows = of_top.groupBy("j").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).orderBy("j").collect()
    return top.n, [int(r.s) for r in rows[1:]]


@dataclass(frozen=True)
class Whitening:
    """A fitted whitening. ``centre`` holds the integers nearest to the mean, ``rest`` what the mean is above them."""

    n: int
    sums: list[int]
    centre: np.ndarray
    rest: np.ndarray
    components: np.ndarray
    values: np.ndarray
    trace: float

    def projected(self, x: np.ndarray) -> np.ndarray:
        """Whitened coordinates of integer vectors (rows), the mean unrounded."""
        return ((x - self.centre) - self.rest) @ self.components / np.sqrt(self.values)

    def deviation(self, x: np.ndarray) -> list[int | None]:
        """Exact sums of (n x - S)^2; None beyond 64 bits."""
        if not len(x):
            return []
        sums = np.array(self.sums, object)
        widest = max(abs(self.n * int(v) - s) for col in (x.max(axis=0), x.min(axis=0)) for v, s in zip(col, self.sums, strict=True))
        if widest**2 * len(self.sums) < 1 << 63:
            d = self.n * x - sums.astype(np.int64)
            return (d * d).sum(axis=1).tolist()
        exact = ((self.n * x.astype(object) - sums) ** 2).sum(axis=1)
        return [int(v) if v < 1 << 63 else None for v in exact]


def fit(vectors: DataFrame, column: str = "embedding", components: int = COMPONENTS) -> Whitening | None:
    """Two passes over all vectors. None if there is no usable one."""
    vectors = vectors.select(column)
    n, sums = _sums(vectors, column)
    dimension = len(sums)
    if not n:
        return None
    centre = np.array([(2 * s + n) // (2 * n) for s in sums], np.int64)
    rest = np.array([_WIDE(s - n * int(c)) / _WIDE(n) for s, c in zip(sums, centre, strict=True)], _WIDE)

    def multiplied(batches):
        exact = np.zeros((dimension, dimension), object)
        held, rows = np.zeros((dimension, dimension), np.int64), 0
        for batch in _sliced(batches):
            d = _matrix(batch, column, dimension)[1] - centre
            if np.abs(d).max(initial=0) >= _SMALL:
                wide = d.astype(object)
                exact += wide.T @ wide
            else:
                held += _product(d)
                rows += len(d)
            if rows >= 1 << 13:  # each product is below 2^48, so sums of as many rows are below 2^62
                exact += held
                held[:], rows = 0, 0
        exact += held
        if exact.any():
            yield _rows(range(dimension), exact.tolist())

    products = _total(vectors.mapInArrow(multiplied, "i int, sums array<string>"), dimension)
    covariance = _quotients(products, n) - np.outer(rest, rest)
    values, basis = eigen(covariance)
    some = values[:components] > RANK_TOLERANCE * values[0] if values[0] > 0 else np.zeros(min(components, dimension), bool)
    kept = int(some.sum())
    return Whitening(
        n,
        sums,
        centre,
        rest.astype(np.float64),
        basis[:, :kept].astype(np.float64),
        values[:kept].astype(np.float64),
        float(np.trace(covariance)),
    )


def _product(d: np.ndarray) -> np.ndarray:
    """Exact product of a matrix of small integers with itself, by float64 where that is exact."""
    if int(np.abs(d).max(initial=0)) ** 2 * max(1, len(d)) < 1 << 53:
        f = d.astype(np.float64)
        return (f.T @ f).astype(np.int64)
    return d.T @ d


def _quotients(products: np.ndarray, n: int) -> np.ndarray:
    """Exact integers over n in extended precision."""
    whole = [[divmod(p, n) for p in row] for row in products.tolist()]
    return np.array([[_WIDE(q) + _WIDE(r) / _WIDE(n) for q, r in row] for row in whole], _WIDE)


def _rows(keys, sums: list[list[int]]) -> pa.RecordBatch:
    """Integers of any size as text: a task's sums may be beyond 64 bits."""
    return pa.RecordBatch.from_arrays(
        [pa.array(list(keys), pa.int32()), pa.array([[str(v) for v in row] for row in sums], pa.list_(pa.string()))], ["i", "sums"]
    )


def identity_error(vectors: DataFrame, fitted: Whitening, column: str = "embedding") -> float:
    """Largest absolute entry of the covariance of all whitened vectors minus the identity, from the vectors themselves."""
    k, dimension = len(fitted.values), len(fitted.sums)
    if not k:
        return 0.0

    def moments(batches):
        total, products = np.zeros(k), np.zeros((k, k))
        for batch in _sliced(batches):
            y = fitted.projected(_matrix(batch, column, dimension)[1])
            total += y.sum(axis=0)
            products += y.T @ y
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(k + 1), pa.int32()), pa.array([*products.tolist(), total.tolist()], pa.list_(pa.float64()))], ["i", "sums"]
        )

    parts = vectors.select(column).mapInArrow(moments, "i int, sums array<double>")
    summed = parts.select("i", F.posexplode("sums").alias("j", "s")).groupBy("i", "j").agg(F.sum("s").alias("s")).collect()
    out = np.zeros((k + 1, k))
    for row in summed:
        out[row.i, row.j] = row.s / fitted.n
    return float(np.abs(out[:k] - np.outer(out[k], out[k]) - np.eye(k)).max())


def whiten(vectors: DataFrame, fitted: Whitening | None, id_col: str = "vec_id", column: str = "embedding") -> DataFrame:
    """Per usable row: ``id``, ``deviation`` and ``whitened``, its coordinates by component."""
    dimension = len(fitted.sums) if fitted else 0

    def run(batches):
        for batch in _sliced(batches) if fitted else ():
            rows, x = _matrix(batch, column, dimension)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(id_col).take(pa.array(rows)),
                    pa.array(fitted.deviation(x), pa.int64()),
                    pa.array(fitted.projected(x).tolist(), pa.list_(pa.float64())),
                ],
                ["id", "deviation", "whitened"],
            )

    kind = dict(vectors.select(id_col).dtypes)[id_col]
    return vectors.select(id_col, column).mapInArrow(run, f"id {kind}, deviation bigint, whitened array<double>")


def whitened_components(
    vectors: DataFrame, id_col: str = "vec_id", column: str = "embedding", components: int = COMPONENTS
) -> DataFrame:
    """A row per usable vector and component: id, component (from 1), n, deviation, whitened, explained (share of the
    variance) and identity_error of the fit."""
    fitted = fit(vectors, column, components)
    error = identity_error(vectors, fitted, column) if fitted else 0.0
    shares = (fitted.values / fitted.trace).tolist() if fitted and len(fitted.values) else []
    explained = F.array(*[F.lit(s) for s in shares]) if shares else F.array().cast("array<double>")
    return whiten(vectors, fitted, id_col, column).select(
        "id",
        F.lit(fitted.n if fitted else 0).cast("bigint").alias("n"),
        "deviation",
        F.posexplode(F.arrays_zip(F.col("whitened"), explained.alias("explained"))).alias("at", "of"),
    ).select(
        "id",
        (F.col("at") + 1).alias("component"),
        "n",
        "deviation",
        F.col("of.whitened").alias("whitened"),
        F.col("of.explained").alias("explained"),
        F.lit(error).alias("identity_error"),
    )
