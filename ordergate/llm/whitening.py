"""Whitening of embeddings.

Entries c become whole numbers x = floor(``SCALE`` * c) + ``OFFSET``. Each distinct vector x counts once; of these the mean and the
covariance (centred before multiplying, divisor n) are summed by tasks, in two passes. The covariance is as large as
the square of the dimensions, whatever the number of rows; its leading components are found on the driver:

1. Householder reflections make it tridiagonal.
2. The number of eigenvalues below a value is the number of negative pivots there (Sturm). Bisection on these counts brackets
   each of the leading eigenvalues to the last bit, all of them at once.
3. Inverse iteration gives each its vector; vectors of eigenvalues that lie close together are made orthogonal to each other in every round.
4. The reflections turn the vectors back.

Mean and components (dimensions x components numbers) are broadcast, and every row is projected where it lies. A last pass over the distinct
vectors measures how far the covariance of what comes out is from the identity.

Edge cases: vectors that are null, hold a null or an entry that isn't finite, have an entry c with abs(``SCALE`` * c) of 2 ** 52 or more (no whole
numbers beyond), or another length than the most common one (the longer on a tie) are left out. Rows with a null id and repeated rows stay, each with its own rows
in the result. Components whose eigenvalue is no more than rounding (dimensions * 2 ** -52 of the largest) have no direction and are not returned, so
a table with fewer than two distinct vectors, or of empty vectors only, gives no rows. A deviation that doesn't fit a long is null. Components
of equal eigenvalues are some orthonormal basis of their space. Other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordergate.llm.frames import Scratch, arrow_map, map_rows

SCALE, OFFSET, COMPONENTS = 64, 1_000_000, 16
#: Vectors multiplied at a time.
ROWS = 4096
#: Partial sums that one task adds up.
FAN_IN = 64
EPS = 2.0**-52


# The eigenproblem: matrices of dimensions x dimensions

def tridiagonal(a: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Diagonal and off-diagonal of the tridiagonal form of a symmetric matrix, and the reflections (unit vectors) that lead to it."""
    a = a.astype(np.float64).copy()
    d = len(a)
    reflections = []
    for k in range(d - 2):
        x = a[k + 1 :, k].copy()
        scale = np.abs(x).max()
        u = np.zeros(d - k - 1)
        if scale > 0 and np.abs(x[1:]).max(initial=0) > 0:
            u = x / scale
            u[0] += np.copysign(np.linalg.norm(u), u[0])
            u /= np.linalg.norm(u)
            block = a[k + 1 :, k + 1 :]
            p = block @ u
            w = p - (u @ p) * u
            block -= 2 * (np.outer(u, w) + np.outer(w, u))
            x -= 2 * (u @ x) * u
            a[k + 1 :, k] = a[k, k + 1 :] = np.concatenate([x[:1], np.zeros(d - k - 2)])
        reflections.append(u)
    return np.diag(a).copy(), np.diag(a, -1).copy(), reflections


def turned_back(vectors: np.ndarray, reflections: list[np.ndarray]) -> np.ndarray:
    """Vectors (as columns) of the tridiagonal form as vectors of the matrix."""
    out = vectors.copy()
    for k in range(len(reflections) - 1, -1, -1):
        u = reflections[k]
        out[k + 1 :] -= 2 * np.outer(u, u @ out[k + 1 :])
    return out


def count_below(diagonal: np.ndarray, off: np.ndarray, at: np.ndarray) -> np.ndarray:
    """For each value how many eigenvalues of the tridiagonal matrix are smaller: negative pivots of its shifted factorisation."""
    tiny = np.finfo(np.float64).tiny * max(1.0, float((off**2).max(initial=0)))
    counts = np.zeros(len(at), np.int64)
    pivot = np.ones(len(at))
    for i, a in enumerate(diagonal):
        pivot = a - at - (off[i - 1] ** 2 / pivot if i else 0)
        pivot = np.where(np.abs(pivot) < tiny, -tiny, pivot)
        counts += pivot < 0
    return counts


def leading_values(diagonal: np.ndarray, off: np.ndarray, k: int) -> np.ndarray:
    """The k largest eigenvalues of a tridiagonal matrix, falling, by bisection."""
    d = len(diagonal)
    reach = np.abs(np.concatenate([[0], off])) + np.abs(np.concatenate([off, [0]]))
    low, high = float((diagonal - reach).min()), float((diagonal + reach).max())
    margin = EPS * d * max(abs(low), abs(high)) + np.finfo(np.float64).tiny
    lo, hi = np.full(k, low - margin), np.full(k, high + margin)
    index = d - 1 - np.arange(k)  # among rising eigenvalues
    for _ in range(2000):
        mid = lo + (hi - lo) / 2
        open_ = (mid > lo) & (mid < hi)
        if not open_.any():
            break
        above = count_below(diagonal, off, mid) <= index
        lo, hi = np.where(open_ & above, mid, lo), np.where(open_ & ~above, mid, hi)
    return lo + (hi - lo) / 2


def _solved(diagonal: np.ndarray, off: np.ndarray, shift: float, right: np.ndarray, least: float) -> np.ndarray:
    """z with (T - shift) z = right, by elimination with row exchanges; pivots below ``least`` are raised to it."""
    d = len(diagonal)
    a, b, c, rhs = diagonal - shift, np.append(off, 0.0), np.zeros(d), right.copy()
    for i in range(d - 1):  # row i holds a, b, c from column i on
        low, diag, up = off[i], a[i + 1], b[i + 1]
        if abs(low) > abs(a[i]):
            a[i], b[i], c[i], low, diag, up = low, diag, up, a[i], b[i], c[i]
            rhs[i], rhs[i + 1] = rhs[i + 1], rhs[i]
        if abs(a[i]) < least:
            a[i] = least
        f = low / a[i]
        a[i + 1], b[i + 1] = diag - f * b[i], up - f * c[i]
        rhs[i + 1] -= f * rhs[i]
    if abs(a[-1]) < least:
        a[-1] = least
    z = np.zeros(d + 2)
    for i in range(d - 1, -1, -1):
        z[i] = (rhs[i] - b[i] * z[i + 1] - c[i] * z[i + 2]) / a[i]
        if abs(z[i]) > 1e100:  # only the direction counts
            z *= 1e-100
            rhs *= 1e-100
    return z[:d]


def leading_vectors(diagonal: np.ndarray, off: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Unit vectors (as columns) of the given falling eigenvalues of a tridiagonal matrix, by inverse iteration."""
    d = len(diagonal)
    norm = float((np.abs(diagonal) + np.abs(np.append(off, 0.0)) + np.abs(np.append(0.0, off))).max(initial=0))
    least, close, apart = max(EPS * norm, np.finfo(np.float64).tiny), 1e-3 * norm, 10 * EPS * norm
    rng = np.random.default_rng(1)
    out = np.zeros((d, len(values)))
    first, shift = 0, np.inf
    for j, value in enumerate(values):
        if j and values[j - 1] - value > close:
            first = j  # a new cluster
        shift = min(float(value), shift - apart)  # shifts of one cluster differ, or the solutions would not
        z = rng.standard_normal(d)
        for _ in range(6):
            z = _solved(diagonal, off, shift, z / np.linalg.norm(z), least)
            z /= np.abs(z).max()
            for _ in range(2):
                z -= out[:, first:j] @ (out[:, first:j].T @ z)
        out[:, j] = z / np.linalg.norm(z)
    return out


def leading_components(covariance: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The largest eigenvalues of a covariance, falling, and their unit vectors as columns; at most k, and none that is only rounding."""
    d = len(covariance)
    if not d or not np.abs(covariance).max():
        return np.zeros(0), np.zeros((d, 0))
    diagonal, off, reflections = tridiagonal(covariance)
    values = leading_values(diagonal, off, min(k, d))
    values = values[values > d * EPS * values[0]]
    return values, turned_back(leading_vectors(diagonal, off, values), reflections)


# The rows

def whole_numbers(vectors: DataFrame, id_: str, vector: str, scale: int) -> DataFrame:
    """Rows (id, x array<long>, without the offset) of the vectors that take part."""
    scaled = F.transform(F.col(vector), lambda c: c.cast("double") * scale)
    fits = F.col(vector).isNotNull() & F.forall(scaled, lambda c: F.coalesce((F.abs(c) < 2.0**52) & ~F.isnan(c), F.lit(False)))
    rows = vectors.select(F.col(id_).alias("id"), F.when(fits, scaled).alias("v")).where("v is not null")
    sizes = rows.groupBy(F.size("v").alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("d")).limit(1).collect()
    return rows.where(F.size("v") == (sizes[0]["d"] if sizes else -1)).select("id", F.transform("v", lambda c: F.floor(c).cast("long")).alias("x"))


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _added(parts: DataFrame, dtype: str) -> np.ndarray:
    """Sum of the rows' matrices (part int, i int, row array): by groups of tasks first, so that no task adds all of them."""

    def add(t: pa.Table) -> pa.Table:
        return pa.table({"part": t["part"][:1], "i": t["i"][:1], "row": pa.array([_matrix(t["row"].combine_chunks()).sum(0)])})

    schema = f"part int, i int, row array<{dtype}>"
    by_group = parts.withColumn("part", F.expr(f"part div {FAN_IN}").cast("int")).groupBy("part", "i").applyInArrow(add, schema)
    whole = by_group.withColumn("part", F.lit(0)).groupBy("part", "i").applyInArrow(add, schema)
    # one row per dimension
    return np.array([r["row"] for r in sorted(whole.collect(), key=lambda r: r["i"])])


def _partial(rows: DataFrame, one, dtype: str) -> np.ndarray:
    """The sum over all rows of the matrices ``one`` makes of blocks of vectors."""

    def run(batches):
        total = None
        for batch in batches:
            for low in range(0, len(batch), ROWS):
                block = one(_matrix(batch.slice(low, ROWS).column(0)))
                total = block if total is None else total + block
        if total is not None:
            yield pa.RecordBatch.from_pydict({"i": pa.array(np.arange(len(total), dtype=np.int32)), "row": pa.array(list(total))})

    parts = arrow_map(rows.select("x"), run, f"i int, row array<{dtype}>").withColumn("part", F.spark_partition_id())
    return _added(parts.select("part", "i", "row"), dtype)


@dataclass
class Whitening:
    """What whitening needs: the number of distinct vectors, their sums (without offset), eigenvalues, components as columns, trace, and the
    largest difference of the whitened covariance from the identity."""

    n: int
    sums: np.ndarray
    values: np.ndarray
    components: np.ndarray
    trace: float
    identity_error: float = 0.0


def _centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n * x - sums, exactly: as 64-bit numbers, or as Python's where they might not do."""
    bound = n * int(np.abs(x).max(initial=0)) + max((abs(s) for s in sums), default=0)
    if bound < 2**62:
        return x * n - np.array(sums, np.int64)
    return x.astype(object) * n - np.array(sums, object)


def fit(rows: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """The whitening of ``rows`` (id, x); None if they have no direction."""
    scratch = Scratch(rows.sparkSession, "whitening")
    distinct = scratch.keep(rows.select("x").distinct())
    n = distinct.count()
    # sums of 2 ** 52 at most, in two halves, so that no sum of theirs overflows
    halves = _partial(distinct, lambda x: np.stack([(x >> 26).sum(0), (x & (2**26 - 1)).sum(0)]), "long") if n > 1 else np.zeros((2, 0), np.int64)
    if not halves.size:
        return None
    sums = [(int(a) << 26) + int(b) for a, b in halves.T]

    def product(x):
        y = _centred(x, n, sums).astype(np.float64) / n
        return y.T @ y

    covariance = _partial(distinct, product, "double") / n
    covariance = (covariance + covariance.T) / 2
    values, vectors = leading_components(covariance, components)
    if not len(values):
        return None
    model = Whitening(n, sums, values, vectors, float(np.trace(covariance)))
    weights = vectors / np.sqrt(values)

    def moments(x):
        w = (_centred(x, n, sums).astype(np.float64) / n) @ weights
        return np.vstack([w.T @ w, w.sum(0)])

    moment = _partial(distinct, moments, "double") / n
    mean = moment[-1]
    model.identity_error = float(np.abs(moment[:-1] - np.outer(mean, mean) - np.eye(len(values))).max())
    return model


def _squares(y: np.ndarray) -> list[int | None] | np.ndarray:
    """Exact sums of squares of each row; null beyond 64 bits."""
    if y.dtype != object and int(np.abs(y).max(initial=0)) ** 2 * y.shape[1] < 2**63:
        return (y * y).sum(1)
    sums = [sum(v * v for v in map(int, row)) for row in y]
    return [s if s < 2**63 else None for s in sums]


def transform(rows: DataFrame, model: Whitening) -> DataFrame:
    """Rows (vec_id, component, n, deviation, whitened, explained, identity_error): each row of ``rows`` (id, x) by each component."""
    k = len(model.values)
    kind = dict(rows.dtypes)["id"]
    held = rows.sparkSession.sparkContext.broadcast((model.n, model.sums, model.components / np.sqrt(model.values), model.values / model.trace, model.identity_error))

    def run(batch):
        n, sums, weights, explained, error = held.value
        for low in range(0, len(batch), ROWS):
            part = batch.slice(low, ROWS)
            y = _centred(_matrix(part.column(1)), n, sums)
            m = len(part)
            deviation = pa.array(_squares(y), pa.int64())
            by_row = pa.array(np.repeat(np.arange(m), k))
            yield {"vec_id": part.column(0).take(by_row), "component": pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                   "n": pa.array(np.full(m * k, n)), "deviation": deviation.take(by_row),
                   "whitened": pa.array((y.astype(np.float64) / n @ weights).ravel()), "explained": pa.array(np.tile(explained, m)),
                   "identity_error": pa.array(np.full(m * k, error))}

    return map_rows(rows.select("id", "x"), run, f"vec_id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double")


def whiten(vectors: DataFrame, components: int = COMPONENTS, scale: int = SCALE, id_: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``transform`` of all usable ``vectors`` by the whitening fitted to them."""
    rows = Scratch(vectors.sparkSession, "whole").keep(whole_numbers(vectors, id_, vector, scale))
    model = fit(rows, components)
    if model is None:
        return transform(rows.limit(0), Whitening(1, [], np.ones(1), np.zeros((0, 1)), 1.0))
    return transform(rows, model)
