"""Embedding whitening with principal components by FEAST contour integration.

The covariance of all vectors is summed on Spark; what remains is an eigenvalue problem of the size of one vector, whatever
the number of rows. FEAST solves it by intervals: a contour of complex shifts encloses an interval, the solves of the
shifted covariance at the quadrature nodes, weighted and summed, project a block of vectors onto the interval's eigenspace,
and a Rayleigh-Ritz step in that space gives eigenvalues and components; the block is projected again until the residuals
settle. Inertia counts (the signs of the pivots of the shifted covariance, Sylvester's law) place the intervals, size the
block and verify at the end that no eigenvalue was missed.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyforge.llm import common as C
from tallyforge.session import ship

#: Components returned, Gauss-Legendre nodes on a half contour, eigenvalues that one interval is meant to hold, FEAST iterations.
COMPONENTS, NODES, PER_INTERVAL, ITERATIONS = 8, 12, 4, 40
#: Entries become floor(SCALE * c) + SHIFT.
SCALE, SHIFT = 1024, 100_000
#: Vectors with an entry beyond this are left out: sums of squares of whole numbers stay exact below it.
LARGEST = 2.0**52


# --- eigenpairs of a symmetric matrix ---------------------------------------------------------------------------


def inertia(a: np.ndarray, shift: float) -> int:
    """How many eigenvalues of a symmetric matrix lie above ``shift``: the positive pivots of an LDL' factorisation of
    ``a - shift``, by blocks of one and two with complete pivoting."""
    m = a - shift * np.eye(len(a))
    above, limit = 0, (1 + np.sqrt(17)) / 8
    while len(m):
        diagonal = np.abs(np.diag(m))
        p = int(diagonal.argmax())
        off = np.abs(m - np.diag(np.diag(m)))
        r, s = np.unravel_index(int(off.argmax()), off.shape)
        if off[r, s] == 0 and diagonal[p] == 0:
            return above  # what is left is zero: eigenvalues at the shift itself
        if diagonal[p] >= limit * off[r, s]:
            keep = np.delete(np.arange(len(m)), p)
            above += int(m[p, p] > 0)
            m = m[np.ix_(keep, keep)] - np.outer(m[keep, p], m[keep, p]) / m[p, p]
        else:
            keep = np.delete(np.arange(len(m)), [r, s])
            block = m[np.ix_([r, s], [r, s])]
            above += 1 if np.linalg.det(block) < 0 else 2 * int(block[0, 0] > 0)
            m = m[np.ix_(keep, keep)] - m[np.ix_(keep, [r, s])] @ np.linalg.solve(block, m[np.ix_([r, s], keep)])
        m = (m + m.T) / 2
    return above


def _bisect(a: np.ndarray, number: int, radius: float) -> float:
    """A point at most a millionth of the radius under the eigenvalue of this number, counted from the largest."""
    low, high = -radius, radius
    while high - low > 1e-6 * radius:
        mid = (low + high) / 2
        low, high = (mid, high) if inertia(a, mid) >= number else (low, mid)
    return low


def intervals(a: np.ndarray, k: int, per_interval: int = PER_INTERVAL) -> list[tuple[float, float, int]]:
    """Intervals, highest first, with their numbers of eigenvalues, that hold the ``k`` largest ones. Bisection on inertia
    counts finds the eigenvalues around each cut, which lies midway; where they are one cluster, the cut comes after it."""
    d = len(a)
    radius = max(np.abs(a).sum(axis=1).max(), 1e-300) * 1.01
    margin = 1e-5 * radius
    out: list[tuple[float, float, int]] = []
    done, above = 0, _bisect(a, 1, radius)
    top = above + margin
    while done < k:
        last = min(done + per_interval, k)
        under = _bisect(a, last, radius)
        while last < d and under - (after := _bisect(a, last + 1, radius)) <= margin:
            last, under = last + 1, after
        low = (under + after) / 2 if last < d else under - margin
        # the upper end follows the interval's own largest eigenvalue
        high = min(top, above + max(margin, (above - low) / 20))
        count = inertia(a, low) - done
        out.append((low, high, count))
        done += count
        if done < k:
            top, above = low, after
    return out


def feast(a: np.ndarray, low: float, high: float, count: int, seed: int = 1, nodes: int = NODES) -> tuple[np.ndarray, np.ndarray]:
    """The ``count`` eigenpairs of the symmetric ``a`` in (low, high), largest first. Raises if the iteration doesn't settle
    on as many as the inertia counts say."""
    d = len(a)
    size = min(d, 2 * count + 8)
    scale = max(np.abs(a).sum(axis=1).max(), 1e-300)
    x, w = np.polynomial.legendre.leggauss(nodes)
    angle = np.pi / 2 * (1 - x)
    centre, radius = (low + high) / 2, (high - low) / 2
    for attempt in range(3):
        block = np.linalg.qr(np.random.default_rng(seed + attempt).standard_normal((d, size)))[0]
        last = np.inf
        for _ in range(ITERATIONS):
            projected = np.zeros_like(block)
            for t, weight in zip(angle, w, strict=True):
                solved = np.linalg.solve((centre + radius * np.exp(1j * t)) * np.eye(d) - a, block.astype(complex))
                projected += weight / 2 * np.real(radius * np.exp(1j * t) * solved)
            basis, sizes, _ = np.linalg.svd(projected, full_matrices=False)
            basis = basis[:, sizes > 1e-14 * max(sizes[0], 1e-300)]
            values, inner = np.linalg.eigh(basis.T @ a @ basis)
            vectors = basis @ inner
            inside = np.flatnonzero((values > low) & (values < high))
            if len(inside) >= count:
                residual = np.linalg.norm(a @ vectors[:, inside] - vectors[:, inside] * values[inside], axis=0)
                inside = inside[np.argsort(residual)[:count]]
                worst = residual[np.argsort(residual)[:count]].max() / scale if count else 0.0
                # converged, or at the level of rounding where more projections gain nothing
                if worst <= 1e-15 * np.sqrt(d) or (worst <= 1e-12 and worst > last / 2):
                    order = inside[np.argsort(-values[inside], kind="stable")]
                    return values[order], vectors[:, order]
                last = worst
            block = vectors if vectors.shape[1] == size else np.concatenate([vectors, np.random.default_rng(seed).standard_normal((d, size - vectors.shape[1]))], axis=1)
        size = min(d, 2 * size)
    raise RuntimeError("the contour iteration found fewer eigenvalues than the inertia counts")


def largest(a: np.ndarray, k: int = COMPONENTS, per_interval: int = PER_INTERVAL) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` largest eigenvalues of a symmetric matrix and unit eigenvectors (columns), verified to miss none."""
    k = min(k, len(a))
    if not k:
        return np.zeros(0), np.zeros((len(a), 0))
    values, vectors = [], []
    for low, high, count in intervals(a, k, per_interval):
        e, v = feast(a, low, high, count)
        if len(e) != count:
            raise RuntimeError("an eigenvalue was missed")
        values.append(e)
        vectors.append(v)
    e, v = np.concatenate(values), np.concatenate(vectors, axis=1)
    return e[:k], v[:, :k]


# --- on Spark ---------------------------------------------------------------------------------------------------


def _matrix(column: pa.Array, width: int | None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of the usable rows of a list column, and their entries: whole rows of finite numbers, of one length."""
    size = np.diff(column.offsets.to_numpy())
    flat = column.flatten()
    whole = column.is_valid().to_numpy(zero_copy_only=False) & (size > 0)
    values = flat.cast(pa.float64()).to_numpy(zero_copy_only=False)  # null: NaN
    with np.errstate(invalid="ignore"):
        bad = ~(np.abs(values) * SCALE < LARGEST)
    size = np.where(column.is_valid().to_numpy(zero_copy_only=False), size, 0)
    begin = np.cumsum(size) - size
    count = np.concatenate(([0], np.cumsum(bad)))
    whole &= count[begin + size] == count[begin]
    for n in np.unique(size[whole]).tolist() if width is None else [width]:
        at = np.flatnonzero(whole & (size == n))
        if len(at):
            yield at, values[begin[at][:, None] + np.arange(n)]


def _whole(values: np.ndarray) -> np.ndarray:
    return np.floor(SCALE * values).astype(np.int64) + SHIFT


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows and sums of each dimension, for each length; sums are split in two parts that cannot overflow."""
    held: dict[int, list] = {}
    for batch in batches:
        for _, values in _matrix(batch.column(0), None):
            x = _whole(values)
            n, high, low = held.setdefault(x.shape[1], [0, np.zeros(x.shape[1], np.int64), np.zeros(x.shape[1], np.int64)])
            held[x.shape[1]] = [n + len(x), high + (x >> 26).sum(axis=0), low + (x & ((1 << 26) - 1)).sum(axis=0)]
    for width, (n, high, low) in held.items():
        yield pa.RecordBatch.from_arrays([pa.array(np.full(width, width)), pa.array(np.arange(width)), pa.array(np.full(width, n)), pa.array(high), pa.array(low)], ["width", "dim", "n", "high", "low"])


@dataclass
class Fit:
    """What the rows are whitened with: all of the size of one vector or its square."""

    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    trace: float

    def __post_init__(self) -> None:
        # the mean as a whole number and the rest, so that x - S/n loses nothing to cancellation
        self.whole = np.array([s // self.n for s in self.sums], dtype=np.int64)
        self.rest = np.array([(s % self.n) / self.n for s in self.sums])

    def centred(self, values: np.ndarray) -> np.ndarray:
        return (_whole(values) - self.whole) - self.rest


def _outer(fit: Fit):  # noqa: ANN202
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for _, values in _matrix(batch.column(0), len(fit.sums)):
                for a in range(0, len(values), 1 << 14):
                    z = fit.centred(values[a : a + (1 << 14)])
                    total = z.T @ z if total is None else total + z.T @ z
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), C.list_column(list(total), pa.float64())], ["dim", "row"])

    return run


def _deviation(fit: Fit, x: np.ndarray) -> list[int | None]:
    """Sum over the dimensions of (n x - S)^2 in whole numbers; null beyond a long."""
    off = x - fit.whole
    largest_off = int(np.abs(off).max(initial=0)) + 1
    left = np.array([s % fit.n for s in fit.sums], dtype=np.int64)
    if (largest_off * fit.n) ** 2 * len(fit.sums) < 1 << 63:
        return ((off * fit.n - left) ** 2).sum(axis=1).tolist()
    sums = (sum((int(v) * fit.n - int(r)) ** 2 for v, r in zip(row, left, strict=True)) for row in off)
    return [s if s < 1 << 63 else None for s in sums]


def _whiten(fit: Fit):  # noqa: ANN202
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, values in _matrix(batch.column(1), len(fit.sums)):
                for a in range(0, len(at), 1 << 14):
                    some = values[a : a + (1 << 14)]
                    white = fit.centred(some) @ fit.vectors / np.sqrt(fit.values)
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).take(pa.array(at[a : a + (1 << 14)])), pa.array(_deviation(fit, _whole(some)), pa.int64()), C.list_column(list(white), pa.float64())],
                        ["vec_id", "deviation", "white"],
                    )

    return run


def _products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums and products of the whitened columns."""
    total = None
    for batch in batches:
        flat, offs = C.list_parts(batch.column(0))
        if batch.num_rows:
            white = flat[offs[0] : offs[-1]].reshape(batch.num_rows, -1)
            wide = np.concatenate([white, np.ones((len(white), 1))], axis=1)
            total = wide.T @ wide if total is None else total + wide.T @ wide
    if total is not None:
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), C.list_column(list(total), pa.float64())], ["dim", "row"])


def _summed(parts: DataFrame, width: int) -> np.ndarray:
    """A matrix from the tasks' parts, summed on the executors: ``width`` times ``width`` numbers come to the driver."""
    out = np.zeros((width, width))
    for r in parts.select("dim", F.posexplode("row").alias("at", "v")).groupBy("dim", "at").agg(F.sum("v").alias("v")).toLocalIterator():
        out[r.dim, r["at"]] = r.v
    return out


def fit(rows: DataFrame, k: int = COMPONENTS, vector: str = "embedding") -> Fit | None:
    """Means and components of all usable vectors; None if there are none. See ``whiten`` for what is usable."""
    ship(rows.sparkSession)
    vectors = rows.select(F.col(vector).cast("array<double>").alias("v"))
    found: dict[int, list] = {}
    sums = vectors.mapInArrow(C.tidy(_sums), "width long, dim long, n long, high long, low long").groupBy("width", "dim")
    for r in sums.agg(F.sum("n").alias("n"), F.sum(F.col("high").cast("decimal(38,0)")).alias("high"), F.sum(F.col("low").cast("decimal(38,0)")).alias("low")).orderBy("width", "dim").toLocalIterator():
        held = found.setdefault(r.width, [r.n, []])
        held[1].append((int(r.high) << 26) + int(r.low))
    if not found:
        return None
    width = max(found, key=lambda w: (found[w][0], w))
    n, totals = found[width]
    none = Fit(n, totals, np.zeros(0), np.zeros((width, 0)), 0.0)
    covariance = _summed(vectors.mapInArrow(C.tidy(_outer(none)), "dim long, row array<double>"), width) / n
    covariance = (covariance + covariance.T) / 2
    trace = float(np.trace(covariance))
    values, components = largest(covariance, k)
    kept = values > trace * 1e-13 * width
    return Fit(n, totals, values[kept], components[:, kept], trace)


def whiten(rows: DataFrame, k: int = COMPONENTS, vector: str = "embedding", id_col: str = "vec_id") -> DataFrame:
    """Vectors projected on their ``k`` first principal components, scaled to variance one.

    One row per usable vector: ``vec_id, deviation, white`` (an array, by falling eigenvalue), with ``n``, ``explained`` (an
    array of shares of the trace) and ``identity_error``, which is measured on the whitened rows. An entry ``c`` counts as
    ``floor(1024 c) + 100000``; the covariance of all usable vectors, centred before multiplying, has the divisor ``n``.

    A vector is usable if it is not null or empty, all entries are finite and below 2**42, and its length is the most
    frequent one (of equally frequent, the longest). Fewer than ``k`` components are returned where the vectors have fewer
    dimensions or do not vary in more; equal vectors only, or no usable ones, give no rows of components. Equal eigenvalues have
    components in no certain order. ``deviation`` is exact, and null where it exceeds a long. A null id is kept; repeated
    rows count each; other columns are ignored. Sums of doubles depend on the order of tasks in their last digits.
    """
    spark = rows.sparkSession
    ship(spark)
    model = fit(rows, k, vector)
    schema = "vec_id long, deviation long, white array<double>"
    if model is None or not len(model.values):
        return spark.createDataFrame([], f"{schema}, n long, explained array<double>, identity_error double")
    use = rows.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("v"))
    white = C.stage(use.mapInArrow(C.tidy(_whiten(model)), schema), "whitened")
    held = len(model.values)
    products = _summed(white.select("white").mapInArrow(C.tidy(_products), "dim long, row array<double>"), held + 1)
    mean = products[:held, held] / model.n
    error = float(np.abs(products[:held, :held] / model.n - np.outer(mean, mean) - np.eye(held)).max())
    shares = F.array(*(F.lit(float(e) / model.trace) for e in model.values))
    return white.select("vec_id", "deviation", "white", F.lit(model.n).cast("long").alias("n"), shares.alias("explained"), F.lit(error).alias("identity_error"))


def digest(white: DataFrame) -> DataFrame:
    """One row for each vector and component."""
    each = white.select("vec_id", "n", "deviation", "explained", "identity_error", F.posexplode("white").alias("at", "whitened"))
    return each.select("vec_id", (F.col("at") + 1).alias("component"), "n", "deviation", "whitened", F.element_at("explained", F.col("at") + 1).alias("explained"), "identity_error")
