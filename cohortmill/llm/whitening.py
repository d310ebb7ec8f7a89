"""Whitening of embeddings on eigenvectors that are right to double precision.

1. ``grid``: each entry as a whole number, x = floor(64 * c) + 1000000.
2. The fit list is each distinct x vector once.  Its sums are exact; its second moments are taken
   about a whole-number center, by tasks, one matrix each, summed by Spark per entry.
3. ``refined_eigen``: eigenvectors of the covariance in single precision, corrected by
   Ogita-Aishima iterations, which are matrix products in extended precision.  Eigenvalues closer
   than the error bound of a round cannot be told apart by its correction; their vectors are
   made orthogonal by it, and turned within their space by a solve of the small block.
4. Every row is projected, and the covariance of the projected fit list is compared with the identity.

The driver sees the sums and one covariance, d * (d + 1) / 2 numbers for vectors of length d, and sends
the wanted eigenvectors to the tasks; nothing there grows with the rows.  Repeated rows meet in an
aggregate that combines before the shuffle.

Defined results: a row is left out if its vector is null or empty, holds a null, non-finite or huge
(beyond 2**46) entry, or has another length than most of the others (of equally many, the longer ones).
Components end with the rank: none has an eigenvalue that rounding alone explains, so one vector, or
copies of one, give no rows.  ``deviation`` is null where it exceeds a long.  Repeated rows, repeated
and null ids give a set of rows each.  Extra columns are ignored.  An empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortmill.llm.textbytes import small_batches
from cohortmill.storage import materialize

#: Fixed values of the grid, and how many components are wanted.
STEPS, SHIFT, COMPONENTS = 64, 1_000_000, 16
#: Entries from here on leave no exact whole numbers.
HUGE = float(1 << 46)
#: An eigenvalue below this share of the trace is rounding.
RANK_TOLERANCE = 1e-13
#: Rounds of correction at most, and a correction whose square is below extended precision.
ROUNDS, SETTLED = 12, 1e-10


def grid(embeddings: DataFrame, column: str = "embedding") -> DataFrame:
    """(vec_id, x) of the usable rows, x as array<bigint>."""
    small_batches(embeddings.sparkSession)

    def results(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = batch.column("vector")
            offsets = np.concatenate([[0], np.cumsum(vectors.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))])
            entries = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)  # a null becomes NaN
            bad = ~np.isfinite(entries) | (np.abs(entries) >= HUGE)
            n_bad = np.concatenate([[0], np.cumsum(bad)])
            usable = (np.diff(offsets) > 0) & (n_bad[offsets[1:]] == n_bad[offsets[:-1]])
            whole = np.floor(STEPS * np.where(bad, 0.0, entries)).astype(np.int64) + SHIFT
            x = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(whole))
            kept = pa.array(usable)
            yield pa.RecordBatch.from_arrays([batch.column("vec_id").filter(kept), x.filter(kept)], ["vec_id", "x"])

    rows = embeddings.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col(column).cast("array<double>").alias("vector"))
    usable = rows.mapInArrow(results, "vec_id bigint, x array<bigint>")
    return usable


def _matrix(column: pa.Array) -> np.ndarray:
    """Rows of equal length as a matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _sums(fit_list: DataFrame) -> tuple[int, list[int]]:
    """Rows of the fit list and its exact sum per dimension."""

    def results(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, None
        for batch in batches:
            if batch.num_rows:
                x = _matrix(batch.column("x"))
                low = (x & 0xFFFFFF).sum(axis=0).astype(object)
                total = (0 if total is None else total) + low + ((x >> 24).sum(axis=0).astype(object) << 24)
                n += len(x)
        if n:
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(len(total)), pa.int32()), pa.array([n] * len(total), pa.int64()), pa.array(map(str, total))],
                ["dimension", "n", "total"],
            )

    parts = fit_list.select("x").mapInArrow(results, "dimension int, n bigint, total string")
    rows = (
        parts.groupBy("dimension")
        .agg(F.sum("n").alias("n"), F.sum(F.col("total").cast("decimal(38,0)")).alias("total"))
        .orderBy("dimension")
        .collect()  # one row per dimension
    )
    return (rows[0].n if rows else 0), [int(r.total) for r in rows]


def _moments(rows: DataFrame, project, width: int) -> np.ndarray:
    """Sums of products of all pairs of columns of ``project(x)``; one symmetric matrix."""
    upper = np.triu_indices(width)

    def results(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, seen = np.zeros((width, width)), False
        for batch in batches:
            if batch.num_rows:
                y = project(_matrix(batch.column("x")))
                total += y.T @ y
                seen = True
        if seen:
            yield pa.RecordBatch.from_arrays(
                [pa.array(upper[0], pa.int32()), pa.array(upper[1], pa.int32()), pa.array(total[upper])], ["i", "j", "v"]
            )

    parts = rows.select("x").mapInArrow(results, "i int, j int, v double")
    out = np.zeros((width, width))
    for r in parts.groupBy("i", "j").agg(F.sum("v").alias("v")).collect():  # width * (width + 1) / 2 rows
        out[r.i, r.j] = out[r.j, r.i] = r.v
    return out


def _clusters(values: np.ndarray, bound: float) -> list[np.ndarray]:
    """Runs of two or more eigenvalues, in falling order, whose neighbours lie within ``bound``."""
    order = np.argsort(-values, kind="stable")
    breaks = np.flatnonzero(-np.diff(values[order]) > bound) + 1
    return [run for run in np.split(order, breaks) if len(run) > 1]


def refined_eigen(v: np.ndarray, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors (columns) of a symmetric matrix, beyond double precision.

    The start is the decomposition in single precision.  A round forms, in extended precision, how far
    the vectors are from orthogonal (r) and from diagonal (s), and from both the first-order
    correction.  Pairs whose eigenvalues differ by less than the round's bound get the orthogonal part
    only, and are then separated by a solve of their own block.
    """
    v = v.astype(np.longdouble)
    size = np.abs(v).max(initial=0)
    if not size:
        return np.zeros(len(v)), np.eye(len(v))
    v = v / size
    x = np.linalg.eigh(v.astype(np.float32))[1].astype(np.longdouble)
    identity = np.eye(len(v), dtype=np.longdouble)
    for _ in range(rounds):
        r = identity - x.T @ x
        s = x.T @ (v @ x)
        value = np.diag(s) / (1 - np.diag(r))
        off = s - np.diag(value)
        # Frobenius norms bound the spectral ones.
        bound = 2 * (np.sqrt((off**2).sum()) + np.abs(value).max() * np.sqrt((r**2).sum()))
        gap = value[None, :] - value[:, None]
        apart = np.abs(gap) > bound
        e = np.where(apart, (s + value[None, :] * r) / np.where(apart, gap, 1), r / 2)
        x = x + x @ e
        turned = False
        for run in _clusters(value, float(bound)):
            # A multiple of the identity is taken off first, so the block holds the differences alone.
            block = x[:, run]
            inner = block.T @ (v @ block - value[run].mean() * block)
            inner = (inner + inner.T) / 2
            if np.abs(inner - np.diag(np.diag(inner))).max() > 8 * np.finfo(np.longdouble).eps:
                turn = np.linalg.eigh((inner / np.abs(inner).max()).astype(float))[1]
                x[:, run] = block @ turn[:, ::-1].astype(np.longdouble)
                turned = True
        if np.abs(e).max() < SETTLED and not turned:
            break
    # What solves in double precision left of orthogonality goes with the orthogonal part alone.
    for _ in range(2):
        x = x + x @ (identity - x.T @ x) / 2
    value = (x * (v @ x)).sum(axis=0) / (x * x).sum(axis=0) * size
    x = x / np.sqrt((x * x).sum(axis=0))
    order = np.argsort(-value, kind="stable")
    x = x[:, order]
    # Either sign is right; the largest entry is made positive.
    x = x * np.where(x[np.abs(x).argmax(axis=0), np.arange(x.shape[1])] < 0, -1, 1)
    return value[order], x


@dataclass
class Whitener:
    n: int
    center: np.ndarray  # whole numbers near the mean
    rest: list[int]  # sums less n * center
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    identity_error: float = math.nan

    @property
    def count(self) -> int:
        return len(self.values)

    def project(self, x: np.ndarray) -> np.ndarray:
        """Whitened coordinates of rows of the grid."""
        off = (x - self.center).astype(np.float64) - np.array([r / self.n for r in self.rest])
        return off @ self.vectors / np.sqrt(self.values)

    def deviation(self, x: np.ndarray) -> list[int | None]:
        """Exact sums of squares of n * x - S; None beyond a long."""
        off = x - self.center
        about = ((off.astype(np.float64) * self.n - np.array(self.rest, dtype=np.float64)) ** 2).sum(axis=1)
        # Rows far below the limit stay within whole numbers of 64 bits in every step.
        safe = (about < 2.0**61) & (np.abs(off).max(axis=1).astype(np.float64) * self.n < 2.0**61)
        rest = np.array([min(r, 1 << 62) for r in self.rest], dtype=np.int64)
        exact = ((off[safe] * self.n - rest) ** 2).sum(axis=1) if max(self.rest) < 1 << 61 else None
        out: list[int | None] = [None] * len(x)
        if exact is not None:
            for row, d in zip(np.flatnonzero(safe).tolist(), exact.tolist()):
                out[row] = d
        for row in np.flatnonzero(~safe | (exact is None)).tolist():
            d = sum((int(o) * self.n - r) ** 2 for o, r in zip(off[row], self.rest))
            out[row] = d if d < 1 << 63 else None
        return out


def fit_whitener(fit_list: DataFrame, components: int = COMPONENTS) -> Whitener | None:
    """The whitener of the rows (column ``x``) of ``fit_list``, as they are; None without any component."""
    n, total = _sums(fit_list)
    if not n:
        return None
    center = [t // n for t in total]
    rest = [t - n * c for t, c in zip(total, center)]
    about = np.array(center, dtype=np.int64)
    second = _moments(fit_list, lambda x: (x - about).astype(np.float64), len(center)).astype(np.longdouble)
    off = np.array([np.longdouble(r) / np.longdouble(n) for r in rest])
    covariance = second / np.longdouble(n) - np.outer(off, off)
    trace = float(np.trace(covariance))
    values, vectors = refined_eigen(covariance)
    kept = int((values[:components] > RANK_TOLERANCE * trace).sum()) if trace > 0 else 0
    if not kept:
        return None
    fitted = Whitener(n, about, rest, values[:kept].astype(float), vectors[:, :kept].astype(float), trace)
    # Columns: the components and a one, so that means come out of the same sums.
    sums = _moments(fit_list, lambda x: np.column_stack([fitted.project(x), np.ones(len(x))]), kept + 1) / n
    mean = sums[:-1, -1]
    fitted.identity_error = float(np.abs(sums[:-1, :-1] - np.outer(mean, mean) - np.eye(kept)).max())
    return fitted


RESULT = (
    "vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
)


def whiten(embeddings: DataFrame, column: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """One row per usable row and component, numbered from 1 by falling eigenvalue."""
    rows = materialize(grid(embeddings, column), "grid")
    widths = rows.groupBy(F.size("x").alias("width")).count().orderBy(F.desc("count"), F.desc("width")).limit(1)
    common = widths.first()
    if common is None:
        return rows.sparkSession.createDataFrame([], RESULT)
    rows = rows.where(F.size("x") == common.width)
    fitted = fit_whitener(materialize(rows.select("x").distinct(), "fit-list"), components)
    if fitted is None:
        return rows.sparkSession.createDataFrame([], RESULT)

    def results(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = fitted.count
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _matrix(batch.column("x"))
            each = pa.array(np.repeat(np.arange(len(x)), k))
            deviation = pa.array(fitted.deviation(x), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("vec_id").take(each),
                    pa.array(np.tile(np.arange(1, k + 1), len(x)), pa.int32()),
                    pa.array(np.full(len(x) * k, fitted.n)),
                    deviation.take(each),
                    pa.array(fitted.project(x).ravel()),
                    pa.array(np.tile(fitted.values / fitted.trace, len(x))),
                    pa.array(np.full(len(x) * k, fitted.identity_error)),
                ],
                ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    return rows.mapInArrow(results, RESULT)
