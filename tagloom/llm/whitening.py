"""Whitening of embeddings by pivoted Cholesky and one-sided Jacobi.

Components become integers, ``floor(scale * c) + shift``.  Tasks add up exact sums, then the products of the
centred vectors; what comes to the driver are sums whose size depends on the number of dimensions alone.
The covariance is factored there by Cholesky with pivoting, which stops at its rank, and the columns of the
triangular factor are rotated against each other (one-sided Jacobi, disjoint pairs at a time) until all are
orthogonal.  Their squared norms are the eigenvalues, the normalised columns the components; the covariance's own
eigenproblem is never formed.  The result is checked by a pass of its own: the covariance of the whitened vectors.

Centring is exact: with S a dimension's sum and q = floor(S / n), x - S / n is taken as (x - q) - (S - n q) / n, so
the shift costs no digits.

Vectors that are null, or hold null or non-finite entries (or some of 2^40 and more), are dropped, and so are those
shorter than the longest, which lack entries.  Null ids, repeated rows and ties are kept; further columns do no
harm.  Directions without variance are no components, so equal vectors, a single one or an empty table give no
rows.  A deviation that does not fit a long is null.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.llm.vectors import flat_of, integer_vectors
from tagloom.session import stage

COMPONENTS = 8
_EPS = float(np.finfo(np.float64).eps)
_LONG = 1 << 63
_WHOLE = pa.decimal128(38, 0)


def _matrix(batch: pa.RecordBatch, dims: int) -> np.ndarray:
    return flat_of(batch.column("x"))[1].reshape(-1, dims)


def _sums(dims: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(dims, dtype=object)
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                # 1,024 entries below 2^53 stay inside a long.
                total += _matrix(batch.slice(at, 1024), dims).sum(axis=0).astype(object)
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(dims), pa.int32()), pa.array([Decimal(int(t)) for t in total], _WHOLE)], names=["i", "total"]
        )

    return run


class Centre:
    """The mean of integer vectors as whole and remaining parts of exact sums."""

    def __init__(self, sums: list[int], n: int):
        self.n = n
        self.whole = np.array([s // n for s in sums], dtype=np.int64)
        self.rest = np.array([s % n for s in sums], dtype=np.int64)

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (x - self.whole) - self.rest / self.n

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Exact sums of (n x - S)^2; None beyond a long."""
        near = x - self.whole
        highest = (int(np.abs(near).max(initial=0)) + 1) * self.n
        if highest * highest * max(1, x.shape[1]) < _LONG:
            apart = near * self.n - self.rest
            return (apart * apart).sum(axis=1).tolist()
        apart = near.astype(object) * self.n - self.rest.astype(object)
        return [d if d < _LONG else None for d in (apart * apart).sum(axis=1).tolist()]


def _products(dims: int, centre: Centre, turn: np.ndarray | None = None, mean: np.ndarray | None = None):
    """Sums of products of centred vectors, or of what ``turn`` makes of them less their mean; at i = -1 plain sums."""
    size = dims if turn is None else turn.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scatter, plain = np.zeros((size, size)), np.zeros(size)
        for batch in batches:
            d = centre.centred(_matrix(batch, dims))
            if turn is not None:
                d = d @ turn - mean
            scatter += d.T @ d
            plain += d.sum(axis=0)
        low, high = np.tril_indices(size)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.concatenate((low, np.full(size, -1))), pa.int32()),
                pa.array(np.concatenate((high, np.arange(size))), pa.int32()),
                pa.array(np.concatenate((scatter[low, high], plain))),
            ],
            names=["i", "j", "total"],
        )

    return run


def _gathered(partial: DataFrame, size: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Covariance and mean from the tasks' sums: size * (size + 3) / 2 numbers, whatever the rows."""
    cov, mean = np.zeros((size, size)), np.zeros(size)
    for i, j, total in partial.groupBy("i", "j").agg(F.sum("total")).collect():
        if i < 0:
            mean[j] = total / n
        else:
            cov[i, j] = cov[j, i] = total / n
    return cov - np.outer(mean, mean), mean


def pivoted_cholesky(cov: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A factor and an order of rows: ``cov[order][:, order] = factor @ factor.T``, as many columns as the rank."""
    a, order = cov.copy(), np.arange(len(cov))
    factor = np.zeros_like(a)
    least = _EPS * len(a) * float(a.diagonal().max(initial=0.0))
    for k in range(len(a)):
        p = k + int(np.argmax(a.diagonal()[k:]))
        if not a[p, p] > least:
            return factor[:, :k], order
        if p != k:
            a[[k, p]], factor[[k, p]], order[[k, p]] = a[[p, k]], factor[[p, k]], order[[p, k]]
            a[:, [k, p]] = a[:, [p, k]]
        factor[k, k] = np.sqrt(a[k, k])
        factor[k + 1 :, k] = a[k + 1 :, k] / factor[k, k]
        a[k + 1 :, k + 1 :] -= np.outer(factor[k + 1 :, k], factor[k + 1 :, k])
    return factor, order


def _rounds(size: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs in rounds of disjoint ones, as in a tournament."""
    players = list(range(size + size % 2))
    for _ in range(len(players) - 1):
        half = len(players) // 2
        pairs = [(a, b) for a, b in zip(players[:half], reversed(players[half:])) if max(a, b) < size]
        yield np.array([min(p) for p in pairs], dtype=int), np.array([max(p) for p in pairs], dtype=int)
        players = [players[0], players[-1], *players[1:-1]]


def one_sided_jacobi(factor: np.ndarray, sweeps: int = 60) -> tuple[np.ndarray, np.ndarray]:
    """Squared norms and directions of the factor's columns, rotated until they are orthogonal, by falling norm."""
    g = factor.copy()
    apart = _EPS * max(1, len(g))
    for _ in range(sweeps):
        turned = False
        for p, q in _rounds(g.shape[1]):
            left, right = g[:, p], g[:, q]
            a, b, c = (left * left).sum(axis=0), (right * right).sum(axis=0), (left * right).sum(axis=0)
            turn = np.abs(c) > apart * np.sqrt(a * b)
            if not turn.any():
                continue
            turned = True
            zeta = (b - a) / np.where(turn, 2 * c, 1.0)
            t = np.where(zeta < 0, -1.0, 1.0) / (np.abs(zeta) + np.hypot(1.0, zeta))
            t = np.where(turn, t, 0.0)
            cos = 1 / np.hypot(1.0, t)
            g[:, p], g[:, q] = cos * (left - t * right), cos * (right + t * left)
        if not turned:
            break
    values = (g * g).sum(axis=0)
    order = np.argsort(-values, kind="stable")
    values, g = values[order], g[:, order]
    return values, g / np.sqrt(values)


def components_of(cov: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``count`` largest eigenvalues and their unit eigenvectors; the largest entry of each is positive."""
    factor, order = pivoted_cholesky(cov)
    if not factor.shape[1]:
        return np.zeros(0), np.zeros((len(cov), 0))
    values, rows = one_sided_jacobi(factor)
    vectors = np.zeros_like(rows)
    vectors[order] = rows
    values, vectors = values[:count], vectors[:, :count]
    signs = np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(len(values))])
    return values, vectors * signs


def _whitened(dims: int, centre: Centre, turn: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = turn.shape[1]
        for batch in batches:
            x = _matrix(batch, dims)
            each = pa.array(np.repeat(np.arange(batch.num_rows), count))
            deviation = pa.array(centre.deviations(x), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("vec_id").take(each),
                    pa.array(np.tile(np.arange(1, count + 1), batch.num_rows), pa.int32()),
                    deviation.take(each),
                    pa.array((centre.centred(x) @ turn).ravel()),
                ],
                names=["vec_id", "component", "deviation", "whitened"],
            )

    return run


def whiten(
    rows: DataFrame,
    components: int = COMPONENTS,
    scale: int = 1024,
    shift: int = 100_000,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """Each vector's coordinates on the leading components, in units of their standard deviation."""
    vectors = stage(integer_vectors(rows, scale, shift, id_col, vector_col), "vectors")
    dims = vectors.agg(F.coalesce(F.max(F.size("x")), F.lit(0))).first()[0]
    fit = vectors.where(F.size("x") == dims)
    n = fit.count()
    values, turn, explained, error = np.zeros(0), np.zeros((dims, 0)), [], 0.0
    centre = Centre([0] * dims, 1)
    if n and dims:
        sums = fit.mapInArrow(_sums(dims), "i int, total decimal(38,0)").groupBy("i").agg(F.sum("total").alias("total"))
        # One row a dimension.
        centre = Centre([int(r["total"]) for r in sums.orderBy("i").collect()], n)
        kind = "i int, j int, total double"
        cov, mean = _gathered(fit.mapInArrow(_products(dims, centre), kind), dims, n)
        values, vectors_of = components_of(cov, components)
        turn = vectors_of / np.sqrt(values)
        explained = (values / max(float(np.trace(cov)), np.finfo(float).tiny)).tolist()
        if len(values):
            white, _ = _gathered(fit.mapInArrow(_products(dims, centre, turn, mean @ turn), kind), len(values), n)
            error = float(np.abs(white - np.eye(len(values))).max())
    if not len(values):
        fit = fit.where(F.lit(False))
    found = fit.mapInArrow(_whitened(dims, centre, turn), "vec_id long, component int, deviation long, whitened double")
    shares = F.array(*[F.lit(e) for e in explained]) if explained else F.array(F.lit(0.0))
    return found.select(
        "vec_id", "component", F.lit(n).cast("long").alias("n"), "deviation", "whitened",
        F.get(shares, F.col("component") - 1).alias("explained"),
        F.lit(error).alias("identity_error"),
    )
