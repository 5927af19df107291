"""Embedding whitening by mixed-precision refinement of a distributed covariance.

Entries become integers, ``floor(1024 c) + 100000``, so that counts, sums and products are
exact whatever the partitioning. One pass sums the vectors, a second one the products of
the centred vectors; tasks reduce their rows to one matrix before anything is shuffled and
the driver meets ``dims * dims`` numbers, never rows. The eigenvectors start in float32 and
are corrected there by Ogita-Aishima steps, each a few matrix products in extended
precision that square the error. Eigenvalues closer than a step can tell apart form
clusters: their vectors are rotated by an eigenproblem of the cluster alone, shifted to its
middle, and refined again. A last pass projects every row on the leading components; the
covariance of what it wrote gives ``identity_error``.

Rows whose vector is null, or holds a null or non-finite entry or one of 2^43 and more
(beyond exact integers), are dropped, and so are vectors that are not of the most frequent
length (of equally frequent ones the longest). Repeated rows each count and each get their
rows, a null id is kept, other columns are ignored. Components are at most as many as
dimensions. An eigenvalue of zero (constant vectors, or beyond the rank) has no direction
to whiten: its ``whitened`` is null, and so is ``explained`` if the total variance is zero;
``identity_error`` covers the other components, 0 if there is none. ``deviation`` is null
beyond 38 digits. An empty table, or one without usable vectors, gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weekloom.llm.common import pick
from weekloom.sources.staging import stage

COMPONENTS = 8
SCALE = 1024
SHIFT = 100_000
#: Entries below this have exact integers.
LARGEST = 2.0**43
#: Floats count integers exactly below this.
EXACT = 1 << 53
ROUNDS = 30

WHITENED = (
    "vec_id long, component int, n long, deviation decimal(38,0), whitened double, "
    "explained double, identity_error double"
)
PROJECTED = "vec_id long, deviation decimal(38,0), w array<double>"
TOTALS = "i int, j int, total decimal(38,0)"


@dataclass(frozen=True)
class Basis:
    """What a row needs: counts, exact sums, eigenvalues and unit vectors in columns."""

    n: int
    sums: tuple[int, ...]
    values: np.ndarray
    vectors: np.ndarray
    trace: float


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, embedding): rows of finite entries, as doubles."""
    rows = pick(vectors, "vec_id", "embedding").select(
        F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>")
    )
    # A comparison with NaN or an infinity is false, with null it is null.
    fits = F.forall("embedding", lambda c: F.coalesce(F.abs(c) < LARGEST, F.lit(False)))
    return rows.filter((F.size("embedding") > 0) & fits)


def common_length(rows: DataFrame) -> int | None:
    lengths = rows.groupBy(F.size("embedding").alias("dims")).count()
    best = lengths.orderBy(F.desc("count"), F.desc("dims")).head(1)
    return best[0].dims if best else None


def integers(batch: pa.RecordBatch, dims: int) -> np.ndarray:
    """The batch's vectors as an integer matrix."""
    column = batch.column(1)
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return np.floor(flat.reshape(-1, dims) * SCALE).astype(np.int64) + SHIFT


def products(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """``left.T @ right`` of integer matrices, exact, as Python integers."""
    top = int(np.abs(left).max(initial=0)) * int(np.abs(right).max(initial=0))
    if top * len(left) < EXACT:
        found = left.astype(np.float64).T @ right.astype(np.float64)
        return found.astype(np.int64).astype(object)
    return left.astype(object).T @ right.astype(object)


def total_rows(matrix: np.ndarray) -> Iterator[pa.RecordBatch]:
    """The matrix's upper triangle (a single row: all of it) as rows."""
    i, j = np.triu_indices(matrix.shape[0], m=matrix.shape[1])
    kinds = [pa.int32(), pa.int32(), pa.decimal128(38, 0)]
    data = [i, j, [Decimal(v) for v in matrix[i, j]]]
    arrays = [pa.array(d, k) for d, k in zip(data, kinds, strict=True)]
    yield pa.RecordBatch.from_arrays(arrays, ["i", "j", "total"])


def summed(rows: DataFrame, dims: int, pivot: np.ndarray | None) -> dict[tuple[int, int], int]:
    """Exact totals over all rows, by task first.

    Without ``pivot`` the vectors' sums (j) and, as j = dims, their number; with it the
    products of the vectors less the pivot.
    """

    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = 0
        for batch in batches:
            x = integers(batch, dims)
            if pivot is None:
                ones = np.ones((len(x), 1), np.int64)
                total = total + products(ones, np.hstack([x, ones]))
            else:
                total = total + products(x - pivot, x - pivot)
        if not isinstance(total, int):
            yield from total_rows(total)

    found = rows.mapInArrow(reduce, TOTALS).groupBy("i", "j").agg(F.sum("total").alias("total"))
    return {(r.i, r.j): int(r.total) for r in found.collect()}  # dims * dims rows at most


def refine(a: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """One Ogita-Aishima step: (eigenvalues, better vectors, what it could not separate).

    ``x`` holds approximate eigenvectors of the symmetric ``a`` in columns. Pairs of
    eigenvalues within the returned distance only become orthogonal.
    """
    r = np.eye(len(a), dtype=a.dtype) - x.T @ x
    s = x.T @ a @ x
    values = np.diag(s) / (1 - np.diag(r))
    rest = s - np.diag(values)
    limit = 2 * (norm(rest) + norm(a) * norm(r))
    gap = values[None, :] - values[:, None]
    apart = np.abs(gap) > limit
    e = np.where(apart, (s + values[None, :] * r) / np.where(apart, gap, 1), r / 2)
    return values, x + x @ e, float(limit)


def norm(m: np.ndarray) -> np.floating:
    """A bound of the spectral norm of a symmetric matrix."""
    return np.abs(m).sum(axis=1).max(initial=0)


def clusters(values: np.ndarray, distance: float) -> Iterator[np.ndarray]:
    """Index runs of neighbouring eigenvalues no further apart than ``distance``."""
    order = np.argsort(values)
    cuts = np.flatnonzero(np.diff(values[order]) > distance) + 1
    for run in np.split(order, cuts):
        if len(run) > 1:
            yield run


def sub_solve(a: np.ndarray, x: np.ndarray, values: np.ndarray, run: np.ndarray) -> None:
    """Rotates the vectors of one cluster by the eigenproblem in their own span.

    Shifted to the cluster's middle, the small problem resolves in double what is lost
    beside the large eigenvalues.
    """
    part, middle = x[:, run], values[run].mean()
    inner = part.T @ (a @ part) - middle * (part.T @ part)
    size = np.abs(inner).max()
    if size > 0:
        _, turn = np.linalg.eigh(((inner + inner.T) / (2 * size)).astype(np.float64))
        x[:, run] = part @ turn.astype(x.dtype)


def eigen(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors in columns of a symmetric matrix.

    float32 gives the start, extended precision the corrections. Where steps stop to
    improve, the eigenvalues they cannot tell apart are solved cluster by cluster, and the
    steps go on from there, as long as that helps.
    """
    scale = np.abs(a).max(initial=0)
    if not scale > 0:
        return np.zeros(len(a)), np.eye(len(a))
    a = a.astype(np.longdouble) / scale
    x = np.linalg.eigh(a.astype(np.float32))[1].astype(np.longdouble)
    tiny = float(np.finfo(np.longdouble).eps) * len(a)
    before = stalled = np.inf
    for _ in range(ROUNDS):
        values, x, limit = refine(a, x)
        if limit <= tiny:
            break
        if limit < before / 2:
            before = limit
            continue
        if limit >= stalled / 2:
            break
        before, stalled = np.inf, limit
        for run in clusters(values, 4 * limit):
            sub_solve(a, x, values, run)
    x = x + x @ (np.eye(len(a)) - x.T @ x) / 2
    squares = (x * x).sum(axis=0)
    values = ((a @ x) * x).sum(axis=0) / squares
    order = np.argsort(-values, kind="stable")
    x = (x / np.sqrt(squares))[:, order]
    lead = x[np.abs(x).argmax(axis=0), np.arange(len(a))]
    values = np.where(values > tiny * len(a), values, 0)[order] * scale
    return values.astype(np.float64), (x * np.where(lead < 0, -1, 1)).astype(np.float64)


def fit(rows: DataFrame, dims: int) -> Basis:
    """The basis of all ``rows(vec_id, embedding)``, which have ``dims`` entries each."""
    found = summed(rows, dims, None)
    n, sums = found[0, dims], [found[0, j] for j in range(dims)]
    # Whole numbers next to the means: products stay exact, what is left is below one.
    pivot = np.array([(2 * s + n) // (2 * n) for s in sums], np.int64)
    found = summed(rows, dims, pivot)
    cov = np.empty((dims, dims), np.longdouble)
    off = [s - n * int(p) for s, p in zip(sums, pivot, strict=True)]
    for (i, j), total in found.items():
        # n * n times the covariance as one integer, divided once.
        cov[i, j] = cov[j, i] = ratio(n * total - off[i] * off[j], n * n)
    values, vectors = eigen(cov)
    return Basis(n, tuple(sums), values, vectors, float(np.trace(cov)))


def ratio(above: int, below: int) -> np.longdouble:
    """An integer quotient in extended precision."""
    whole, rest = divmod(above, below)
    return np.longdouble(whole) + np.longdouble(rest / below)


def projected(rows: DataFrame, dims: int, basis: Basis, k: int) -> DataFrame:
    """(vec_id, deviation, w): each vector's numbers on the first ``k`` components."""
    lead, values = basis.vectors[:, :k], basis.values[:k]
    n, sums = basis.n, np.array(basis.sums, object)
    pivot = np.array([s // n for s in basis.sums], np.int64)
    rest = np.array([int(s) - n * int(p) for s, p in zip(sums, pivot, strict=True)])
    kind = pa.decimal128(38, 0)

    def deviations(x: np.ndarray) -> pa.Array:
        """Sums of (n x - sums) squared, n x - sums being n (x - pivot) - rest."""
        x = x - pivot
        top = int(np.abs(x).max()) + 1
        if (n * top) ** 2 * dims < 1 << 62:
            d = n * x - rest
            return pa.array((d * d).sum(axis=1)).cast(kind)
        d = n * x.astype(object) - rest
        totals = (d * d).sum(axis=1)
        return pa.array([Decimal(t) if t < 10**38 else None for t in totals], kind)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = integers(batch, dims)
            if not len(x):
                continue
            along = ((x - pivot) - rest / n) @ lead
            nothing = np.full(along.shape, np.nan)
            w = np.divide(along, np.sqrt(values), out=nothing, where=values > 0)
            flat = pa.array(w.reshape(-1), from_pandas=True)
            places = pa.array(np.arange(0, len(x) * k + 1, k), pa.int32())
            lists = pa.ListArray.from_arrays(places, flat)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), deviations(x), lists], ["vec_id", "deviation", "w"]
            )

    return rows.mapInArrow(project, PROJECTED)


def identity_error(white: DataFrame, k: int, n: int) -> float:
    """Largest entry of the covariance of ``white(w)``, its first k, less the identity."""

    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k + 1, k + 1))
        for batch in batches:
            w = batch.column(0).flatten().to_numpy(zero_copy_only=False)
            w = w.reshape(batch.num_rows, -1)[:, :k] if batch.num_rows else np.zeros((0, k))
            w = np.hstack([w, np.ones((len(w), 1))])
            total += w.T @ w
        i, j = np.indices(total.shape).reshape(2, -1)
        arrays = [pa.array(v, pa.int32()) for v in (i, j)] + [pa.array(total.reshape(-1))]
        yield pa.RecordBatch.from_arrays(arrays, ["i", "j", "total"])

    parts = white.mapInArrow(reduce, "i int, j int, total double")
    total = np.zeros((k + 1, k + 1))
    for r in parts.groupBy("i", "j").agg(F.sum("total").alias("total")).collect():
        total[r.i, r.j] = r.total  # (k + 1) squared rows
    mean = total[:k, k] / n
    found = total[:k, :k] / n - np.outer(mean, mean)
    return float(np.abs(found - np.eye(k)).max(initial=0))


def whiten(vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """``WHITENED`` rows: every usable vector on each of the leading components."""
    rows = usable(vectors)
    dims = common_length(rows)
    if dims is None:
        return vectors.sparkSession.createDataFrame([], WHITENED)
    rows = rows.filter(F.size("embedding") == dims)
    basis = fit(rows, dims)
    k = min(components, dims)
    white = stage(projected(rows, dims, basis, k), "whitened")
    positive = int((basis.values[:k] > 0).sum())
    error = identity_error(white.select("w"), positive, basis.n) if positive else 0.0
    shares = [F.lit(float(v) / basis.trace if basis.trace > 0 else None) for v in basis.values[:k]]
    return white.select(
        "vec_id", "deviation", F.posexplode("w").alias("place", "whitened")
    ).select(
        "vec_id",
        (F.col("place") + 1).alias("component"),
        F.lit(basis.n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.get(F.array(*shares), F.col("place")).cast("double").alias("explained"),
        F.lit(error).alias("identity_error"),
    )
