"""Embedding whitening (operator 12): pivoted Cholesky, then one-sided Jacobi.

Each entry c of a vector becomes the integer x = floor(1024 c) + 100000.  Three
map-only passes over the vectors, each merging fixed-size sums:

1. exact integer sums S of every dimension and the number n of vectors;
2. the scatter of the centred vectors, one d x d sum a task;
3. the projection on the leading components, scaled to unit variance.

The driver holds d x d numbers (d is the length of the vectors, so this does
not grow with the rows) and fits the model on them: the scatter is factored by
Cholesky with diagonal pivoting, which stops at its numerical rank, and the
columns of the triangular factor are rotated in pairs until all are orthogonal
(one-sided Jacobi, disjoint pairs at once).  The squared norm of a rotated
column is an eigenvalue of the scatter and the normalised column its
eigenvector, so the covariance is never diagonalised itself.  Centring uses the
integer part of S / n exactly and its rest as a double, so large offsets cost
no digits.  ``identity_error`` comes from a last aggregate over the stored
whitened values (Spark's centred, mergeable covariances).

Results: vectors that are null or hold a null or non-finite entry go; every
other row of the table, also with a null or repeated id, gives a row for each
component.  There are as many components as the rank allows: one vector alone,
equal vectors or an empty table give none, hence no rows.  Shorter vectors count
as continued with entries 0; empty vectors too.  Entries beyond 2^50 in x count
as 2^50.  ``deviation`` is null where it does not fit a long; its digits are
in ``deviation_digits`` at any size.  Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType, StringType, StructField, StructType

from quarry.llm.common import Scratch

COMPONENTS = 8

# Fixed values of the contract: scale and offset of the integer entries.
SCALE = 1024
OFFSET = 100_000

LARGEST = float(1 << 50)
#: Numbers of a slice of vectors handled at once.
SLICE = 1 << 20


@dataclass
class Fit:
    """The fitted model: ``whole`` + ``rest`` / n is the mean of x."""

    n: int
    whole: np.ndarray
    rest: np.ndarray
    components: np.ndarray  # d x k, unit columns
    eigenvalues: np.ndarray  # of the covariance, falling
    explained: np.ndarray


def whiten(table: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error,
    deviation_digits), a row for each remaining vector and component."""
    spark = table.sparkSession
    vectors = valid_vectors(table)
    fit = fit_components(vectors, components)
    scratch = Scratch(spark)
    projected = scratch.store(project(vectors, fit), "projected")
    k = len(fit.eigenvalues)
    error = identity_error(projected, k)
    explained = F.array(*[F.lit(float(e)) for e in fit.explained]).cast("array<double>")
    rows = projected.select("vec_id", "deviation", "deviation_digits", F.posexplode("whitened").alias("at", "whitened"))
    return scratch.finish(rows.select(
        "vec_id", (F.col("at") + 1).cast("int").alias("component"), F.lit(fit.n).cast("long").alias("n"), "deviation", "whitened",
        F.get(explained, "at").alias("explained"), F.lit(error).cast("double").alias("identity_error"), "deviation_digits",
    ))


def valid_vectors(table: DataFrame) -> DataFrame:
    """(vec_id, embedding) of the vectors whose entries are all finite."""
    bad = F.exists("embedding", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    return table.select("vec_id", "embedding").filter(F.col("embedding").isNotNull() & ~bad)


def integers(column: pa.ListArray, d: int) -> Iterator[np.ndarray]:
    """x of slices of the vectors: matrices of d columns."""
    values = column.values.to_numpy(zero_copy_only=False)
    offsets = column.offsets.to_numpy()
    step = max(1, SLICE // max(d, 1))
    for a in range(0, len(column), step):
        cut = offsets[a : a + step + 1]
        lens = np.diff(cut)
        part = values[cut[0] : cut[-1]].astype(np.float64)
        if (lens == d).all():
            c = part.reshape(len(lens), d)
        else:
            c = np.zeros((len(lens), d))
            c[np.arange(d) < lens[:, None]] = part
        with np.errstate(over="ignore"):
            yield np.clip(np.floor(c * SCALE) + OFFSET, -LARGEST, LARGEST).astype(np.int64)


def fit_components(vectors: DataFrame, components: int = COMPONENTS) -> Fit:
    n, sums = exact_sums(vectors)
    d = len(sums)
    whole = np.array([s // n for s in sums], np.int64)
    rest = np.array([(s % n) / n for s in sums])
    v = scatter(vectors, whole, rest) / max(n, 1)
    e, q = eigen(v)
    k = min(components, len(e))
    trace = float(np.trace(v)) if d else 0.0
    return Fit(n, whole, np.array([s % n for s in sums], object), q[:, :k], e[:k], e[:k] / trace if k else e[:k])


def exact_sums(vectors: DataFrame) -> tuple[int, list[int]]:
    """The number of vectors and the exact sum of x in every dimension."""
    schema = pa.schema([("dim", pa.int32()), ("n", pa.int64()), ("high", pa.int64()), ("low", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("embedding")
            lens = np.diff(column.offsets.to_numpy())
            d = int(lens.max(initial=0))
            high, low, n = np.zeros(d, np.int64), np.zeros(d, np.int64), 0
            for x in integers(column, d):
                high += (x >> 32).sum(0)
                low += (x & 0xFFFFFFFF).sum(0)
                n += len(x)
            # dimension -1 counts the vectors; longer ones elsewhere are met below
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(-1, d), pa.int32()), pa.array(np.full(d + 1, n)), pa.array([0, *high], pa.int64()), pa.array([0, *low], pa.int64())], schema=schema
            )

    exact = {c: F.sum(F.col(c).cast("decimal(38,0)")).alias(c) for c in ("n", "high", "low")}
    parts = vectors.select("embedding").mapInArrow(run, "dim int, n long, high long, low long").groupBy("dim").agg(*exact.values())
    got = {r.dim: (int(r.n), (int(r.high) << 32) + int(r.low)) for r in parts.collect()}  # a row a dimension
    n = got.pop(-1, (0, 0))[0]
    # a batch without a vector of this length adds the offset for each of its vectors
    return n, [got[j][1] + OFFSET * (n - got[j][0]) for j in range(len(got))]


def centred(x: np.ndarray, whole: np.ndarray, rest: np.ndarray) -> np.ndarray:
    return (x - whole).astype(np.float64) - rest


def scatter(vectors: DataFrame, whole: np.ndarray, rest: np.ndarray) -> np.ndarray:
    """Sum of the outer products of the centred vectors."""
    d = len(whole)
    upper = np.triu_indices(d)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((d, d))
        for batch in batches:
            for x in integers(batch.column("embedding"), d):
                c = centred(x, whole, rest)
                total += c.T @ c
        yield pa.RecordBatch.from_arrays([pa.array([total[upper]], pa.list_(pa.float64()))], names=["part"])

    if not d:
        return np.zeros((0, 0))
    parts = vectors.select("embedding").mapInArrow(run, "part array<double>")
    cells = parts.select(F.posexplode("part").alias("at", "part")).groupBy("at").agg(F.sum("part").alias("part"))
    out = np.zeros((d, d))
    got = np.zeros(len(upper[0]))
    for r in cells.collect():  # d (d + 1) / 2 numbers
        got[r["at"]] = r["part"]
    out[upper] = got
    return out + np.triu(out, 1).T


def pivoted_cholesky(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """L (d x rank) and the order p with v[p][:, p] = L Lᵀ, L lower triangular."""
    d = len(v)
    v = v.copy()
    p = np.arange(d)
    factor = np.zeros((d, d))
    limit = d * np.finfo(float).eps * np.diag(v).max(initial=0.0)
    for k in range(d):
        j = k + int(np.argmax(np.diag(v)[k:]))
        if not v[j, j] > limit:
            return factor[:, :k], p
        for m in (v, v.T):
            m[[k, j]] = m[[j, k]]
        factor[[k, j]] = factor[[j, k]]
        p[[k, j]] = p[[j, k]]
        factor[k:, k] = v[k:, k] / np.sqrt(v[k, k])
        v[k + 1 :, k + 1 :] -= np.outer(factor[k + 1 :, k], factor[k + 1 :, k])
    return factor, p


def one_sided_jacobi(factor: np.ndarray, sweeps: int = 60) -> np.ndarray:
    """Rotate pairs of columns until all are orthogonal to working precision.
    Every sweep meets all pairs, in rounds of disjoint ones."""
    a = factor.copy()
    r = a.shape[1]
    if r < 2:
        return a
    size = r + r % 2  # an odd column rests
    ring = np.arange(size)
    eps = np.finfo(float).eps * max(a.shape)
    for _ in range(sweeps):
        turned = False
        for _ in range(size - 1):
            i, j = ring[: size // 2], ring[size // 2 :][::-1]
            ok = (i < r) & (j < r)
            i, j = i[ok], j[ok]
            x, y = a[:, i], a[:, j]
            xx, yy, xy = (x * x).sum(0), (y * y).sum(0), (x * y).sum(0)
            turn = np.abs(xy) > eps * np.sqrt(xx * yy)
            if turn.any():
                turned = True
                i, j, x, y = i[turn], j[turn], x[:, turn], y[:, turn]
                zeta = (yy[turn] - xx[turn]) / (2 * xy[turn])
                t = np.where(zeta >= 0, 1.0, -1.0) / (np.abs(zeta) + np.hypot(1.0, zeta))
                c = 1 / np.hypot(1.0, t)
                s = c * t
                a[:, i], a[:, j] = c * x - s * y, s * x + c * y
            ring = np.concatenate([ring[:1], np.roll(ring[1:], 1)])
        if not turned:
            break
    return a


def eigen(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues (falling) and unit eigenvectors of a scatter, up to its rank;
    each vector's entry of greatest size is positive."""
    factor, p = pivoted_cholesky(v)
    turned = one_sided_jacobi(factor)
    norms = np.sqrt((turned * turned).sum(0))
    order = np.argsort(-norms, kind="stable")
    q = np.zeros_like(turned)
    q[p] = turned[:, order] / norms[order]
    top = np.abs(q).argmax(0) if q.size else np.zeros(0, int)
    return norms[order] ** 2, q * np.where(q[top, np.arange(q.shape[1])] < 0, -1.0, 1.0)


def project(vectors: DataFrame, fit: Fit) -> DataFrame:
    """(vec_id, deviation, deviation_digits, whitened): map-only."""
    schema = StructType([
        StructField("vec_id", vectors.schema["vec_id"].dataType), StructField("deviation", LongType()),
        StructField("deviation_digits", StringType()), StructField("whitened", ArrayType(DoubleType())),
    ])
    n, whole = fit.n, fit.whole
    remainder = fit.rest
    rest = np.array([float(r) / n for r in remainder])
    axes = fit.components / np.sqrt(fit.eigenvalues)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for x in integers(batch.column("embedding"), len(whole)):
                exact = _deviations(x, n, whole, remainder)
                w = centred(x, whole, rest) @ axes
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("vec_id").slice(at, len(x)),
                        pa.array([v if v < 1 << 63 else None for v in exact], pa.int64()),
                        pa.array([str(v) for v in exact]),
                        pa.array(list(w), pa.list_(pa.float64())),
                    ],
                    names=["vec_id", "deviation", "deviation_digits", "whitened"],
                )
                at += len(x)

    return vectors.mapInArrow(run, schema)


def _deviations(x: np.ndarray, n: int, whole: np.ndarray, remainder: np.ndarray) -> list[int]:
    """Exact sums over dimensions of (n x - S)^2, with n x - S = n (x - whole) - remainder."""
    far = int(np.abs(x - whole).max(initial=0)) + 1
    if (n * far) ** 2 * max(x.shape[1], 1) < 1 << 63:
        y = n * (x - whole) - remainder.astype(np.int64)
        return (y * y).sum(1).tolist()
    y = n * (x - whole).astype(object) - remainder
    return [int(v) for v in (y * y).sum(1)]


def identity_error(projected: DataFrame, k: int) -> float:
    """Greatest entry of the whitened values' covariance minus the identity."""
    if not k:
        return 0.0
    w = [F.col("whitened")[i] for i in range(k)]
    cells = {(i, j): F.covar_pop(w[i], w[j]).alias(f"c{i}_{j}") for i in range(k) for j in range(i, k)}
    row = projected.agg(*cells.values()).first()
    return max(abs((row[f"c{i}_{j}"] or 0.0) - (i == j)) for i, j in cells)
