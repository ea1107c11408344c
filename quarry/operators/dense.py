"""Blocks of a dense matrix: wide numeric rows stored once.

A block is a matrix of up to ``BLOCK`` rows and ``BLOCK_BYTES``: features, target
and weight as packed doubles, and for mini-batches a bit a row and step.  A pass
reads whole matrices, so

* gradients of many weight vectors are two matrix products a block, and
* means and co-moments are one product of the centred block.

The blocks are an RDD that the executors keep, in memory and then on their
disks, and nowhere else; its bytes go to Python as they are, a tenth of what
reading, decoding and converting a table costs every time.  They are compressed,
column by column, since the values of a column are more alike than those of a
row.  Blocks are small: the heap gives whole regions of 1 MB to an array of half
a region, and Parquet reads and writes binary values of 1 MB by the hundred.

Centred moments of blocks merge pairwise (count, mean, co-moments and their
correction for the two means), never as raw squares, so they do not cancel over
billions of rows.  A task merges its blocks; the tasks' rows merge in rounds of
at most ``FAN_IN`` a task until one is left, so nothing that grows with the
table meets in one place.  A round's row holds d^2 numbers for d columns.

Rows with a NULL or NaN in a feature, the target or the weight are left out;
``Blocks.skipped`` says how many there were.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import RDD
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.functions.digest import Md5Messages
from quarry.operators.logistic import LOSS_EPSILON
from quarry.plans.store import Workspace
from quarry.sources.tables import spread

BLOCK = 4096
BLOCK_BYTES = 256 << 10
CODEC = pa.Codec("lz4")
FAN_IN = 32


@dataclass
class Batches:
    """Mini-batches of ``steps`` steps by a hash of (seed, step, key), the rows
    of ``split.batch_member``."""

    key: Column
    fraction: float
    seed: int
    steps: int


@dataclass
class Blocks:
    """Kept blocks of the named features: ``(rows, skipped, packed, bits)``, the
    matrix as ``_matrix`` reads it, and with batches a row of bits a step."""

    kept: RDD
    features: list[str]
    rows: int
    skipped: int

    def release(self) -> None:
        """Give memory and disk back before the workspace goes."""
        self.kept.unpersist(blocking=True)


def pack(
    df: DataFrame, features: Sequence[str], work: Workspace, label: str = "label", weight: Column | None = None,
    batches: Batches | None = None,
) -> Blocks:
    """Keep ``df`` as blocks until ``work`` goes, with ``batches`` also each
    row's membership in every step's batch.  A block that an executor loses is
    made from ``df`` again."""
    feats = list(features)
    columns = [F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(feats)]
    weight = F.lit(1.0) if weight is None else weight.cast("double")
    names = [*[f"x{i}" for i in range(len(feats))], "y", "w"]
    key = [] if batches is None else [batches.key.cast("string").alias("key")]
    rows = spread(df.select(*columns, F.col(label).cast("double").alias("y"), weight.alias("w"), *key))
    hashed = None if batches is None else (batches.seed, range(1, batches.steps + 1), round(batches.fraction * 10_000))
    most, steps = block_rows(len(names)), batches.steps if batches else 0

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            m = np.stack([batch.column(c).fill_null(np.nan).to_numpy(zero_copy_only=False) for c in names])
            whole = ~np.isnan(m).any(0)
            m, bad = m[:, whole], int((~whole).sum())
            members = _members(batch.column("key").filter(pa.array(whole)), *hashed) if hashed else None
            for a in range(0, max(m.shape[1], 1), most):
                part = m[:, a : a + most]
                bits = np.packbits(members[:, a : a + most], axis=1).tobytes() if hashed else b""
                yield pa.RecordBatch.from_pydict({"n": [part.shape[1]], "skipped": [bad if a == 0 else 0], "m": [_packed(part)], "members": [bits]})

    def read(rows: Iterator) -> Iterator[tuple[int, int, bytes, np.ndarray | None]]:
        for n, skipped, m, members in rows:
            yield n, skipped, bytes(m), np.frombuffer(members, np.uint8).reshape(steps, -1) if steps else None

    kept = work.keep(rows.mapInArrow(run, "n long, skipped long, m binary, members binary").rdd.mapPartitions(read))
    n, skipped = kept.map(lambda block: block[:2]).fold((0, 0), lambda a, b: (a[0] + b[0], a[1] + b[1]))
    return Blocks(kept, feats, n, skipped)


def _packed(columns: np.ndarray) -> bytes:
    return CODEC.compress(columns.tobytes(), asbytes=True)


def _matrix(block: tuple, features: int) -> np.ndarray:
    """A kept block's rows of features, target and weight."""
    n, width = block[0], features + 2
    return np.frombuffer(CODEC.decompress(block[2], n * width * 8) if n else b"").reshape(width, n).T


def block_rows(width: int) -> int:
    """Rows of a block of so many columns."""
    return max(1, min(BLOCK, BLOCK_BYTES // (8 * width)))


def _members(keys: pa.Array, seed: int, steps: Sequence[int], below: int) -> np.ndarray:
    """A row a step: whether each key is in its batch."""
    messages = Md5Messages(keys, "|")
    return np.stack([messages.leading(f"{seed}|{t}") % 10_000 < below for t in steps])


# ------------------------------------------------------------- gradients
def _sums(m: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """A row a weight vector: errors, errors times features, and losses."""
    x, y, w = m[:, :-2], m[:, -2:-1], m[:, -1:]
    z = x @ weights[:, 1:].T
    z += weights[:, 0]
    p = np.exp(np.clip(-z, -500.0, 500.0))  # in place from here: wide grids wait for memory
    p += 1.0
    np.reciprocal(p, out=p)
    p[z < -500.0] = 0.0
    e = p - y
    e *= w
    likely = np.subtract(y != 1.0, p, out=z)  # p for 1, 1 - p for others, but for the sign
    np.abs(likely, out=likely)
    likely += LOSS_EPSILON
    loss = -(w.T @ np.log(likely, out=likely))
    return np.column_stack([e.sum(0), e.T @ x, loss[0]])


def loss_sums(blocks: Blocks) -> Callable[[Sequence[Sequence[float]]], tuple[int, list[list[float]], list[float]]]:
    """A function of weight vectors (intercept first): the rows, and for each
    vector the sums of errors, of errors times features, and of losses."""
    kept, d = blocks.kept, len(blocks.features)

    def sums(vectors: Sequence[Sequence[float]]) -> tuple[int, list[list[float]], list[float]]:
        weights = np.asarray(vectors, float)
        total = kept.map(lambda block: _sums(_matrix(block, d), weights)).fold(np.zeros((len(weights), d + 2)), np.add)
        return blocks.rows, total[:, :-1].tolist(), total[:, -1].tolist()

    return sums


def batch_loss_sums(blocks: Blocks) -> Callable[[int, Sequence[Sequence[float]]], tuple[int, list[list[float]], list[float]]]:
    """``loss_sums`` over a step's batch, as a function of the step (from 1)
    and weight vectors; the rows are the batch's."""
    kept, d = blocks.kept, len(blocks.features)

    def sums(step: int, vectors: Sequence[Sequence[float]]) -> tuple[int, list[list[float]], list[float]]:
        weights = np.asarray(vectors, float)

        def run(block: tuple) -> tuple[int, np.ndarray]:
            m = _matrix(block, d)[np.unpackbits(block[3][step - 1], count=block[0]).view(bool)]
            return len(m), _sums(m, weights)

        n, total = kept.map(run).fold((0, np.zeros((len(weights), d + 2))), lambda a, b: (a[0] + b[0], a[1] + b[1]))
        return n, total[:, :-1].tolist(), total[:, -1].tolist()

    return sums


# --------------------------------------------------------------- moments
@dataclass
class Moments:
    """Count, mean, co-moments ``sum (x - mean)(x - mean)^T``, and ranges."""

    n: int
    mean: np.ndarray
    co: np.ndarray
    low: np.ndarray
    high: np.ndarray

    @classmethod
    def of(cls, m: np.ndarray) -> Moments:
        mean = m.mean(0)
        c = m - mean
        return cls(len(m), mean, c.T @ c, m.min(0), m.max(0))

    def merge(self, other: Moments) -> Moments:
        if not self.n or not other.n:
            return other if not self.n else self
        n = self.n + other.n
        apart = other.mean - self.mean
        return Moments(
            n, self.mean + apart * (other.n / n), self.co + other.co + np.outer(apart, apart) * (self.n * other.n / n),
            np.minimum(self.low, other.low), np.maximum(self.high, other.high),
        )


def moments(blocks: Blocks) -> Moments | None:
    """Moments of the features and, last, the target; None for no rows."""
    d = len(blocks.features)

    def first(parts: Iterator[tuple]) -> Iterator[Moments]:
        return merged(Moments.of(_matrix(block, d)[:, :-1]) for block in parts if block[0])

    def merged(parts: Iterator[Moments]) -> Iterator[Moments]:
        total = None
        for part in parts:
            total = part if total is None else total.merge(part)
        if total is not None:
            yield total

    parts = blocks.kept.mapPartitions(first)
    left = parts.getNumPartitions()
    while left > 1:
        left = -(-left // FAN_IN)
        parts = parts.repartition(left).mapPartitions(merged)
    return next(iter(parts.collect()), None)


def summary_frame(spark: SparkSession, blocks: Blocks, m: Moments | None) -> DataFrame:
    """``(feature, count, mean, stddev, min, max, label_correlation)``, a row a
    feature: population deviation; the correlation is 0 where either side does
    not vary.  No rows without data."""
    rows = []
    for i, f in enumerate(blocks.features if m is not None else []):
        spread = m.co[i, i] * m.co[-1, -1]
        rows.append((f, m.n, float(m.mean[i]), float((m.co[i, i] / m.n) ** 0.5), float(m.low[i]), float(m.high[i]),
                     float(m.co[i, -1] / spread**0.5) if spread > 0 else 0.0))
    return spark.createDataFrame(rows, "feature string, count bigint, mean double, stddev double, min double, max double, label_correlation double")
