"""Reproducible splits.

``hash_split`` assigns each row to a part from a hash of its key, so the
assignment does not depend on partitioning, executor count or retries (a
re-run task recomputes the same parts), and the identical expression runs in
DuckDB: ``conv(substr(md5(seed|key), 1, 7), 16, 10) % 100``.
``random_split`` keeps Spark's ``randomSplit`` for parity runs.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def hash_bucket(key: Column, seed: int = 42, buckets: int = 100, method: str = "md5") -> Column:
    """Bucket ``0..buckets-1`` of a row key.

    ``md5`` (default) is reproducible outside Spark (DuckDB has the same
    function); ``xxhash64`` is Spark's native 64-bit hash and several times
    cheaper per row, for very large inputs where portability is not needed.
    """
    if method == "xxhash64":
        return F.pmod(F.xxhash64(F.lit(seed), key), F.lit(buckets))
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), key))
    return F.conv(F.substring(digest, 1, 7), 16, 10).cast("bigint") % buckets


def batch_member(key: Column, fraction: float, seed: int, step: int) -> Column:
    """Whether a row belongs to the mini-batch of a step: a hash of (seed,
    step, key) below the fraction, in steps of 1/10000."""
    return hash_bucket(F.concat_ws("|", F.lit(str(step)), key), seed, 10_000) < round(fraction * 10_000)


def _edges(fractions: Sequence[float], buckets: int) -> list[int]:
    total = float(sum(fractions))
    edges, acc = [], 0.0
    for f in fractions:
        acc += f / total
        edges.append(int(round(acc * buckets)))
    edges[-1] = buckets
    return edges


def split_index(
    key: Column, fractions: Sequence[float], seed: int = 42, buckets: int = 100, method: str = "md5"
) -> Column:
    """0-based part number of a row for the given fractions."""
    b = hash_bucket(key, seed, buckets, method)
    edges = _edges(fractions, buckets)
    expr = F.lit(len(edges) - 1)
    for i in range(len(edges) - 2, -1, -1):
        expr = F.when(b < edges[i], F.lit(i)).otherwise(expr)
    return expr


def hash_split(
    df: DataFrame, key: Column, fractions: Sequence[float] = (0.8, 0.2), seed: int = 42, method: str = "md5"
) -> list[DataFrame]:
    """Disjoint, complete parts of ``df`` in the given proportions."""
    b = hash_bucket(key, seed, 100, method)
    edges = _edges(fractions, 100)
    parts, lo = [], 0
    for hi in edges:
        parts.append(df.filter((b >= lo) & (b < hi)))
        lo = hi
    return parts


def random_split(df: DataFrame, fractions: Sequence[float] = (0.8, 0.2), seed: int | None = 42) -> list[DataFrame]:
    """Spark's ``randomSplit`` (depends on partitioning; kept for parity)."""
    return df.randomSplit(list(fractions), seed=seed)


def materialized_split(
    df: DataFrame, key: Column, fractions: Sequence[float] = (0.8, 0.2), seed: int = 42, with_stored: bool = False
):
    """Parts of ``df`` from one reliable checkpoint holding a part column.

    Upstream work (e.g. a de-duplication shuffle) runs once; every later
    read of any part — fitting statistics, iterations, scoring — filters the
    checkpoint on a small integer instead of recomputing lineage or hashes.
    """
    from quarry.session import materialize

    stored = materialize(df.withColumn("_part", split_index(key, fractions, seed)))
    parts = [stored.filter(F.col("_part") == i).drop("_part") for i in range(len(fractions))]
    return (parts, stored) if with_stored else parts
