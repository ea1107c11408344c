"""Regression tree whose candidate thresholds are drawn anew for every node (I8).

Each node and feature has its own ``k`` thresholds, ``lo + u (hi - lo)`` with
``u`` from the MD5 of ``seed|node|feature|j`` and lo, hi the feature's range
over all training rows.  Any engine can draw them again, and neither partitions
nor retries change them.

A level is one pass over the stored rows: a task walks its rows to their nodes,
bins each feature by the thresholds of that node and adds up counts and target
sums by (node, feature, bin); nodes are heap ids (children 2i and 2i + 1).  The
gates are those of ``tree``: nodes below ``min_node`` rows stay whole, both
sides need ``min_side`` rows, and the weighted variance of the sides must fall
below ``gain_factor`` times the node's.  Ties go to the lower feature, then the
smaller threshold.  Targets are whole multiples of ``unit``, so sums are exact.

Rows with a NULL or NaN target are in no node; NULL and NaN features go right.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.operators.tree import GAIN_FACTOR, MAX_DEPTH, MIN_NODE, MIN_SIDE, N_THRESHOLDS, Node, Tree
from quarry.plans.store import Workspace


@dataclass
class Seeded:
    """Stored rows ``(y long, x0.. double)`` and what draws their thresholds."""

    rows: DataFrame
    features: list[str]
    ranges: list[tuple[float, float] | None]
    seed: int
    k: int
    unit: float

    def thresholds(self, node: int, feature: int) -> list[float]:
        if self.ranges[feature] is None:
            return []
        lo, hi = self.ranges[feature]
        return sorted(lo + draw(self.seed, node, feature, j) * (hi - lo) for j in range(self.k))


def draw(seed: int, node: int, feature: int, j: int) -> float:
    """A fixed number in [0, 1): the first 32 bits of an MD5."""
    return int(hashlib.md5(f"{seed}|{node}|{feature}|{j}".encode()).hexdigest()[:8], 16) / 4294967296.0


def prepare(
    df: DataFrame, features: Sequence[str], label: str, work: Workspace, seed: int = 42, k: int = N_THRESHOLDS, unit: float = 0.01
) -> Seeded:
    y = F.col(label).cast("double")
    xs = [F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(features)]
    rows = work.store(
        df.filter(y.isNotNull() & ~F.isnan(y)).select(F.floor(y / F.lit(unit) + F.lit(0.5)).cast("long").alias("y"), *xs), "rows"
    )
    known = [F.when(~F.isnan(f"x{i}"), F.col(f"x{i}")) for i in range(len(xs))]
    row = rows.agg(*[F.min(c).alias(f"lo{i}") for i, c in enumerate(known)], *[F.max(c).alias(f"hi{i}") for i, c in enumerate(known)]).first()
    ranges = [(row[f"lo{i}"], row[f"hi{i}"]) for i in range(len(xs))]
    return Seeded(rows, list(features), [r if r[0] is not None and r[0] < r[1] else None for r in ranges], seed, k, unit)


def cells(data: Seeded, tree: Tree, nodes: Sequence[int]) -> DataFrame:
    """``(node, f, b, n, s)``: counts and target sums of the open ``nodes``.
    Slots f = -1 hold the node's squares, split into high (b = 0) and low bits."""
    nodes = list(nodes)
    nf, k, depth = len(data.features), data.k, tree.depth()
    slot_of = {node: i for i, node in enumerate(nodes)}
    cuts = np.full((len(nodes), nf, k), np.inf)
    for i, node in enumerate(nodes):
        for f in range(nf):
            drawn = data.thresholds(node, f)
            cuts[i, f, : len(drawn)] = drawn
    inner = {i: (n.feature, n.threshold) for i, n in tree.nodes.items() if not n.is_leaf}

    # heap ids of the open nodes and their ancestors as small arrays
    ids = sorted({1, *slot_of, *inner, *(2 * i for i in inner), *(2 * i + 1 for i in inner)})
    at = {node: i for i, node in enumerate(ids)}
    feature = np.array([inner[i][0] if i in inner else -1 for i in ids])
    threshold = np.array([inner[i][1] if i in inner else 0.0 for i in ids])
    left = np.array([at[2 * i] if i in inner else -1 for i in ids])
    right = np.array([at[2 * i + 1] if i in inner else -1 for i in ids])
    slots = np.array([slot_of.get(i, -1) for i in ids])
    width = k + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = len(nodes) * nf * width
        n, s = np.zeros(size, np.int64), np.zeros(size, np.int64)
        squares = np.zeros((2, len(nodes)), np.int64)
        count = np.zeros(len(nodes), np.int64)
        for batch in batches:
            y = batch.column("y").to_numpy()
            x = np.stack([batch.column(f"x{i}").fill_null(np.nan).to_numpy(zero_copy_only=False) for i in range(nf)])
            node = np.zeros(len(y), np.int64)  # ids[0] is the root
            for _ in range(depth + 1):
                down = left[node] >= 0
                if not down.any():
                    break
                v = x[np.where(down, feature[node], 0), np.arange(len(y))]
                node = np.where(down, np.where(v <= threshold[node], left[node], right[node]), node)  # NaN goes right
            slot = slots[node]
            rows = np.flatnonzero(slot >= 0)
            slot, y, x = slot[rows], y[rows], x[:, rows]
            if not len(rows):
                continue
            square = y * y
            for part, v in enumerate((square >> 26, square & ((1 << 26) - 1))):
                squares[part] += np.bincount(slot, v, minlength=len(nodes)).astype(np.int64)
            count += np.bincount(slot, minlength=len(nodes))
            high, low = y >> 26, y & ((1 << 26) - 1)
            for f in range(nf):
                b = (~(x[f][:, None] <= cuts[slot, f])).sum(1)  # thresholds below x; NaN is above all
                key = (slot * nf + f) * width + b
                n += np.bincount(key, minlength=size)
                s += (np.bincount(key, high, minlength=size).astype(np.int64) << 26) + np.bincount(key, low, minlength=size).astype(np.int64)
        some = np.flatnonzero(n)
        slot, rest = np.divmod(some, nf * width)
        f, b = np.divmod(rest, width)
        met = np.flatnonzero(count)
        names = np.array(nodes, np.int64)
        columns = [
            np.concatenate([names[slot], names[met], names[met]]),
            np.concatenate([f, np.full(2 * len(met), -1)]).astype(np.int32),
            np.concatenate([b, np.zeros(len(met)), np.ones(len(met))]).astype(np.int32),
            np.concatenate([n[some], count[met], count[met]]),
            np.concatenate([s[some], squares[0][met], squares[1][met]]),
        ]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["node", "f", "b", "n", "s"])

    parts = data.rows.mapInArrow(run, "node long, f int, b int, n long, s long")
    return parts.groupBy("node", "f", "b").agg(F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(38,0)")).alias("s"))


def candidates(found: DataFrame) -> DataFrame:
    """``(node, f, b, n, s, variance, ln, ls, mse)`` of every bin border of
    every node: its left side and the weighted variance of both sides."""
    upto = Window.partitionBy("node", "f").orderBy("b").rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy("node", "f")
    sums = found.filter("f >= 0").select(
        "node", "f", "b", F.sum("n").over(upto).alias("ln"), F.sum("s").over(upto).alias("ls"),
        F.sum("n").over(whole).alias("n"), F.sum("s").over(whole).alias("s"),
    )
    wide = "decimal(38,0)"
    part = {b: F.max(F.when(F.col("b") == b, F.col("s"))).cast(wide) for b in (0, 1)}
    squares = found.filter("f < 0").groupBy("node").agg((part[0] * F.lit(1 << 26) + part[1]).cast(wide).alias("ss"))
    n, s, ln, ls = (F.col(c).cast("double") for c in ("n", "s", "ln", "ls"))
    rn, rs = n - ln, (F.col("s") - F.col("ls")).cast("double")
    mean = s / n
    variance = F.greatest(F.col("ss").cast("double") / n - mean * mean, F.lit(0.0))
    apart = ls / ln - rs / rn
    gain = F.when(rn > 0, ln * rn / n * (apart * apart)).otherwise(F.lit(0.0))
    joined = sums.join(squares, "node")  # a row a node
    return joined.select("node", "f", "b", "n", "s", variance.alias("variance"), "ln", "ls", (variance - gain / n).alias("mse"))


def fit(
    data: Seeded, max_depth: int = MAX_DEPTH, min_node: int = MIN_NODE, min_side: int = MIN_SIDE, gain_factor: float = GAIN_FACTOR
) -> Tree:
    tree = Tree(list(data.features))
    open_nodes, depth = [1], 0
    while open_nodes:
        sides = (F.col("ln") >= min_side) & (F.col("n") - F.col("ln") >= min_side)
        order = F.struct("mse", "f", "b", "ln", "ls")
        rows = candidates(cells(data, tree, open_nodes)).groupBy("node").agg(
            F.max("n").alias("n"), F.max("s").alias("s"), F.max("variance").alias("variance"), F.min_by(order, F.when(sides, order)).alias("best")
        )
        following = []
        for r in sorted(rows.collect(), key=lambda r: r["node"]):  # a row an open node
            node, n, best = r["node"], int(r["n"]), r["best"]
            tree.nodes[node] = Node(node, depth, n, float(r["s"]) / n * data.unit, float(r["variance"]) * data.unit * data.unit)
            if best is None or n < min_node or depth >= max_depth or not best["mse"] < gain_factor * r["variance"]:
                continue
            drawn = data.thresholds(node, best["f"])
            if best["b"] >= len(drawn):
                continue
            tree.nodes[node].feature, tree.nodes[node].threshold = best["f"], drawn[best["b"]]
            following += [2 * node, 2 * node + 1]
        open_nodes, depth = following, depth + 1
    return tree


def split_table(data: Seeded, tree: Tree, nodes: Sequence[int], min_side: int = MIN_SIDE) -> DataFrame:
    """``(node, feature_index, threshold, left_n, right_n, variance_share,
    valid)`` of every candidate of the given nodes, with the splits above them."""
    spark = data.rows.sparkSession
    above = Tree(tree.features, {i: n for i, n in tree.nodes.items() if any(i == m >> d for m in nodes for d in range(1, 64))})
    rows = candidates(cells(data, above, nodes)).collect()  # at most nodes x features x thresholds
    out = []
    for node in nodes:
        total = {r["f"]: r for r in rows if r["node"] == node}
        for f, any_row in sorted(total.items()):
            by_bin = {r["b"]: r for r in rows if r["node"] == node and r["f"] == f}
            left = None
            for b, threshold in enumerate(data.thresholds(node, f)):
                left = by_bin.get(b, left)  # an empty bin leaves the border's sides as they are
                ln = int(left["ln"]) if left is not None else 0
                n = int(any_row["n"])
                mse = left["mse"] if left is not None and ln < n else any_row["variance"]
                share = float(mse / any_row["variance"]) if any_row["variance"] > 0 else None
                out.append((int(node), int(f), float(threshold), ln, n - ln, share, ln >= min_side and n - ln >= min_side))
    return spark.createDataFrame(
        out, "node bigint, feature_index bigint, threshold double, left_n bigint, right_n bigint, variance_share double, valid boolean"
    )
