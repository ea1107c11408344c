"""Regression trees over quantile bins, many grown together.

Every feature is cut at exact ranks into at most ``bins`` intervals, once; a row
is then a few small integers, its target in whole units, and its fold.  All
trees of a cross-validation (or one deep tree) grow level by level, **one pass
over the stored rows a level for all trees**:

* a task walks its rows from the root through the splits decided so far (numpy,
  one step a level), so rows are stored once and never rewritten, no plan grows
  with the loop, and a lost executor's part is read again;
* rows in open nodes are counted by (tree, node, feature, bin): dense sums a
  task while the cells are few, sums a batch of the cells met beyond, so memory
  does not grow with the number of open nodes.  Spark adds them up with map-side
  combine, and windows over that table choose one split a node;
* only decided splits reach the driver: the model itself.

A tree that leaves out fold f trains on the other folds; ``max_depth`` values
share one tree, since a shallower one is its top.  So 3 folds x 3 depths x 3
least node sizes are 9 trees grown in ten passes instead of 27 fits.

Split rule: the greatest variance reduction ``nl nr / n (mean_l - mean_r)^2``,
which is exactly 0 for equal means; ties go to the lower feature, then the lower
cut; both sides need ``min_instances`` rows.  Targets are whole multiples of
``unit`` (``floor(y / unit + 1/2)``), so all sums are exact, whatever the
partitions, and a retried task changes nothing.

NULL and NaN features count as greater than every cut.  Rows whose target is
NULL or NaN are in no tree; ``Prepared.skipped`` says how many there were.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quarry.operators.tree import Node, Tree
from quarry.plans.prefix import running_totals
from quarry.plans.store import Workspace

BINS = 32  # fixed value: the reference's number of bins

#: Cells (tree, node, feature, bin) that a task adds up densely.
DENSE_CELLS = 1 << 21


# ------------------------------------------------------------------ bins
def quantile_cuts(df: DataFrame, features: Sequence[str], bins: int = BINS) -> dict[str, list[float]]:
    """At most ``bins - 1`` cuts a feature: the values whose cumulative count
    first reaches k/bins of the rows, k = 1 .. bins - 1, without the greatest.
    NULL and NaN are left out.  Exact ranks by the distributed running totals
    over distinct values; only the cuts reach the driver."""
    cols = list(features)
    values = df.select(
        F.inline(F.array(*[F.struct(F.lit(i).alias("f"), F.col(c).cast("double").alias("value")) for i, c in enumerate(cols)]))
    ).filter(F.col("value").isNotNull() & ~F.isnan("value"))
    counts = values.groupBy("f", "value").agg(F.count(F.lit(1)).alias("c"))
    ranked = running_totals(counts, [F.asc("value")], {"c": F.col("c")}, group=["f"], max_groups=len(cols))
    totals = {r["f"]: int(r["n"]) for r in ranked.groupBy("f").agg(F.sum("c").alias("n")).collect()}
    n = F.lit(None).cast("bigint")
    for f, total in totals.items():
        n = F.when(F.col("f") == f, F.lit(total)).otherwise(n)
    ranked = ranked.withColumn("n", n)
    hit = ranked.filter(F.expr(f"least(cum_c * {bins} div n, {bins - 1}) > least((cum_c - c) * {bins} div n, {bins - 1}) AND cum_c < n"))
    cuts: dict[str, list[float]] = {c: [] for c in cols}
    for r in hit.select("f", "value").collect():  # at most bins - 1 a feature
        cuts[cols[r["f"]]].append(float(r["value"]))
    return {c: sorted(v) for c, v in cuts.items()}


@dataclass
class Prepared:
    """Rows as bins: ``rows(key?, y long, fold int, b0.. tinyint)``."""

    rows: DataFrame
    features: list[str]
    cuts: list[list[float]]
    unit: float
    skipped: int

    @property
    def bins(self) -> int:
        return max((len(c) for c in self.cuts), default=0) + 1


def prepare(
    df: DataFrame,
    features: Sequence[str],
    label: str,
    work: Workspace,
    fold: Column | None = None,
    keep: Sequence[str] = (),
    bins: int = BINS,
    unit: float = 0.01,
    cuts: Mapping[str, Sequence[float]] | None = None,
    name: str = "binned",
) -> Prepared:
    """Bin ``df`` once and store it in ``work``.  ``cuts`` of another table
    (the training rows) can be given; without a ``fold`` all rows are fold 0."""
    features = list(features)
    cuts = {c: list(v) for c, v in (quantile_cuts(df, features, bins) if cuts is None else cuts).items()}
    y = F.col(label).cast("double")
    fold = F.lit(0) if fold is None else fold
    base = df.select(
        *keep, F.floor(y / F.lit(unit) + F.lit(0.5)).cast("long").alias("y"), fold.cast("int").alias("fold"),
        (y.isNull() | F.isnan(y)).alias("_bad"),
        *[F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(features)],
    )
    arrays = [np.array(cuts[c], float) for c in features]
    names = [*keep, "y", "fold", "_bad"]
    fields = [f for f in base.schema.fields if f.name in names]
    ddl = ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in fields], *[f"b{i} tinyint" for i in range(len(features))]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cols = []
            for i, cut in enumerate(arrays):
                x = batch.column(f"x{i}").fill_null(np.nan).to_numpy(zero_copy_only=False)
                cols.append(pa.array(np.searchsorted(cut, x, side="left").astype(np.int8)))  # NaN sorts last
            yield pa.RecordBatch.from_arrays([*[batch.column(n) for n in names], *cols], names=[*names, *[f"b{i}" for i in range(len(arrays))]])

    stored = work.store(base.mapInArrow(run, ddl), name)
    skipped = stored.filter("_bad").count()
    return Prepared(stored.filter("not _bad").drop("_bad"), features, [cuts[c] for c in features], unit, skipped)


# ------------------------------------------------------------------ trees
@dataclass
class Spec:
    """One tree: the fold left out of its training (None: trained on all)."""

    max_depth: int = 5
    min_instances: int = 1
    hold: int | None = None


@dataclass
class Grown:
    """Arrays over nodes in order of creation; ``left`` is -1 for a leaf, else
    the left child (the right child follows it)."""

    spec: Spec
    left: list[int] = field(default_factory=lambda: [-1])
    feature: list[int] = field(default_factory=lambda: [0])
    cut: list[int] = field(default_factory=lambda: [0])
    depth: list[int] = field(default_factory=lambda: [0])
    path: list[int] = field(default_factory=lambda: [1])
    n: list[int] = field(default_factory=lambda: [0])
    s: list[int] = field(default_factory=lambda: [0])
    gain: list[float] = field(default_factory=lambda: [0.0])

    def split(self, node: int, feature: int, cut: int, gain: float, n: int, s: int, ln: int, ls: int) -> list[int]:
        self.n[node], self.s[node] = n, s
        self.left[node], self.feature[node], self.cut[node], self.gain[node] = len(self.left), feature, cut, gain
        out = []
        for side, (cn, cs) in enumerate([(ln, ls), (n - ln, s - ls)]):
            out.append(len(self.left))
            self.left.append(-1)
            self.feature.append(0)
            self.cut.append(0)
            self.gain.append(0.0)
            self.depth.append(self.depth[node] + 1)
            self.path.append(2 * self.path[node] + side)
            self.n.append(cn)
            self.s.append(cs)
        return out

    def arrays(self) -> Walker:
        mean = np.array(self.s, float) / np.maximum(np.array(self.n, float), 1.0)
        return Walker(np.array(self.left, np.int32), np.array(self.feature, np.int16), np.array(self.cut, np.int16), mean)


@dataclass
class Walker:
    """A tree as arrays, small enough to travel to the tasks."""

    left: np.ndarray
    feature: np.ndarray
    cut: np.ndarray
    mean: np.ndarray

    def walk(self, bins: np.ndarray, steps: int, node: np.ndarray | None = None) -> np.ndarray:
        """Nodes of rows (``bins`` is features x rows) after so many steps."""
        at = np.arange(bins.shape[1])
        node = np.zeros(len(at), np.int32) if node is None else node
        for _ in range(steps):
            left = self.left[node]
            if not (left >= 0).any():
                break
            down = left + (bins[self.feature[node], at] > self.cut[node])
            node = np.where(left >= 0, down, node)
        return node


def matrix(batch: pa.RecordBatch, n_features: int) -> np.ndarray:
    return np.stack([batch.column(f"b{i}").to_numpy() for i in range(n_features)]) if n_features else np.zeros((0, batch.num_rows), np.int8)


def grow(data: Prepared, specs: Sequence[Spec]) -> list[Grown]:
    """Grow one tree a spec, all together; at most ``max_depth + 1`` passes."""
    trees = [Grown(s) for s in specs]
    open_nodes = [(t, 0) for t in range(len(trees))]  # tree by tree, at every level
    depth = 0
    while open_nodes:
        best = {(r.tree, r.node): r for r in level_splits(data, trees, open_nodes, depth).itertuples(index=False)}
        following = []
        for t, node in open_nodes:
            r, tree = best.get((t, node)), trees[t]
            if r is None:
                continue
            tree.n[node], tree.s[node] = int(r.n), int(r.s)
            if not r.gain > 0 or depth >= tree.spec.max_depth:
                continue
            children = tree.split(node, int(r.f), int(r.b), float(r.gain), int(r.n), int(r.s), int(r.ln), int(r.ls))
            if depth + 1 < tree.spec.max_depth:
                following += [(t, c) for c in children if tree.n[c] >= 2 * max(tree.spec.min_instances, 1)]
        open_nodes, depth = following, depth + 1
    return trees


def level_splits(data: Prepared, trees: Sequence[Grown], open_nodes: Sequence[tuple[int, int]], depth: int) -> pd.DataFrame:
    """Per open (tree, node): ``n, s`` and its best split ``f, b, gain, ln, ls``
    (gain 0 without one); the only pass over the rows of a level."""
    parts = data.rows.select("y", "fold", *[f"b{i}" for i in range(len(data.features))]).mapInArrow(
        partial_sums(len(data.features), data.bins, [(t.spec.hold, t.arrays()) for t in trees], open_nodes, depth),
        "tree int, node int, f int, b int, n long, s long",
    )
    cells = parts.groupBy("tree", "node", "f", "b").agg(F.sum("n").alias("n"), F.sum("s").alias("s"))
    upto = Window.partitionBy("tree", "node", "f").orderBy("b").rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy("tree", "node", "f")
    sums = cells.select(
        "tree", "node", "f", "b", F.sum("n").over(upto).alias("ln"), F.sum("s").over(upto).alias("ls"),
        F.sum("n").over(whole).alias("n"), F.sum("s").over(whole).alias("s"),
    )
    least = F.lit(1)
    for i, t in enumerate(trees):
        least = F.when(F.col("tree") == i, F.lit(max(t.spec.min_instances, 1))).otherwise(least)
    ln, n = F.col("ln").cast("double"), F.col("n").cast("double")
    rn = n - ln
    apart = F.col("ls").cast("double") / ln - (F.col("s") - F.col("ls")).cast("double") / rn
    sides = (F.col("ln") >= least) & (F.col("n") - F.col("ln") >= least) & (F.col("f") >= 0)
    scored = sums.withColumn("gain", F.when(sides, (ln * rn / n) * (apart * apart)))
    found = F.struct((-F.col("gain")).alias("loss"), "f", "b", "ln", "ls")
    best = scored.groupBy("tree", "node").agg(
        F.max("n").alias("n"), F.max("s").alias("s"),
        F.min_by(found, F.when(F.col("gain") > 0, found)).alias("best"),
    )
    chosen = [F.coalesce(F.col(f"best.{c}"), F.lit(0)).alias(c) for c in ("f", "b", "ln", "ls")]
    return best.select("tree", "node", "n", "s", F.coalesce(-F.col("best.loss"), F.lit(0.0)).alias("gain"), *chosen).toPandas()


def partial_sums(n_features: int, bins: int, walkers: Sequence[tuple[int | None, Walker]], open_nodes: Sequence[tuple[int, int]], depth: int):
    """The task of a level: rows of training folds in open nodes, summed by
    (tree, node, feature, bin).  A tree without features counts under f = -1."""
    slots = [np.full(len(w.left), -1, np.int64) for _, w in walkers]
    for k, (t, node) in enumerate(open_nodes):
        slots[t][node] = k
    busy = sorted({t for t, _ in open_nodes})
    tree_of = np.array([t for t, _ in open_nodes], np.int32)
    node_of = np.array([n for _, n in open_nodes], np.int32)
    width = max(n_features, 1)
    size = len(open_nodes) * width * bins
    # open nodes come tree by tree, so a tree's cells are one stretch
    spans = {}
    for t in busy:
        own = np.flatnonzero(tree_of == t)
        spans[t] = (int(own[0]) * width * bins, (int(own[-1]) - int(own[0]) + 1) * width * bins)

    def out(keys: np.ndarray, n: np.ndarray, s: np.ndarray) -> pa.RecordBatch:
        slot, rest = np.divmod(keys, width * bins)
        f, b = np.divmod(rest, bins)
        f = f if n_features else np.full(len(f), -1)
        cols = [tree_of[slot], node_of[slot], f.astype(np.int32), b.astype(np.int32), n.astype(np.int64), s.astype(np.int64)]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in cols], names=["tree", "node", "f", "b", "n", "s"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dense = size <= DENSE_CELLS
        n, s = (np.zeros(size, np.int64), np.zeros(size, np.int64)) if dense else (None, None)
        for batch in batches:
            y = batch.column("y").to_numpy()
            fold = batch.column("fold").to_numpy()
            x = matrix(batch, n_features)
            for t in busy:
                hold, walker = walkers[t]
                slot = slots[t][walker.walk(x, depth)]
                rows = np.flatnonzero((slot >= 0) & (fold != hold) if hold is not None else slot >= 0)
                if not len(rows):
                    continue
                key = slot[rows] * (width * bins)
                keys = np.concatenate([key + f * bins + x[f, rows] for f in range(n_features)]) if n_features else key
                high, low = y[rows] >> 26, y[rows] & ((1 << 26) - 1)  # exact in doubles
                # the cells of a tree lie together: add up all of them, or those met
                first, count = spans[t]
                few = count > 4 * len(keys)
                cells, at = np.unique(keys, return_inverse=True) if few else (None, keys - first)
                count = len(cells) if few else count
                sums = [np.bincount(at, np.tile(v, width), minlength=count).astype(np.int64) for v in (high, low)]
                numbers = np.bincount(at, minlength=count)
                total = (sums[0] << 26) + sums[1]
                if dense:
                    where = cells if few else slice(first, first + count)
                    n[where] += numbers
                    s[where] += total
                else:
                    some = np.flatnonzero(numbers)
                    yield out(cells if few else first + some, numbers[some], total[some])
        if dense:
            keys = np.flatnonzero(n)
            if len(keys):
                yield out(keys, n[keys], s[keys])

    return run


# ------------------------------------------------------------------ results
def to_tree(data: Prepared, grown: Grown, max_depth: int | None = None) -> Tree:
    """The tree as a ``Tree`` (node table, text, scoring), cut at ``max_depth``."""
    tree = Tree(list(data.features))
    for i, path in enumerate(grown.path):
        if max_depth is not None and grown.depth[i] > max_depth:
            continue
        inner = grown.left[i] >= 0 and (max_depth is None or grown.depth[i] < max_depth)
        f = grown.feature[i]
        mean = grown.s[i] / grown.n[i] * data.unit if grown.n[i] else 0.0
        tree.nodes[path] = Node(
            path, grown.depth[i], grown.n[i], mean, float("nan"), f if inner else None, data.cuts[f][grown.cut[i]] if inner else None
        )
    return tree


def leaves(spark: SparkSession, data: Prepared, grown: Grown) -> DataFrame:
    """``(node_id, depth, count, mean)`` of the leaves, node_id as a heap path."""
    rows = [
        (grown.path[i], grown.depth[i], grown.n[i], grown.s[i] / grown.n[i] * data.unit if grown.n[i] else None)
        for i, left in enumerate(grown.left)
        if left < 0
    ]
    return spark.createDataFrame(rows, "node_id bigint, depth bigint, count bigint, mean double")


def predict(data: Prepared, grown: Grown, rows: DataFrame | None = None, keep: Sequence[str] = ()) -> DataFrame:
    """``(keep.., y, prediction)`` of binned rows, in the target's scale."""
    rows = data.rows if rows is None else rows
    walker, depth, unit, nf = grown.arrays(), max(grown.depth), data.unit, len(data.features)
    names = [*keep, "y"]
    fields = [f for f in rows.schema.fields if f.name in names]
    names = [f.name for f in fields]
    ddl = ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in fields], "prediction double"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            mean = walker.mean[walker.walk(matrix(batch, nf), depth)] * unit
            yield pa.RecordBatch.from_arrays([*[batch.column(n) for n in names], pa.array(mean)], names=[*names, "prediction"])

    out = rows.select(*names, *[f"b{i}" for i in range(nf)]).mapInArrow(run, ddl)
    return out.withColumn("y", F.col("y") * F.lit(unit))


def held_out_errors(data: Prepared, trees: Sequence[Grown], depths: Sequence[int]) -> DataFrame:
    """``(tree, depth, n, sse)``: squared error of every tree, cut at each
    depth, on the fold it left out; one pass for all."""
    walkers = [(t.spec.hold, t.arrays()) for t in trees]
    depths = sorted(depths)
    nf, unit = len(data.features), data.unit

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[tuple[int, int], list] = {}
        for batch in batches:
            x, y, fold = matrix(batch, nf), batch.column("y").to_numpy(), batch.column("fold").to_numpy()
            for t, (hold, walker) in enumerate(walkers):
                rows = np.flatnonzero(fold == hold)
                at, node, done = x[:, rows], None, 0
                for d in depths:
                    node, done = walker.walk(at, d - done, node), d
                    error = (y[rows] - walker.mean[node]) * unit
                    sums = total.setdefault((t, d), [0, 0.0])
                    sums[0] += len(rows)
                    sums[1] += float(error @ error)
        keys = sorted(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array([k[0] for k in keys], pa.int32()), pa.array([k[1] for k in keys], pa.int32()),
             pa.array([total[k][0] for k in keys], pa.int64()), pa.array([total[k][1] for k in keys], pa.float64())],
            names=["tree", "depth", "n", "sse"],
        )

    parts = data.rows.mapInArrow(run, "tree int, depth int, n long, sse double")
    return parts.groupBy("tree", "depth").agg(F.sum("n").alias("n"), F.sum("sse").alias("sse"))


def cross_validate(
    data: Prepared, folds: int, max_depths: Sequence[int], min_instances: Sequence[int]
) -> tuple[DataFrame, list[Grown]]:
    """``(max_depth, min_instances_per_node, avg_rmse, is_best)``: the mean over
    folds of the RMSE on the fold left out.  The first least one is best, in
    the order of the parameters."""
    spark = data.rows.sparkSession
    specs = [Spec(max(max_depths), m, f) for m in min_instances for f in range(folds)]
    trees = grow(data, specs)
    sums = {(r["tree"], r["depth"]): r for r in held_out_errors(data, trees, max_depths).collect()}  # a row a tree and depth
    table = []
    for d in max_depths:
        for j, m in enumerate(min_instances):
            got = [sums.get((j * folds + f, d)) for f in range(folds)]
            rmse = [(r["sse"] / r["n"]) ** 0.5 for r in got if r is not None and r["n"]]
            table.append((int(d), int(m), sum(rmse) / len(rmse) if rmse else None))
    best = min((i for i, r in enumerate(table) if r[2] is not None), key=lambda i: (table[i][2], i), default=None)
    rows = [(*r, i == best) for i, r in enumerate(table)]
    return spark.createDataFrame(rows, "max_depth int, min_instances_per_node int, avg_rmse double, is_best boolean"), trees


def importances(grown: Grown, features: Sequence[str]) -> dict[str, float]:
    """Share of the variance reduction a feature, summing to 1."""
    total = np.bincount(np.array(grown.feature), np.array(grown.gain), minlength=len(features))
    whole = total.sum()
    return {f: float(v / whole) if whole > 0 else 0.0 for f, v in zip(features, total, strict=True)}
