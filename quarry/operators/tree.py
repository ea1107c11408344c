"""Regression tree grown level by level.

The reference grows the tree recursively on the driver, with one filtered
RDD per node and 12 jobs per (node, feature).  Here each level is **one**
aggregation over the materialised training frame:

1. every row gets its node id from the tree so far (a CASE expression
   compiled from the decided splits — no per-level column stacking);
2. each feature value is binned against that feature's sorted candidate
   thresholds (``bin = #thresholds < x``, so ``x <= t_j`` ⇔ ``bin < j``);
3. ``inline`` unpivots features, and ``groupBy(node, feature, bin)`` sums
   ``count, Σy, Σy²`` with a map-side partial aggregate;
4. running sums over the bins (a window over the small grouped table) give
   the left side of every candidate, the node total gives the right side;
5. the reference's gates — at least ``min_side`` rows per side, best
   weighted variance below ``gain_factor · node variance`` — and ``min_by``
   choose one split per node; only those rows reach the driver.

Targets are shifted by the training mean before squaring so ``Σy²`` does not
cancel.  Ties go to the lower feature index, then the smaller threshold (the
reference's first-wins order with sorted threshold lists).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quarry.session import materialize, release

# The reference's tree rules.
MIN_NODE = 2000
MIN_SIDE = 1000
GAIN_FACTOR = 0.95
N_THRESHOLDS = 10
MAX_DEPTH = 4


@dataclass
class Node:
    node_id: int
    depth: int
    count: int
    prediction: float
    impurity: float
    feature: int | None = None
    threshold: float | None = None

    @property
    def is_leaf(self) -> bool:
        return self.feature is None


@dataclass
class Tree:
    features: list[str]
    nodes: dict[int, Node] = field(default_factory=dict)

    # ------------------------------------------------------------ compile
    def _expr(self, node_id: int, leaf_value) -> Column:
        n = self.nodes[node_id]
        if n.is_leaf:
            return leaf_value(n)
        x = F.col(self.features[n.feature])
        return F.when(x <= F.lit(n.threshold), self._expr(2 * node_id, leaf_value)).otherwise(
            self._expr(2 * node_id + 1, leaf_value)
        )

    def predict_col(self) -> Column:
        """The tree as one nested CASE expression."""
        return self._expr(1, lambda n: F.lit(float(n.prediction)))

    def node_col(self) -> Column:
        """Id of the leaf each row falls in."""
        return self._expr(1, lambda n: F.lit(n.node_id))

    # Up to this many nodes the tree is one nested CASE (whole-stage
    # codegen); larger trees are walked with numpy per Arrow batch.
    CASE_NODE_LIMIT = 255

    def predict(self, df: DataFrame, output: str = "prediction", method: str = "auto") -> DataFrame:
        """Add ``output``; ``method`` is ``case``, ``arrow`` or ``auto``."""
        if method == "arrow" or (method == "auto" and len(self.nodes) > self.CASE_NODE_LIMIT):
            return self._predict_arrow(df, output)
        return df.withColumn(output, self.predict_col())

    def _predict_arrow(self, df: DataFrame, output: str) -> DataFrame:
        """Vectorised traversal: node arrays (feature, threshold, prediction,
        leaf flag) indexed by heap id travel to the tasks; every row of a
        batch descends one level per step, at most ``depth`` steps."""
        import numpy as np

        size = max(self.nodes) + 1
        feat = np.full(size, -1, dtype=np.int64)
        thr = np.zeros(size)
        pred = np.zeros(size)
        for nid, n in self.nodes.items():
            pred[nid] = n.prediction
            if not n.is_leaf:
                feat[nid], thr[nid] = n.feature, n.threshold
        cols = list(self.features)
        depth = self.depth()
        from pyspark.sql.types import DoubleType, StructField, StructType

        schema = StructType([f for f in df.schema.fields if f.name != output] + [StructField(output, DoubleType())])

        def walk(batches):
            for pdf in batches:
                x = pdf[cols].to_numpy(dtype=float)
                node = np.ones(len(pdf), dtype=np.int64)
                for _ in range(depth):
                    f = feat[node]
                    inner = f >= 0
                    if not inner.any():
                        break
                    v = x[np.arange(len(pdf)), np.where(inner, f, 0)]
                    # x <= t goes left (2i); NaN compares False and goes right
                    child = 2 * node + np.where(v <= thr[node], 0, 1)
                    node = np.where(inner, child, node)
                yield pdf.drop(columns=[output], errors="ignore").assign(**{output: pred[node]})

        return df.mapInPandas(walk, schema)

    # ------------------------------------------------------------ tables
    def node_rows(self) -> list[tuple]:
        rows = []
        for nid in sorted(self.nodes):
            n = self.nodes[nid]
            rows.append(
                (
                    nid,
                    nid // 2 if nid > 1 else None,
                    n.depth,
                    n.is_leaf,
                    None if n.is_leaf else self.features[n.feature],
                    None if n.is_leaf else float(n.threshold),
                    float(n.prediction),
                    int(n.count),
                    float(n.impurity),
                )
            )
        return rows

    NODE_SCHEMA = (
        "node_id bigint, parent_id bigint, depth int, is_leaf boolean, feature string, "
        "threshold double, prediction double, count bigint, impurity double"
    )

    def node_table(self, spark: SparkSession) -> DataFrame:
        """``(node_id, parent_id, depth, is_leaf, feature, threshold,
        prediction, count, impurity)`` — the model as data (I20, A13)."""
        return spark.createDataFrame(self.node_rows(), self.NODE_SCHEMA)

    def save(self, spark: SparkSession, path: str) -> None:
        self.node_table(spark).coalesce(1).write.mode("overwrite").parquet(path)

    @classmethod
    def from_table(cls, table: DataFrame, features: Sequence[str]) -> Tree:
        """Rebuild from a node table (the table is one row per node)."""
        t = cls(list(features))
        for r in table.collect():
            f = None if r["is_leaf"] else list(features).index(r["feature"])
            t.nodes[int(r["node_id"])] = Node(
                int(r["node_id"]), int(r["depth"]), int(r["count"]), float(r["prediction"]),
                float(r["impurity"]), f, None if r["is_leaf"] else float(r["threshold"]),
            )
        return t

    def debug_string(self, digits: int | None = None) -> str:
        """Indented if/else text like Spark's ``toDebugString``; ``digits``
        rounds thresholds and predictions."""

        def shown(v: float) -> float:
            return v if digits is None else round(v, digits)

        lines = [f"Regression tree of depth {self.depth()} with {len(self.nodes)} nodes"]

        def walk(nid: int, indent: int) -> None:
            n = self.nodes[nid]
            pad = " " * indent
            if n.is_leaf:
                lines.append(f"{pad}Predict: {shown(n.prediction)}")
                return
            name = self.features[n.feature]
            lines.append(f"{pad}If ({name} <= {shown(n.threshold)})")
            walk(2 * nid, indent + 1)
            lines.append(f"{pad}Else ({name} > {shown(n.threshold)})")
            walk(2 * nid + 1, indent + 1)

        walk(1, 1)
        return "\n".join(lines)

    def depth(self) -> int:
        return max((n.depth for n in self.nodes.values()), default=0)


# --------------------------------------------------------------- thresholds
def equal_width_thresholds(lo: float, hi: float, k: int = N_THRESHOLDS) -> list[float]:
    """``k`` interior, equally spaced cut points; none when ``lo >= hi``."""
    if lo is None or hi is None or lo >= hi:
        return []
    return [lo + j * (hi - lo) / (k + 1) for j in range(1, k + 1)]


def feature_thresholds(df: DataFrame, features: Sequence[str], k: int = N_THRESHOLDS) -> dict[str, list[float]]:
    """Candidate thresholds per feature from one min/max aggregate."""
    row = df.agg(
        *[F.min(F.col(c).cast("double")).alias(f"lo_{c}") for c in features],
        *[F.max(F.col(c).cast("double")).alias(f"hi_{c}") for c in features],
    ).first()
    return {c: equal_width_thresholds(row[f"lo_{c}"], row[f"hi_{c}"], k) for c in features}


def bin_col(x: Column, thresholds: Sequence[float]) -> Column:
    """Number of (sorted) thresholds strictly below ``x``."""
    b = F.lit(0)
    for t in thresholds:
        b = b + F.when(x > F.lit(float(t)), F.lit(1)).otherwise(F.lit(0))
    return b


# --------------------------------------------------------------- split tables
def grouped_bins(
    df: DataFrame,
    node: Column,
    features: Sequence[str],
    thresholds: Mapping[str, Sequence[float]],
    y: Column,
) -> DataFrame:
    """``(node, f, b, cnt, sy, syy)`` — one pass over the rows.

    Slot ``f = -1`` carries each node's totals, so node statistics and split
    candidates come out of the same aggregation.
    """
    sorted_t = {c: sorted(thresholds.get(c, [])) for c in features}
    structs = [F.struct(F.lit(-1).alias("f"), F.lit(0).alias("b"))] + [
        F.struct(F.lit(i).alias("f"), bin_col(F.col(c), sorted_t[c]).alias("b"))
        for i, c in enumerate(features)
        if sorted_t[c]
    ]
    rows = df.select(node.alias("node"), y.alias("y"), F.inline(F.array(*structs)))
    return rows.groupBy("node", "f", "b").agg(
        F.count(F.lit(1)).alias("cnt"), F.sum("y").alias("sy"), F.sum(F.col("y") * F.col("y")).alias("syy")
    )


def candidates_from_bins(
    g: DataFrame, features: Sequence[str], thresholds: Mapping[str, Sequence[float]]
) -> DataFrame | None:
    """Every candidate split from the binned sums (window over the small
    grouped table): ``(node, feature_index, threshold, n, left_*, right_*,
    total_*)``; bin ``b`` is the left side of the ``b``-th sorted threshold."""
    sorted_t = {c: sorted(thresholds.get(c, [])) for c in features}
    if not any(sorted_t.values()):
        return None
    g = g.filter(F.col("f") >= 0)
    upto = Window.partitionBy("node", "f").orderBy("b").rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy("node", "f")
    g = g.select(
        "node",
        "f",
        "b",
        F.sum("cnt").over(upto).alias("left_n"),
        F.sum("sy").over(upto).alias("left_sum"),
        F.sum("syy").over(upto).alias("left_sumsq"),
        F.sum("cnt").over(whole).alias("n"),
        F.sum("sy").over(whole).alias("total_sum"),
        F.sum("syy").over(whole).alias("total_sumsq"),
    )
    t_expr = None
    k_expr = None
    for i, c in enumerate(features):
        ts = sorted_t[c]
        if not ts:
            continue
        arr = F.array(*[F.lit(float(t)) for t in ts])
        t_expr = F.when(F.col("f") == i, arr) if t_expr is None else t_expr.when(F.col("f") == i, arr)
        k_expr = F.when(F.col("f") == i, F.lit(len(ts))) if k_expr is None else k_expr.when(
            F.col("f") == i, F.lit(len(ts))
        )
    g = g.filter(F.col("b") < k_expr)
    return g.select(
        "node",
        F.col("f").alias("feature_index"),
        F.element_at(t_expr, F.col("b") + 1).alias("threshold"),
        "n",
        "left_n",
        "left_sum",
        "left_sumsq",
        (F.col("n") - F.col("left_n")).alias("right_n"),
        (F.col("total_sum") - F.col("left_sum")).alias("right_sum"),
        (F.col("total_sumsq") - F.col("left_sumsq")).alias("right_sumsq"),
        "total_sum",
        "total_sumsq",
    )


def level_summary(
    g: DataFrame, features: Sequence[str], thresholds: Mapping[str, Sequence[float]], min_side: int, min_node: int
) -> DataFrame:
    """One row per node from the binned sums: ``n, s, ss`` (slot −1) and the
    best valid split (``min_by`` over candidates whose ordering is NULL when
    invalid, so they are skipped).  No filter sits between the row pass and
    this aggregate, so one job makes one pass over the rows."""
    sorted_t = {c: sorted(thresholds.get(c, [])) for c in features}
    upto = Window.partitionBy("node", "f").orderBy("b").rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy("node", "f")
    w = g.select(
        "node", "f", "b", "cnt", "sy", "syy",
        F.sum("cnt").over(upto).alias("ln"), F.sum("sy").over(upto).alias("ls"), F.sum("syy").over(upto).alias("lss"),
        F.sum("cnt").over(whole).alias("n"), F.sum("sy").over(whole).alias("ts"), F.sum("syy").over(whole).alias("tss"),
    )
    t_expr = F.lit(None).cast("array<double>")
    k_expr = F.lit(0)
    for i, c in enumerate(features):
        ts = sorted_t[c]
        if ts:
            t_expr = F.when(F.col("f") == i, F.array(*[F.lit(float(t)) for t in ts])).otherwise(t_expr)
            k_expr = F.when(F.col("f") == i, F.lit(len(ts))).otherwise(k_expr)
    n = F.col("n").cast("double")
    rn = F.col("n") - F.col("ln")
    lv = _var(F.col("ls"), F.col("lss"), F.col("ln").cast("double"))
    rv = _var(F.col("ts") - F.col("ls"), F.col("tss") - F.col("lss"), rn.cast("double"))
    mse = (lv * F.col("ln") + rv * rn) / n
    valid = (
        (F.col("f") >= 0) & (F.col("b") < k_expr) & (F.col("ln") >= min_side) & (rn >= min_side)
        & (F.col("n") >= min_node)
    )
    thr = F.when(F.col("f") >= 0, F.element_at(t_expr, F.col("b") + 1))
    cand = F.struct(mse.alias("mse"), F.col("f").alias("feature_index"), thr.alias("threshold"))
    total = F.col("f") == -1
    return w.groupBy("node").agg(
        F.max(F.when(total, F.col("cnt"))).alias("n"),
        F.max(F.when(total, F.col("sy"))).alias("s"),
        F.max(F.when(total, F.col("syy"))).alias("ss"),
        F.min_by(cand, F.when(valid, cand)).alias("best"),
    )


def split_candidates(
    df: DataFrame,
    node: Column,
    features: Sequence[str],
    thresholds: Mapping[str, Sequence[float]],
    y: Column,
) -> DataFrame | None:
    """Every candidate split of every node in one pass."""
    return candidates_from_bins(grouped_bins(df, node, features, thresholds, y), features, thresholds)


def _var(s: Column, ss: Column, n: Column) -> Column:
    return F.when(n > 0, F.greatest(ss / n - F.pow(s / n, 2), F.lit(0.0))).otherwise(F.lit(0.0))


def score_candidates(cands: DataFrame, min_side: int = MIN_SIDE) -> DataFrame:
    """Add ``node_variance, mse`` (weighted child variance) and ``valid``."""
    n = F.col("n").cast("double")
    lv = _var(F.col("left_sum"), F.col("left_sumsq"), F.col("left_n").cast("double"))
    rv = _var(F.col("right_sum"), F.col("right_sumsq"), F.col("right_n").cast("double"))
    return cands.select(
        "*",
        _var(F.col("total_sum"), F.col("total_sumsq"), n).alias("node_variance"),
        ((lv * F.col("left_n") + rv * F.col("right_n")) / n).alias("mse"),
        ((F.col("left_n") >= min_side) & (F.col("right_n") >= min_side)).alias("valid"),
    )


def best_splits(scored: DataFrame, gain_factor: float = GAIN_FACTOR) -> DataFrame:
    """Per node: the valid candidate of least ``mse`` (first feature, then
    smallest threshold on ties), kept only if ``mse < gain_factor·variance``."""
    v = scored.filter("valid")
    best = v.groupBy("node").agg(
        F.min_by(
            F.struct("mse", "feature_index", "threshold", "left_n", "right_n", "node_variance"),
            F.struct("mse", "feature_index", "threshold"),
        ).alias("b")
    )
    best = best.select("node", "b.*")
    return best.filter(F.col("mse") < F.col("node_variance") * gain_factor)


# --------------------------------------------------------------------- fit
def fit_tree(
    train: DataFrame,
    features: Sequence[str],
    label: str,
    thresholds: Mapping[str, Sequence[float]] | None = None,
    max_depth: int = MAX_DEPTH,
    min_node: int = MIN_NODE,
    min_side: int = MIN_SIDE,
    gain_factor: float = GAIN_FACTOR,
    n_thresholds: int = N_THRESHOLDS,
    prepared: bool = False,
) -> Tree:
    """Grow the tree level by level (I9); ``≤ max_depth + 1`` passes."""
    features = list(features)
    data = train.select(*[F.col(c).cast("double") for c in features], F.col(label).cast("double").alias("_y"))
    if not prepared:
        data = materialize(data)
    # One aggregate over the stored rows: candidate ranges and the target
    # mean used to centre the squares.
    row = data.agg(
        *[F.min(c).alias(f"lo_{c}") for c in features],
        *[F.max(c).alias(f"hi_{c}") for c in features],
        F.avg("_y").alias("m"),
    ).first()
    if thresholds is None:
        thresholds = {c: equal_width_thresholds(row[f"lo_{c}"], row[f"hi_{c}"], n_thresholds) for c in features}
    shift = float(row["m"] or 0.0)
    yc = F.col("_y") - F.lit(shift)

    tree = Tree(features)
    open_nodes = {1: 0}  # node id -> depth (all open nodes share the level)
    decided: dict[int, Node] = {}
    level = 0
    while open_nodes:
        # node id of each row: decided splits route rows; open nodes are leaves
        partial = Tree(features, dict(decided))
        for nid, d in open_nodes.items():
            partial.nodes[nid] = Node(nid, d, 0, 0.0, 0.0)
        node = partial.node_col() if decided else F.lit(1)
        open_ids = list(open_nodes)
        rows = data.select(*features, yc.alias("y"), node.alias("_node")).filter(F.col("_node").isin(*open_ids))
        g = grouped_bins(rows, F.col("_node"), features, thresholds, F.col("y"))
        summary = level_summary(
            g, features, thresholds, min_side, min_node if level < max_depth else 1 << 62
        ).collect()
        stats = {r["node"]: r for r in summary}
        chosen = {}
        for r in summary:
            b = r["best"]
            if b is None or not r["n"]:
                continue
            n_, s_, ss_ = float(r["n"]), float(r["s"]), float(r["ss"])
            if b["mse"] < gain_factor * (ss_ / n_ - (s_ / n_) ** 2):
                chosen[r["node"]] = {"feature_index": b["feature_index"], "threshold": b["threshold"]}
        next_open = {}
        for nid in open_ids:
            d = open_nodes[nid]
            st = stats.get(nid)
            n = int(st["n"]) if st else 0
            s_ = float(st["s"]) if st else 0.0
            ss = float(st["ss"]) if st else 0.0
            mean = s_ / n + shift if n else 0.0
            var = ss / n - (s_ / n) ** 2 if n else 0.0
            node_obj = Node(nid, d, n, mean, var)
            if nid in chosen and n >= min_node and d < max_depth:
                c = chosen[nid]
                node_obj.feature = int(c["feature_index"])
                node_obj.threshold = float(c["threshold"])
                next_open[2 * nid] = d + 1
                next_open[2 * nid + 1] = d + 1
            decided[nid] = node_obj
        open_nodes = next_open
        level += 1
    tree.nodes = decided
    if not prepared:
        release(data)
    return tree


def root_split_table(
    df: DataFrame,
    features: Sequence[str],
    label: str,
    thresholds: Mapping[str, Sequence[float]],
    min_side: int = MIN_SIDE,
) -> DataFrame:
    """All candidate splits of the root with their scores (for inspection).
    The target is centred on its mean, like in ``fit_tree``."""
    y = F.col(label).cast("double")
    mean = float(df.agg(F.avg(y)).first()[0] or 0.0)
    cands = split_candidates(df, F.lit(1), features, thresholds, y - F.lit(mean))
    return score_candidates(cands, min_side)


def feature_importance(tree: Tree) -> dict[str, float]:
    """Variance reduction per feature, normalised to sum 1 (like Spark)."""
    imp = {f: 0.0 for f in tree.features}
    for nid, n in tree.nodes.items():
        if n.is_leaf:
            continue
        l, r = tree.nodes.get(2 * nid), tree.nodes.get(2 * nid + 1)
        gain = n.count * n.impurity - (l.count * l.impurity if l else 0) - (r.count * r.impurity if r else 0)
        imp[tree.features[n.feature]] += gain
    total = sum(imp.values())
    return {f: (v / total if total > 0 else 0.0) for f, v in imp.items()}
