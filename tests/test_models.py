"""The fits without a library behind them, against plain versions of their rules."""

import hashlib
import os
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from quarry.functions.columns import add_apart
from quarry.functions.digest import Md5Messages
from quarry.operators import curves, dense, evaluate, forest, lbfgs, logistic, preparation, seeded_tree
from quarry.operators.split import batch_member
from quarry.plans.store import Workspace
from quarry.sources import fixtures as fx


@pytest.fixture
def work(spark):
    with Workspace(spark, "test") as w:
        yield w


# ------------------------------------------------------------------ forest
def plain_tree(x, y, max_depth, least, path=1, depth=0):
    """{heap id: (count, mean)} of all nodes; x holds bins, y integers."""
    out = {path: (len(y), y.sum() / len(y))}
    best = None
    for f in range(x.shape[1]):
        for b in np.unique(x[:, f])[:-1]:
            left = x[:, f] <= b
            nl, nr = int(left.sum()), int((~left).sum())
            apart = y[left].sum() / nl - y[~left].sum() / nr
            gain = nl * nr / len(y) * (apart * apart)
            if nl >= least and nr >= least and gain > 0 and (best is None or gain > best[0]):
                best = (gain, f, b)
    if best is not None and depth < max_depth:
        left = x[:, best[1]] <= best[2]
        out |= plain_tree(x[left], y[left], max_depth, least, 2 * path, depth + 1)
        out |= plain_tree(x[~left], y[~left], max_depth, least, 2 * path + 1, depth + 1)
    return out


def cuts_of(values, bins):
    values = np.sort(values[~np.isnan(values)])
    n = len(values)
    reached = [values[-(-k * n // bins) - 1] for k in range(1, bins)]
    return sorted({v for v in reached if v < values[-1]})


@pytest.mark.parametrize("cells", [1 << 21, 10])
def test_forest_matches_a_plain_tree(spark, work, monkeypatch, cells):
    """Also with NULL and NaN features, ties, rows without a target, and both
    ways of adding up cells."""
    monkeypatch.setattr(forest, "DENSE_CELLS", cells)
    rng = np.random.default_rng(4)
    n = 700
    a, b, c = rng.integers(0, 6, n).astype(float), rng.normal(size=n).round(2), np.full(n, 3.0)
    b[rng.random(n) < 0.1] = np.nan
    y = (a * 3 + np.nan_to_num(b) * 5 + rng.integers(0, 4, n)).round(2)
    rows = [(float(p), None if np.isnan(q) and i % 2 else float(q), float(r), float(t), i % 3) for i, (p, q, r, t) in enumerate(zip(a, b, c, y))]
    rows += [(1.0, 1.0, 1.0, None, 0), (1.0, 1.0, 1.0, float("nan"), 1)]
    df = spark.createDataFrame(rows, "a double, b double, c double, y double, fold int").repartition(5)
    data = forest.prepare(df, ["a", "b", "c"], "y", work, fold=F.col("fold"), bins=8)
    assert data.skipped == 2 and [list(cut) for cut in data.cuts[:1]] == [cuts_of(np.append(a, [1, 1]), 8)]
    assert data.cuts[1] == cuts_of(np.append(b, [1, 1]), 8)
    x = np.column_stack([np.searchsorted(cut, np.where(np.isnan(v), np.inf, v), side="left") for cut, v in zip(data.cuts, (a, b, c))])
    yi = np.floor(y / 0.01 + 0.5).astype(np.int64)
    fold = np.arange(n) % 3
    specs = [forest.Spec(6, 1), forest.Spec(3, 20, 1), forest.Spec(0, 1)]
    for spec, grown in zip(specs, forest.grow(data, specs)):
        train = np.ones(n, bool) if spec.hold is None else fold != spec.hold
        want = plain_tree(x[train], yi[train], spec.max_depth, spec.min_instances)
        assert {p: (m, s / m) for p, m, s in zip(grown.path, grown.n, grown.s)} == want


def test_cross_validation_equals_single_fits(spark, work):
    rng = np.random.default_rng(1)
    rows = [(i, float(v), float(w), float(v * 2 + w)) for i, (v, w) in enumerate(rng.integers(0, 50, (400, 2)))]
    df = spark.createDataFrame(rows, "id long, a double, b double, y double")
    fold = (F.col("id") % 3).cast("int")
    data = forest.prepare(df, ["a", "b"], "y", work, fold=fold, keep=["id"])
    table, trees = forest.cross_validate(data, 3, (2, 4), (1, 30))
    got = {(r.max_depth, r.min_instances_per_node): r.avg_rmse for r in table.collect()}
    assert sum(r.is_best for r in table.collect()) == 1
    for (depth, least), rmse in got.items():
        each = []
        for f in range(3):
            alone = forest.grow(data, [forest.Spec(depth, least, f)])[0]
            pred = forest.predict(data, alone, data.rows.filter(F.col("fold") == f))
            each.append(evaluate.regression_metrics(pred, "prediction", "y").first()["rmse"])
        assert rmse == pytest.approx(sum(each) / 3, rel=1e-12)
    tree = forest.to_tree(data, trees[0], 2)
    assert tree.depth() <= 2 and abs(sum(forest.importances(trees[0], ["a", "b"]).values()) - 1) < 1e-12


@pytest.mark.parametrize("rows", [[], [(None, None)], [(1.0, 5.0)], [(1.0, 5.0)] * 40])
def test_forest_without_anything_to_split(spark, work, rows):
    data = forest.prepare(spark.createDataFrame(rows, "a double, y double"), ["a"], "y", work)
    grown = forest.grow(data, [forest.Spec(5)])[0]
    assert grown.left == [-1] and grown.n == [sum(r[1] is not None for r in rows)]


# ------------------------------------------------------------- seeded tree
def plain_seeded(data, x, y, params, path=1, depth=0):
    max_depth, min_node, min_side, gain = params
    n = len(y)
    var = y.var()
    out = {path: (n, None, None)}
    best = None
    for f in range(x.shape[1]):
        for t in data.thresholds(path, f):
            left = x[:, f] <= t
            nl = int(left.sum())
            if nl < min_side or n - nl < min_side:
                continue
            mse = (y[left].var() * nl + y[~left].var() * (n - nl)) / n
            if best is None or mse < best[0] - 1e-9:
                best = (mse, f, t)
    if best is None or n < min_node or depth >= max_depth or not best[0] < gain * var:
        return out
    out[path] = (n, best[1], best[2])
    left = x[:, best[1]] <= best[2]
    out |= plain_seeded(data, x[left], y[left], params, 2 * path, depth + 1)
    return out | plain_seeded(data, x[~left], y[~left], params, 2 * path + 1, depth + 1)


def test_seeded_tree_matches_a_plain_one(spark, work):
    rng = np.random.default_rng(2)
    x = np.column_stack([rng.integers(0, 40, 900), rng.normal(size=900), np.full(900, 2.0)]).astype(float)
    y = (x[:, 0] * 10 + 40 * (x[:, 1] > 0.3) + rng.integers(0, 30, 900)).astype(float)
    df = spark.createDataFrame([(*map(float, r), float(t)) for r, t in zip(x, y)], "a double, b double, c double, y double").repartition(3)
    data = seeded_tree.prepare(df, ["a", "b", "c"], "y", work, seed=7, unit=1.0)
    tree = seeded_tree.fit(data, 3, 40, 10, 0.95)
    assert {i: (n.count, n.feature, n.threshold) for i, n in tree.nodes.items()} == plain_seeded(data, x, y, (3, 40, 10, 0.95))
    assert len(tree.nodes) > 5 and data.thresholds(2, 0) != data.thresholds(3, 0) and data.thresholds(1, 2) == []
    table = {(r.feature_index, r.threshold): r for r in seeded_tree.split_table(data, tree, [1], 10).collect()}
    for f in (0, 1):
        for t in data.thresholds(1, f):
            r, left = table[f, t], x[:, f] <= t
            assert (r.left_n, r.right_n) == (left.sum(), (~left).sum())
            sides = sum(s.sum() * y[s].var() for s in (left, ~left) if s.any()) / len(y)
            assert r.variance_share == pytest.approx(sides / y.var(), rel=1e-9)


def test_seeded_tree_of_an_empty_table(spark, work):
    data = seeded_tree.prepare(spark.createDataFrame([], "a double, y double"), ["a"], "y", work)
    assert seeded_tree.fit(data, 3, 2, 1).nodes == {}


# ------------------------------------------------------------------ L-BFGS
@pytest.fixture(scope="module")
def binary(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(2500, 3)) * [1.0, 5.0, 0.2] + [0.0, 3.0, -1.0]
    y = (rng.random(2500) < 1 / (1 + np.exp(-(0.5 + x @ [1.0, -0.4, 3.0])))).astype(float)
    rows = [(i, *map(float, r), float(t)) for i, (r, t) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, "id long, a double, b double, c double, label double").repartition(4).cache()


@pytest.mark.parametrize("l2", [0.0, 0.1])
def test_lbfgs_reaches_the_optimum_of_spark_ml(spark, work, binary, l2):
    feats = ["a", "b", "c"]
    found = lbfgs.fit(binary, feats, l2=l2, sums=dense.loss_sums(dense.pack(binary, feats, work)))
    assert found.converged and max(map(abs, found.gradient)) <= 1e-10 and found.rows == 2500
    ml = LogisticRegression(maxIter=500, tol=1e-12, regParam=l2, standardization=False)
    model = ml.fit(VectorAssembler(inputCols=feats, outputCol="features").transform(binary))
    assert np.allclose(found.weights, [model.intercept, *model.coefficients.toArray()], atol=1e-4)


def test_lbfgs_on_columns_and_without_rows(spark, binary):
    feats = ["a", "b", "c"]
    some = lbfgs.fit(binary, feats, l2=1.0, max_iter=3)
    assert some.iterations == 3 and some.loss < np.log(2)
    assert lbfgs.fit(binary.limit(0), feats).weights == [0.0] * 4


# ------------------------------------------------------------------- dense
def test_moments_merge_without_cancelling(spark, work, monkeypatch):
    monkeypatch.setattr(dense, "BLOCK", 64)
    monkeypatch.setattr(dense, "FAN_IN", 3)
    rng = np.random.default_rng(5)
    m = rng.normal(size=(3000, 3)) * [1e-3, 1.0, 50.0] + [1e6, 0.0, -7.0]
    y = (m[:, 1] > 0).astype(float)
    rows = [(*map(float, r), float(t)) for r, t in zip(m, y)] + [(None, 1.0, 1.0, 1.0), (1.0, float("nan"), 1.0, 0.0), (1.0, 1.0, 1.0, None)]
    df = spark.createDataFrame(rows, "a double, b double, c double, label double").repartition(11)
    blocks = dense.pack(df, ["a", "b", "c"], work)
    assert (blocks.rows, blocks.skipped) == (3000, 3)
    got = dense.moments(blocks)
    full = np.column_stack([m, y])
    assert np.allclose(got.mean, full.mean(0), rtol=1e-12) and np.allclose(got.co, np.cov(full.T, bias=True) * 3000, rtol=1e-6, atol=1e-6)
    table = dense.summary_frame(spark, blocks, got).collect()
    assert [r.feature for r in table] == ["a", "b", "c"] and table[1].label_correlation == pytest.approx(np.corrcoef(m[:, 1], y)[0, 1])


def test_block_sums_equal_column_sums(spark, work, binary):
    feats = ["a", "b", "c"]
    weighted = binary.withColumn("w", F.when(F.col("label") == 1.0, 2.5).otherwise(0.5))
    vectors = [[0.0] * 4, [0.1, -0.2, 0.3, 2.0]]
    base = weighted.select(*feats, F.col("label").alias("_y"), F.col("w").alias("_cw"))
    n, grads, losses = logistic.batch_sums_columns(base, feats, vectors)
    got = dense.loss_sums(dense.pack(weighted, feats, work, weight=F.col("w")))(vectors)
    assert got[0] == n and np.allclose(got[1], grads, rtol=1e-11) and np.allclose(got[2], losses, rtol=1e-12)


def test_moments_of_an_empty_table(spark, work):
    blocks = dense.pack(spark.createDataFrame([], "a double, label double"), ["a"], work)
    assert dense.moments(blocks) is None and dense.summary_frame(spark, blocks, None).count() == 0


# ------------------------------------------------------------------ curves
def plain_auc(rows):
    """The stepwise rule over (p, key, label), scores descending."""
    rows = sorted(rows, key=lambda r: (-r[0], r[1], r[2] != 1.0))
    P = sum(r[2] == 1.0 for r in rows)
    N = len(rows) - P
    total, tp, before = 0.0, 0, 0
    for _, _, label in rows:
        if label == 1.0:
            tp += 1
        else:
            total += (tp + before) / (2.0 * P * N)
            before = tp
    return total


@pytest.mark.parametrize("bins", [4, 1 << 14])
def test_ranking_equals_ordering_everything(spark, bins):
    """Ties, equal rows, a constant model, a reversed one, and scores 0 and 1."""
    rng = np.random.default_rng(6)
    n = 400
    label = (rng.random(n) < 0.3).astype(float)
    good = np.clip(label * 0.4 + rng.random(n) * 0.6, 0, 1).round(2)
    scores = np.column_stack([good, 1 - good, np.full(n, 0.5), np.clip(good + rng.normal(size=n) * 0.01, 0, 1), (good > 0.5).astype(float)])
    keys = [f"k{i % 150:03d}" for i in range(n)]
    rows = [(s.tolist(), float(t), k) for s, t, k in zip(scores, label, keys)]
    df = spark.createDataFrame(rows, "scores array<double>, label double, key string").repartition(3)
    want = [plain_auc(list(zip(scores[:, i], keys, label))) for i in range(5)]
    got = curves.rank_models(df, 5, bins=bins).collect()
    for r in got:
        assert r.lower - 1e-12 <= want[r.config_index] <= r.upper + 1e-12
        assert not r.ordered or r.auc == pytest.approx(want[r.config_index], rel=1e-12)
    assert max((r.auc, -r.config_index) for r in got if r.ordered) == pytest.approx(max((w, -i) for i, w in enumerate(want)))
    one = curves.rank_models(df.filter("label = 1"), 5).collect()
    assert [(r.auc, r.ordered) for r in one] == [(0.0, True)] * 5


def test_binned_area_is_within_its_bound(spark):
    rng = np.random.default_rng(8)
    rows = [(float(p), float(rng.random() < p)) for p in np.append(rng.random(3000), [0.0, 1.0])] + [(None, 1.0)]
    df = spark.createDataFrame(rows, "p double, label double")
    exact = evaluate.auc_ties(df.filter("p is not null")).first()["auc"]
    for bins in (1, 10, 1000):
        r = curves.binned_auc(df, bins=bins).first()
        assert abs(r.auc - exact) <= r.error_bound + 1e-12 and r.positives + r.negatives == 3002
    assert curves.binned_curve(df, bins=10).count() == 10
    empty = curves.binned_auc(df.limit(0)).first()
    assert (empty.auc, empty.positives) == (0.0, 0)


# ------------------------------------------------------------- mini-batches
def test_mini_batches_ignore_partitions(spark, binary):
    feats = ["a", "b", "c"]
    args = dict(mini_batch_fraction=0.3, key=F.col("id"), tol=0.0, method="arrow")
    a, b = (logistic.sgd_fit(binary.repartition(k), feats, [(5, 0.5)], **args)[0].weights for k in (2, 7))
    assert np.allclose(a, b, rtol=1e-12)
    parts = [binary.filter(batch_member(F.col("id").cast("string"), 0.3, 42, t)).count() for t in (1, 2)]
    assert all(600 < n < 900 for n in parts) and parts[0] != parts[1]


# ------------------------------------------------------- stored preparation
TRIPS = [(1, "Y", 2.0, 10.0), (2, "N", 4.0, 20.0), (3, "N", 6.0, 30.0), (4, None, 8.0, 5.0)]


def test_a_stored_preparation_works_in_another_session(spark, tmp_path):
    train = spark.createDataFrame(TRIPS, "id long, flag string, x double, y double")
    path = os.path.join(tmp_path, "prep")
    preparation.fit(train, ["x", "flag_indexed"], {"y": (8, 40), "x": (0, 7)}, ["x", "y"], ["flag"], ["x"]).save(path)
    other = spark.newSession()
    rows = [(9, "Z", 1.0, 9.0), (10, "N", None, 9.0), (11, "Y", float("nan"), 50.0), (12, None, 7.5, 50.0), (13, "Y", 3.0, 50.0)]
    df = other.createDataFrame(rows, "id long, flag string, x double, y double")
    loaded = preparation.Preparation.load(other, path)
    got = {r.id: r for r in loaded.apply(df, ["id"]).collect()}
    sd = np.std([2, 4, 6, 8], ddof=1)
    assert loaded.features() == ["x", "flag_indexed"] and got[9].x == pytest.approx(1 / sd)
    assert [got[i].flag_indexed for i in (9, 10, 11, 12)] == [2.0, 0.0, 1.0, 2.0]
    assert [got[i].reason for i in (9, 10, 11, 12, 13)] == [None, "missing x", "missing x", "range y", "range y"]
    unlabelled = loaded.apply(df.drop("y"), ["id"], with_label=False, label="y")
    assert {r.id for r in preparation.complete(unlabelled).collect()} == {9, 13}
    assert {(r.reason, r.rows) for r in preparation.rejects(loaded.apply(df)).collect()} == {(None, 1), ("missing x", 2), ("range y", 2)}


def test_a_preparation_of_another_version_is_refused(spark, tmp_path):
    path = os.path.join(tmp_path, "prep")
    train = spark.createDataFrame(TRIPS, "id long, flag string, x double, y double")
    found = preparation.fit(train, ["x"])
    preparation.Preparation(found.table.withColumn("version", F.lit(2))).save(path)
    with pytest.raises(ValueError, match="version"):
        preparation.Preparation.load(spark, path)


# ---------------------------------------------------------------- workspace
def test_a_workspace_leaves_nothing_behind(spark):
    with Workspace(spark, "gone") as w:
        w.store(spark.range(5), "a")
        root = w.root.removeprefix("file:")
        assert os.path.isdir(root)
        assert [r.id for r in w.small(spark.range(3)).collect()] == [0, 1, 2]
        with pytest.raises(ValueError):
            w.small(spark.range(3), bound=2)
    assert not os.path.exists(root)


def test_full_steps_of_sgd_default_stay_in_generated_code(spark, monkeypatch):
    from quarry.catalog import models

    def no_arrow(*_):
        raise AssertionError("a step over all rows went through Python")

    monkeypatch.setattr(logistic, "batch_sums_arrow", no_arrow)
    monkeypatch.setattr(models, "SGD_DEFAULT", (2, 1.0))
    assert models.sgd_default(spark, "/root/testdata/sf0.001").first()["iterations_run"] == 2


# ------------------------------------------------- passes that repeat
def lineitem(spark, path, rows=300):
    """A small lineitem, some of its rows twice and with nulls."""
    data = [(i, i * 7 % 50, i % 4 + 1, float(i % 50 + 1), float(i % 11) / 100, (i % 9) / 100, 900.0 + i * 3.1) for i in range(1, rows)]
    data += data[:20] + [(None, 1, 1, 2.0, 0.1, 0.02, 5.0), (5, 1, 2, None, 0.1, 0.02, 5.0)]
    names = "l_orderkey long, l_partkey long, l_linenumber int, l_quantity double, l_discount double, l_tax double, l_extendedprice double"
    spark.createDataFrame(data, names).coalesce(1).write.parquet(os.path.join(path, "lineitem.parquet"))
    return str(path)


def test_messages_hash_as_md5_does():
    texts = [None, "", "\u00e9", *["x" * (i * 7 % 190) + str(i) for i in range(400)]]
    messages = Md5Messages(pa.array(texts, pa.string()), "|")
    for prefix in ("", "42|7", "42|17", "42|100"):
        want = [hashlib.md5((prefix + ("" if t is None else "|" + t)).encode()).hexdigest()[:7] for t in texts]
        assert [f"{v:07x}" for v in messages.leading(prefix)] == want
    assert len(Md5Messages(pa.array([], pa.string())).leading("42|1")) == 0


def test_batches_of_blocks_are_the_rows_of_batch_member(spark, work, binary):
    """Also with keys that repeat or are null."""
    feats = ["a", "b", "c"]
    keyed = binary.withColumn("key", F.when(F.col("id") % 50 != 0, (F.col("id") / 2).cast("long").cast("string")))
    blocks = dense.pack(keyed, feats, work, batches=dense.Batches(F.col("key"), 0.3, 42, 12))
    sums, vectors = dense.batch_loss_sums(blocks), [[0.0] * 4, [0.1, -0.2, 0.3, 2.0]]
    for t in (1, 9, 12):
        batch = keyed.filter(batch_member(F.col("key"), 0.3, 42, t)).select(*feats, F.col("label").alias("_y"), F.lit(1.0).alias("_cw"))
        n, grads, losses = logistic.batch_sums_columns(batch, feats, vectors)
        got = sums(t, vectors)
        assert got[0] == n and np.allclose(got[1], grads, rtol=1e-10, atol=1e-10) and np.allclose(got[2], losses, rtol=1e-10)


def test_minibatches_hash_their_rows_once(spark, tmp_path, monkeypatch):
    from quarry.catalog import models

    def again(*_):
        raise AssertionError("a step read and hashed all rows")

    monkeypatch.setattr(logistic, "batch_sums", again)
    monkeypatch.setattr(models, "SGD_DEFAULT", (3, 1.0))
    assert models.sgd_minibatch(spark, lineitem(spark, tmp_path)).first()["iterations_run"] == 3


def test_later_passes_read_what_the_executors_keep(spark, binary):
    held = spark.sparkContext._jsc.getPersistentRDDs().size()
    with Workspace(spark, "test") as w:
        sums = dense.loss_sums(dense.pack(binary, ["a", "b", "c"], w))
        first = sums([[0.1] * 4])
        w.delete("blocks")
        assert sums([[0.1] * 4]) == first
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == held


def test_kept_blocks_are_small_whatever_their_width(spark, work):
    """No array of half a region of the heap (512 KB of 1 MB), and none stored as a table beside."""
    feats = [f"v{i}" for i in range(60)]
    x, label = [F.rand(i).alias(c) for i, c in enumerate(feats)], (F.col("id") % 2).cast("double").alias("label")
    df = spark.range(0, 9000, 1, 1).select(*x, label)
    n, _, losses = dense.loss_sums(dense.pack(df, feats, work))([[0.0] * 61])
    sizes = work.kept[0].map(lambda block: max(x.nbytes if hasattr(x, "nbytes") else len(x) if isinstance(x, bytes) else 0 for x in block)).collect()
    assert max(sizes) < 1 << 19 and n == 9000 and losses[0] == pytest.approx(9000 * np.log(2))
    assert not os.path.exists(work.path("blocks").removeprefix("file:"))


def test_card_grid_stores_no_rows_twice_and_ranks_without_its_blocks(spark, tmp_path, monkeypatch):
    path = lineitem(spark, tmp_path)
    spark.read.parquet(path + "/lineitem.parquet").dropna().write.parquet(str(tmp_path / "whole" / "lineitem.parquet"))
    stored, ranked, keep = [], [], spark.sparkContext._jsc.getPersistentRDDs
    held, rank, store = keep().size(), curves.rank_models, Workspace.store
    monkeypatch.setattr(curves, "rank_models", lambda *a: ranked.append(keep().size()) or rank(*a))
    monkeypatch.setattr(Workspace, "store", lambda self, df, name: stored.append(name) or store(self, df, name))
    from quarry.catalog import models

    assert models.card_grid(spark, str(tmp_path / "whole")).count() == 1
    assert (stored, ranked) == (["scored"], [held])


def test_blocks_hold_rows_to_the_bit(spark, work):
    """Also infinities, zeros of both signs, and a partition whose rows are all left out."""
    rows = [(float(i) / 7, -0.0, float("inf") if i % 5 else 5e-324, float(i % 2)) for i in range(500)] + [(None, 1.0, 1.0, 1.0)] * 9
    df = spark.createDataFrame(rows, "a double, b double, c double, label double").orderBy("a").coalesce(1)
    blocks = dense.pack(df.filter("a is not null").unionByName(df.filter("a is null")), ["a", "b", "c"], work)
    got = np.concatenate(blocks.kept.map(lambda block: dense._matrix(block, 3)).collect())
    want = sorted((*r, 1.0) for r in rows[:500])
    assert sorted(map(tuple, got.tolist())) == want and np.signbit(got[:, 1]).all() and (blocks.rows, blocks.skipped) == (500, 9)


def longest_method(spark, df, capsys):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        df.explain("codegen")
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    return max(map(int, re.findall(r"maxMethodCodeSize:(\d+)", capsys.readouterr().out)))


def test_card_rows_are_projected_by_code_that_the_jvm_compiles(spark, tmp_path, capsys):
    path = lineitem(spark, tmp_path)
    card = fx.card(spark, path)
    assert longest_method(spark, card, capsys) < 8000
    assert card.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism
    rows = {(r.key, r.amount): r for r in card.collect()}
    assert len(rows) == 301 and card.count() == 321
    r = rows["30|3", 900.0 + 30 * 3.1]  # quantity 31, discount 0.08
    assert r.label == 0.0 and r.v3 == pytest.approx((30 * 7 + 10 * 6 + 3 * 7) % 109 / 109 - 0.5)
    assert rows["1", 5.0].v1 is None and rows["5|2", 5.0].label == 0.0


def test_columns_added_apart_equal_columns_added_at_once(spark, binary):
    columns = {f"d{i}": F.col("a") * i + F.col("b") for i in range(7)}
    apart, once = add_apart(binary, columns, 3), binary.withColumns(columns)
    assert apart.columns == once.columns and sorted(map(tuple, apart.collect())) == sorted(map(tuple, once.collect()))
