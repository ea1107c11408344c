"""Level-wise tree (I8–I10, A13) against an enumeration of all candidate splits."""

import math
import random
import statistics

from pyspark.sql import functions as F

from quarry.operators import tree as T


def expected_nodes(rows, thresholds, max_depth, min_node, min_side, gain):
    """Node id -> (count, mean, split or None), by listing all candidate
    splits of each node and taking the least pooled variance."""
    todo, nodes = [(1, rows)], {}
    while todo:
        nid, own = todo.pop()
        target = [r[-1] for r in own]
        depth = nid.bit_length() - 1
        sides = [
            (fi, t, [r for r in own if r[fi] <= t], [r for r in own if r[fi] > t])
            for fi, name in enumerate(thresholds)
            for t in sorted(thresholds[name])
        ]
        scored = [
            (sum(len(side) * statistics.pvariance([r[-1] for r in side]) for side in (low, high)) / len(own), i)
            for i, (_, _, low, high) in enumerate(sides)
            if min(len(low), len(high)) >= min_side
        ]
        split = None
        if scored and len(own) >= min_node and depth < max_depth:
            least = min(s for s, _ in scored)
            i = next(i for s, i in scored if s <= least + 1e-9)
            if least < gain * statistics.pvariance(target):
                split = sides[i][:2]
                todo += [(2 * nid, sides[i][2]), (2 * nid + 1, sides[i][3])]
        nodes[nid] = (len(own), statistics.fmean(target), split)
    return nodes


def _data(spark, n=600, seed=4):
    rnd = random.Random(seed)
    rows = []
    for _ in range(n):
        a, b = rnd.uniform(0, 10), rnd.uniform(-5, 5)
        y = (100.0 if a > 6 else 10.0) + (30.0 if b > 1 else 0.0) + rnd.gauss(0, 3) + 5000.0
        rows.append((a, b, y))
    return rows, spark.createDataFrame(rows, "a double, b double, y double").repartition(4)


def test_tree_matches_brute_force(spark):
    rows, df = _data(spark)
    th = T.feature_thresholds(df, ["a", "b"], 10)
    params = dict(max_depth=3, min_node=40, min_side=20, gain_factor=0.95)
    tree = T.fit_tree(df, ["a", "b"], "y", thresholds=th, **params)
    expected = expected_nodes(rows, {"a": th["a"], "b": th["b"]}, 3, 40, 20, 0.95)
    assert set(tree.nodes) == set(expected)
    for nid, (count, mean, split) in expected.items():
        n = tree.nodes[nid]
        assert n.count == count
        assert n.is_leaf == (split is None)
        if split:
            assert n.feature == split[0] and math.isclose(n.threshold, split[1])
        else:
            assert math.isclose(n.prediction, mean, rel_tol=1e-9)
    # compiled CASE equals walking the tree; leaf counts add up
    pred = {r["a"]: r["prediction"] for r in tree.predict(df).collect()}
    leaves = [n for n in tree.nodes.values() if n.is_leaf]
    assert sum(n.count for n in leaves) == len(rows)

    def walk(r, nid=1):
        n = tree.nodes[nid]
        if n.is_leaf:
            return n.prediction
        return walk(r, 2 * nid if r[n.feature] <= n.threshold else 2 * nid + 1)

    for r in rows[:50]:
        assert math.isclose(pred[r[0]], walk(r))


def test_no_acceptable_split_gives_root_leaf(spark):
    rows = [(float(i % 2), 7.0) for i in range(100)]
    df = spark.createDataFrame(rows, "a double, y double")
    tree = T.fit_tree(df, ["a"], "y", max_depth=3, min_node=10, min_side=5)
    assert list(tree.nodes) == [1] and tree.nodes[1].is_leaf and tree.nodes[1].prediction == 7.0


def test_constant_feature_has_no_thresholds(spark):
    assert T.equal_width_thresholds(3.0, 3.0) == []


def test_save_load_round_trip(spark, tmp_path):
    rows, df = _data(spark, n=300)
    tree = T.fit_tree(df, ["a", "b"], "y", max_depth=2, min_node=40, min_side=20)
    tree.save(spark, str(tmp_path / "tree"))
    loaded = T.Tree.from_table(spark.read.parquet(str(tmp_path / "tree")), ["a", "b"])
    a = tree.predict(df).select(F.sum("prediction")).first()[0]
    b = loaded.predict(df).select(F.sum("prediction")).first()[0]
    assert math.isclose(a, b)
    assert "If (" in tree.debug_string()


def test_arrow_traversal_equals_case_expression(spark):
    rows, df = _data(spark, n=800, seed=9)
    tree = T.fit_tree(df, ["a", "b"], "y", max_depth=6, min_node=10, min_side=5)
    a = {r["a"]: r["prediction"] for r in tree.predict(df, method="case").collect()}
    b = {r["a"]: r["prediction"] for r in tree.predict(df, method="arrow").collect()}
    assert len(tree.nodes) > 3 and a == b


def test_root_split_table_centres_the_target(spark):
    rows = [(float(i % 10), 1e9 + float(i % 2)) for i in range(1000)]
    df = spark.createDataFrame(rows, "a double, y double")
    table = T.root_split_table(df, ["a"], "y", {"a": [2.0, 5.0]}, 10).collect()
    assert all(math.isclose(r["node_variance"], 0.25, rel_tol=1e-6) for r in table)
