"""Edge cases and properties from SURVEY §5 / FIXTURES §6."""

import math

from pyspark.sql import functions as F

from quarry.functions.scale import fit_minmax
from quarry.operators import clean, evaluate, logistic, profile
from quarry.operators import tree as T


def test_empty_frames(spark):
    empty = spark.createDataFrame([], "x double, p double, label double, key string")
    assert profile.describe(empty, ["x"]).first()["count"] == 0
    assert profile.histogram(empty, ["x"]).count() == 0
    assert profile.target_stats(empty, "x").first()["mean"] == 0.0
    assert evaluate.auc_ties(empty).first()["auc"] == 0.0
    assert evaluate.auc_stepwise(empty, F.col("key")).first()["auc"] == 0.0
    conf = evaluate.confusion(empty).first()
    assert (conf["tp"], conf["accuracy"], conf["f1"]) == (0, 0.0, 0.0)
    tree = T.fit_tree(empty.select("x", "label"), ["x"], "label", max_depth=2, min_node=1, min_side=1)
    assert tree.nodes[1].is_leaf and tree.nodes[1].prediction == 0.0 and tree.nodes[1].count == 0


def test_one_row(spark):
    df = spark.createDataFrame([(2.0, 1.0)], "x double, label double")
    runs = logistic.gradient_descent(df, ["x"], [(0.1, 0.0)], max_iter=2)
    assert len(runs[0].history) == 2 and runs[0].weights[0] > 0
    assert profile.describe(df, ["x"]).first()["stddev"] is None  # sample stddev of one row
    assert profile.feature_summary(df, ["x"]).first()["stddev"] == 0.0


def test_negative_zero_and_nan_grouping(spark):
    df = spark.createDataFrame([(0.0,), (-0.0,), (float("nan"),), (float("nan"),)], "x double")
    assert clean.dedup(df).count() == 2
    assert clean.drop_nulls(df).count() == 2


def test_minmax_scaled_in_unit_interval_and_constant_column(spark):
    rows = [(float(i), 5.0) for i in range(20)]
    df = spark.createDataFrame(rows, "a double, c double")
    mm = fit_minmax(df, ["a", "c"])
    out = mm.transform(df).agg(F.min("a"), F.max("a"), F.max(F.abs("c"))).first()
    assert out[0] == 0.0 and out[1] == 1.0 and out[2] == 0.0


def test_training_sse_does_not_rise_with_depth(spark):
    rows = [(float(i % 37), float((i * 7) % 23), float((i % 37) * 3 + ((i * 7) % 23 > 11) * 50 + i % 5))
            for i in range(800)]
    df = spark.createDataFrame(rows, "a double, b double, y double")
    th = T.feature_thresholds(df, ["a", "b"])
    prev = math.inf
    for depth in range(0, 5):
        tree = T.fit_tree(df, ["a", "b"], "y", thresholds=th, max_depth=depth, min_node=20, min_side=10)
        sse = tree.predict(df).select(F.sum(F.pow(F.col("y") - F.col("prediction"), 2))).first()[0]
        assert sse <= prev + 1e-6
        prev = sse
        leaves = [n for n in tree.nodes.values() if n.is_leaf]
        assert sum(n.count for n in leaves) == 800


def test_perfect_separation_and_all_equal_scores(spark):
    rows = [(0.9, 1.0, "a"), (0.8, 1.0, "b"), (0.2, 0.0, "c"), (0.1, 0.0, "d")]
    df = spark.createDataFrame(rows, "p double, label double, key string")
    assert evaluate.auc_stepwise(df, F.col("key")).first()["auc"] == 1.0 - 0.5 * 2 / 4
    assert evaluate.auc_ties(df).first()["auc"] == 1.0
    same = spark.createDataFrame([(0.5, float(i % 2), str(i)) for i in range(10)], "p double, label double, key string")
    assert evaluate.auc_ties(same).first()["auc"] == 0.5


def test_wall_clock_parse_is_zone_free_and_null_safe(spark):
    from quarry.functions.columns import wall_clock

    rows = [("2024-03-10 02:30:00",), ("2024-02-30 10:00:00",), ("junk",), ("2024-01-07 23:59:59.5",)]
    df = spark.createDataFrame(rows, "t string")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        got = [r[0] for r in df.select(F.hour(wall_clock(F.col("t")))).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert got == [2, None, None, 23]


def test_results_independent_of_shuffle_partitions(spark):
    import __spark_entry__ as entry
    from conftest import SF001

    names = ["fraud_report", "auc_stepwise", "tree_nodes", "quantile_exact", "flag_index", "hash_split_counts"]
    got = {}
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for parts in ("3", "37"):
            spark.conf.set("spark.sql.shuffle.partitions", parts)
            got[parts] = {n: sorted(tuple(r) for r in entry.queries()[n](spark, SF001).collect()) for n in names}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    for n in names:
        assert got["3"][n] == got["37"][n], n
