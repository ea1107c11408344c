"""Parity with Spark ML on the same inputs."""

import math
import random

import numpy as np
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.evaluation import (
    BinaryClassificationEvaluator,
    MulticlassClassificationEvaluator,
    RegressionEvaluator,
)
from pyspark.ml.feature import VectorAssembler

from quarry.operators import evaluate, logistic


def test_regression_metrics_match_evaluator(spark):
    rnd = random.Random(1)
    rows = [(float(rnd.gauss(100, 20)), float(rnd.gauss(100, 25))) for _ in range(500)]
    df = spark.createDataFrame(rows, "label double, prediction double")
    ours = evaluate.regression_metrics(df).first()
    for metric in ("rmse", "mse", "mae", "r2"):
        ref = RegressionEvaluator(metricName=metric).evaluate(df)
        assert math.isclose(ours[metric], ref, rel_tol=1e-9), metric


def test_tie_aware_auc_matches_binary_evaluator(spark):
    rnd = random.Random(2)
    rows = [(round(rnd.random(), 2), float(rnd.random() < 0.35)) for _ in range(2000)]
    df = spark.createDataFrame(rows, "p double, label double")
    ours = evaluate.auc_ties(df).first()["auc"]
    ref = BinaryClassificationEvaluator(rawPredictionCol="p", labelCol="label").evaluate(df)
    assert math.isclose(ours, ref, rel_tol=1e-9)


def test_weighted_metrics_match_multiclass_evaluator(spark):
    rnd = random.Random(3)
    rows = [(float(rnd.random() < 0.4), float(rnd.random() < 0.3)) for _ in range(1000)]
    df = spark.createDataFrame(rows, "prediction double, label double")
    ours = evaluate.weighted_metrics(df).first()
    for ours_name, metric in [("accuracy", "accuracy"), ("weighted_precision", "weightedPrecision"),
                              ("weighted_recall", "weightedRecall"), ("weighted_f1", "f1")]:
        ref = MulticlassClassificationEvaluator(metricName=metric).evaluate(df)
        assert math.isclose(ours[ours_name], ref, rel_tol=1e-9), metric


def test_gradient_descent_reaches_spark_lr_optimum(spark):
    rng = np.random.default_rng(4)
    X = rng.normal(size=(400, 2))
    y = (X[:, 0] - 0.5 * X[:, 1] + rng.normal(scale=0.8, size=400) > 0.3).astype(float)
    n0, n1 = int((y == 0).sum()), int((y == 1).sum())
    cw = logistic.inverse_frequency(n0, n1)
    rows = [(float(a), float(b), float(t)) for (a, b), t in zip(X, y)]
    df = spark.createDataFrame(rows, "x1 double, x2 double, label double").withColumn(
        "cw", logistic.class_weight_col(cw)
    )
    reg = 0.1
    runs = logistic.gradient_descent(df.coalesce(1), ["x1", "x2"], [(2.0, reg)], max_iter=150, tol=1e-13,
                                     weight_col="cw")
    lr = LogisticRegression(featuresCol="f", labelCol="label", weightCol="cw", regParam=reg,
                            elasticNetParam=0.0, standardization=False, tol=1e-12, maxIter=500)
    model = lr.fit(VectorAssembler(inputCols=["x1", "x2"], outputCol="f").transform(df))
    ref = [model.intercept] + list(model.coefficients.toArray())
    # Σ class weights = n, so both minimise the same weighted mean log-loss + ½·reg·‖β‖²
    assert np.allclose(runs[0].weights, ref, atol=2e-4), (runs[0].weights, ref)


def test_sgd_rules_match_rdd_based_trainer(spark):
    from pyspark.mllib.classification import LogisticRegressionWithSGD
    from pyspark.mllib.regression import LabeledPoint

    rng = np.random.default_rng(6)
    X = rng.normal(size=(300, 3))
    y = (X[:, 0] - X[:, 2] + rng.normal(scale=0.5, size=300) > 0).astype(float)
    rows = [(float(a), float(b), float(c), float(t)) for (a, b, c), t in zip(X, y)]
    df = spark.createDataFrame(rows, "x1 double, x2 double, x3 double, label double")
    rdd = spark.sparkContext.parallelize([LabeledPoint(t, [a, b, c]) for a, b, c, t in rows], 4)
    for iterations, step in ((20, 0.5), (60, 0.1)):
        model = LogisticRegressionWithSGD.train(rdd, iterations=iterations, step=step)
        ours = logistic.sgd_fit(df, ["x1", "x2", "x3"], [(iterations, step)])[0]
        assert np.allclose(ours.weights[1:], model.weights.toArray(), atol=1e-9)
        assert model.intercept == 0.0 and ours.weights[0] == 0.0


def test_tree_matches_spark_decision_tree_with_equal_candidates(spark):
    from pyspark.ml.regression import DecisionTreeRegressor

    from quarry.operators import tree as T

    rng = np.random.default_rng(8)
    a = rng.integers(0, 10, size=600).astype(float)
    b = rng.integers(0, 6, size=600).astype(float)
    y = 10 * (a > 4) + 5 * (b > 2) + 3 * (a > 7) * (b < 2) + rng.normal(scale=1.0, size=600)
    rows = [(float(i), float(j), float(t)) for i, j, t in zip(a, b, y)]
    df = spark.createDataFrame(rows, "a double, b double, y double")
    mids = {c: [(v + w) / 2 for v, w in zip(range(n - 1), range(1, n))] for c, n in (("a", 10), ("b", 6))}
    ours = T.fit_tree(df, ["a", "b"], "y", thresholds=mids, max_depth=3, min_node=1, min_side=5, gain_factor=1.0)
    dt = DecisionTreeRegressor(featuresCol="f", labelCol="y", maxDepth=3, minInstancesPerNode=5, maxBins=32)
    model = dt.fit(VectorAssembler(inputCols=["a", "b"], outputCol="f").transform(df))
    theirs = model.transform(VectorAssembler(inputCols=["a", "b"], outputCol="f").transform(df))
    mine = ours.predict(df)
    a_rows = sorted((r["a"], r["b"], round(r["prediction"], 9)) for r in mine.collect())
    b_rows = sorted((r["a"], r["b"], round(r["prediction"], 9)) for r in theirs.collect())
    assert a_rows == b_rows
    assert len([n for n in ours.nodes.values() if n.is_leaf]) == model.numNodes - (model.numNodes - 1) // 2
