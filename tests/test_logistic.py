"""Gradient descent (I1, I2, I14) against a numpy transcription of the rules."""

import math

import numpy as np

from quarry.operators import logistic


def numpy_gd(X, y, cw, lr, reg, iters, tol):
    w = np.zeros(X.shape[1] + 1)
    Xb = np.hstack([np.ones((len(X), 1)), X])
    prev = math.inf
    hist = []
    for _ in range(iters):
        z = Xb @ w
        p = np.where(z < -500, 0.0, np.where(z > 500, 1.0, 1 / (1 + np.exp(-np.clip(z, -500, 500)))))
        e = cw * (p - y)
        g = Xb.T @ e / len(X)
        g[1:] += reg * w[1:]
        loss = np.mean(np.where(y == 1, -cw * np.log(p + 1e-9), -cw * np.log(1 - p + 1e-9)))
        loss += 0.5 * reg * np.sum(w[1:] ** 2)
        w = w - lr * g
        change = abs(loss - prev)
        hist.append(loss)
        if change < tol:
            break
        prev = loss
    return w, hist


def _data(spark, n=300, seed=3):
    rng = np.random.default_rng(seed)
    X = rng.normal(size=(n, 3))
    y = (X[:, 0] + 0.5 * X[:, 1] + rng.normal(scale=0.5, size=n) > 1.0).astype(float)
    rows = [(float(a), float(b), float(c), float(t)) for (a, b, c), t in zip(X, y)]
    return X, y, spark.createDataFrame(rows, "x1 double, x2 double, x3 double, label double").repartition(4)


def test_gd_matches_numpy(spark):
    X, y, df = _data(spark)
    n0, n1 = int((y == 0).sum()), int((y == 1).sum())
    cw = logistic.inverse_frequency(n0, n1)
    cwv = np.where(y == 1, cw[1.0], cw[0.0])
    df = df.withColumn("cw", logistic.class_weight_col(cw))
    runs = logistic.gradient_descent(df, ["x1", "x2", "x3"], [(0.5, 0.01)], max_iter=15, tol=1e-6, weight_col="cw")
    w, hist = numpy_gd(X, y, cwv, 0.5, 0.01, 15, 1e-6)
    assert np.allclose(runs[0].weights, w, atol=1e-10)
    assert np.allclose([h[1] for h in runs[0].history], hist, atol=1e-10)


def test_batched_configs_equal_single_runs(spark):
    _, _, df = _data(spark)
    cfgs = [(0.1, 0.001), (0.5, 0.1), (0.01, 0.01)]
    batched = logistic.gradient_descent(df, ["x1", "x2", "x3"], cfgs, max_iter=8, tol=1e-3)
    for cfg, run in zip(cfgs, batched):
        single = logistic.gradient_descent(df, ["x1", "x2", "x3"], [cfg], max_iter=8, tol=1e-3)[0]
        assert np.allclose(single.weights, run.weights, atol=1e-12)
        assert len(single.history) == len(run.history)


def test_class_weights_one_class_missing(spark):
    assert logistic.inverse_frequency(10, 0) == {0.0: 1.0, 1.0: 1.0}
    df = spark.createDataFrame([(0.0,), (0.0,)], "label double")
    row = logistic.class_weights_frame(df).first()
    assert (row["n0"], row["n1"], row["w0"], row["w1"]) == (2, 0, 1.0, 1.0)
    df = spark.createDataFrame([(0.0,), (0.0,), (0.0,), (1.0,)], "label double")
    row = logistic.class_weights_frame(df).first()
    assert math.isclose(row["w0"], 4 / 6) and math.isclose(row["w1"], 2.0)


def test_empty_training_set(spark):
    df = spark.createDataFrame([], "x1 double, label double")
    runs = logistic.gradient_descent(df, ["x1"], [(0.1, 0.0)], max_iter=3)
    assert runs[0].weights == [0.0, 0.0] and runs[0].history == []


def test_sgd_rules_match_numpy(spark):
    X, y, df = _data(spark, n=200, seed=5)
    runs = logistic.sgd_fit(df, ["x1", "x2", "x3"], [(20, 0.5)], reg_param=0.01, tol=1e-3)
    w = np.zeros(3)
    for t in range(1, 21):
        p = 1 / (1 + np.exp(-(X @ w)))
        g = X.T @ (p - y) / len(X)
        eta = 0.5 / math.sqrt(t)
        new = w * (1 - eta * 0.01) - eta * g
        diff = np.linalg.norm(new - w)
        w = new
        if t > 1 and diff < 1e-3 * max(np.linalg.norm(w), 1.0):
            break
    assert np.allclose(runs[0].weights[1:], w, atol=1e-10)
    assert runs[0].weights[0] == 0.0


def test_arrow_path_equals_column_path(spark):
    _, _, df = _data(spark)
    cfgs = [(0.1, 0.001), (0.5, 0.1)]
    a = logistic.gradient_descent(df, ["x1", "x2", "x3"], cfgs, max_iter=6, tol=0.0, method="columns")
    b = logistic.gradient_descent(df, ["x1", "x2", "x3"], cfgs, max_iter=6, tol=0.0, method="arrow")
    for ra, rb in zip(a, b):
        assert np.allclose(ra.weights, rb.weights, atol=1e-12)
        assert np.allclose([h[1] for h in ra.history], [h[1] for h in rb.history], atol=1e-12)


def test_wide_model_switches_to_arrow(spark):
    rng = np.random.default_rng(0)
    d = 30
    X = rng.normal(size=(200, d))
    y = (X[:, 0] > 0).astype(float)
    cols = [f"v{i}" for i in range(d)]
    df = spark.createDataFrame([tuple(map(float, r)) + (float(t),) for r, t in zip(X, y)],
                               ", ".join(f"{c} double" for c in cols) + ", label double")
    cfgs = [(lr, reg) for lr in (0.01, 0.1, 0.5) for reg in (0.001, 0.01, 0.1)]
    runs = logistic.gradient_descent(df, cols, cfgs, max_iter=3, tol=0.0)
    ones = np.ones(len(X))
    for (lr, reg), r in zip(cfgs, runs):
        w, _ = numpy_gd(X, y, ones, lr, reg, 3, 0.0)
        assert np.allclose(r.weights, w, atol=1e-10)


def test_sgd_mini_batches_are_deterministic(spark):
    _, _, df = _data(spark, n=400, seed=8)
    a = logistic.sgd_fit(df, ["x1", "x2", "x3"], [(10, 0.5)], mini_batch_fraction=0.5, tol=0.0)[0]
    b = logistic.sgd_fit(df, ["x1", "x2", "x3"], [(10, 0.5)], mini_batch_fraction=0.5, tol=0.0)[0]
    full = logistic.sgd_fit(df, ["x1", "x2", "x3"], [(10, 0.5)], tol=0.0)[0]
    assert a.weights == b.weights and a.weights != full.weights
    assert len(a.history) == 10
