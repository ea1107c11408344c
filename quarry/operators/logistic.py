"""Class-weighted logistic regression by full-batch gradient descent.

One Spark job per iteration, for *all* hyper-parameter configurations at
once: the weights of every still-running configuration enter the plan as
literals, each row's probability, weighted error and loss are projected once
per configuration, and a single global aggregate (partial per task, then a
one-row final merge) returns ``Σe``, ``Σe·x_i`` and ``Σloss``.  The driver
only updates a few floats.  Every iteration reads the same materialised
training frame with new literals, so plans never grow with the loop.

Rules kept from the reference:

* gradient = mean of ``cw·(p−y)·x`` plus ``reg·w`` (bias excluded);
* loss = mean of ``−cw·log(p+ε)`` / ``−cw·log(1−p+ε)`` plus
  ``½·reg·Σw²`` (bias excluded), taken *before* the update;
* the update is applied, then the loop stops when |loss − previous| < tol;
* sigmoid clamps at ±500; class weights ``n/(2·n_c)``, or 1.0 for both when
  a class is missing; labels other than 0/1 get weight 1.0.
"""

from __future__ import annotations

import math
import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.functions.columns import linear, sigmoid
from quarry.operators.split import batch_member

# Fixed value: log-loss epsilon of the reference.
LOSS_EPSILON = 1e-9


# ----------------------------------------------------------------- weights
def class_counts(df: DataFrame, label: str = "label") -> tuple[int, int]:
    row = df.agg(
        F.count_if(F.col(label) == 0.0).alias("n0"), F.count_if(F.col(label) == 1.0).alias("n1")
    ).first()
    return int(row["n0"]), int(row["n1"])


def inverse_frequency(n0: int, n1: int) -> dict[float, float]:
    if n0 == 0 or n1 == 0:
        return {0.0: 1.0, 1.0: 1.0}
    total = n0 + n1
    return {0.0: total / (2.0 * n0), 1.0: total / (2.0 * n1)}


def class_weights_frame(df: DataFrame, label: str = "label") -> DataFrame:
    """One row ``n0, n1, w0, w1`` computed entirely in Spark."""
    n0 = F.count_if(F.col(label) == 0.0)
    n1 = F.count_if(F.col(label) == 1.0)
    counted = df.agg(n0.alias("n0"), n1.alias("n1"))
    one_missing = (F.col("n0") == 0) | (F.col("n1") == 0)
    total = (F.col("n0") + F.col("n1")).cast("double")
    return counted.select(
        "n0",
        "n1",
        F.when(one_missing, F.lit(1.0)).otherwise(total / (F.col("n0") * 2.0)).alias("w0"),
        F.when(one_missing, F.lit(1.0)).otherwise(total / (F.col("n1") * 2.0)).alias("w1"),
    )


def class_weight_col(weights: dict[float, float], label: str = "label") -> Column:
    """Label → weight lookup as a literal CASE (default 1.0)."""
    expr = F.lit(1.0)
    for lab, w in sorted(weights.items(), reverse=True):
        expr = F.when(F.col(label) == F.lit(float(lab)), F.lit(float(w))).otherwise(expr)
    return expr


# ------------------------------------------------------------------ fitting
@dataclass
class GDConfig:
    learning_rate: float
    reg_param: float


@dataclass
class GDRun:
    config: GDConfig
    weights: list[float]
    history: list[tuple[int, float, float, float]] = field(default_factory=list)
    converged: bool = False
    done: bool = False
    previous_loss: float = math.inf


def probability(weights: Sequence[float], features: Sequence[str]) -> Column:
    return sigmoid(linear(weights, features))


def _loss_term(p: Column, y: Column, cw: Column) -> Column:
    return F.when(y == 1.0, -cw * F.log(p + LOSS_EPSILON)).otherwise(
        -cw * F.log(F.lit(1.0) - p + LOSS_EPSILON)
    )


def batch_sums(
    base: DataFrame, features: Sequence[str], weight_vectors: Sequence[Sequence[float]], method: str = "columns"
) -> tuple[int, list[list[float]], list[float]]:
    """The pass the caller names, at every size: ``columns`` (generated code,
    for a few vectors of a few features) or ``arrow`` (matrix products over
    Arrow batches, for grids and wide rows)."""
    if method not in ("columns", "arrow"):
        raise ValueError(f"unknown method {method!r}")
    return (batch_sums_arrow if method == "arrow" else batch_sums_columns)(base, features, weight_vectors)


def batch_sums_arrow(
    base: DataFrame, features: Sequence[str], weight_vectors: Sequence[Sequence[float]]
) -> tuple[int, list[list[float]], list[float]]:
    """Same sums as ``batch_sums_columns`` for wide models: each Arrow batch
    does ``E = cw·(σ(X·Wᵀ) − y)`` and ``Eᵀ·X`` in numpy, each task emits one
    small partial table, and a grouped sum over ``(vector, slot)`` merges
    them.  The weight matrix (configurations × features) is the only thing
    shipped to the tasks."""
    import numpy as np
    import pandas as pd

    W = np.asarray(weight_vectors, dtype=float)
    k, d1 = W.shape
    feats = list(features)

    def partial(batches):
        g = np.zeros((k, d1))
        loss = np.zeros(k)
        n = 0
        for pdf in batches:
            if pdf.empty:
                continue
            x = np.hstack([np.ones((len(pdf), 1)), pdf[feats].to_numpy(dtype=float)])
            y = pdf["_y"].to_numpy(dtype=float)[:, None]
            cw = pdf["_cw"].to_numpy(dtype=float)[:, None]
            z = x @ W.T
            p = np.where(z < -500.0, 0.0, np.where(z > 500.0, 1.0, 1.0 / (1.0 + np.exp(-np.clip(z, -500.0, 500.0)))))
            e = cw * (p - y)
            g += e.T @ x
            loss += np.where(y == 1.0, -cw * np.log(p + LOSS_EPSILON), -cw * np.log(1.0 - p + LOSS_EPSILON)).sum(0)
            n += len(pdf)
        ks = np.repeat(np.arange(k), d1 + 1)
        slots = np.tile(np.arange(d1 + 1), k)
        vals = np.hstack([g, loss[:, None]]).ravel()
        yield pd.DataFrame(
            {"k": np.append(ks, -1).astype("int32"), "i": np.append(slots, -1).astype("int32"),
             "v": np.append(vals, float(n))}
        )

    rows = (
        base.select(*feats, "_y", "_cw")
        .mapInPandas(partial, "k int, i int, v double")
        .groupBy("k", "i")
        .agg(F.sum("v").alias("v"))
        .collect()
    )
    got = {(r["k"], r["i"]): r["v"] for r in rows}
    n = int(got.get((-1, -1), 0.0))
    grads = [[got.get((j, i), 0.0) for i in range(d1)] for j in range(k)]
    losses = [got.get((j, d1), 0.0) for j in range(k)]
    return n, grads, losses


def batch_sums_columns(
    base: DataFrame, features: Sequence[str], weight_vectors: Sequence[Sequence[float]]
) -> tuple[int, list[list[float]], list[float]]:
    """One pass over ``base(features…, _y, _cw)`` for many weight vectors.

    Returns ``n``, per vector ``[Σe, Σe·x_1, …]`` with ``e = cw·(p − y)``, and
    per vector ``Σ loss``.  Probabilities are projected once per vector, then
    a single global aggregate (partial per task, one-row final merge) sums
    everything — one Spark job regardless of the number of vectors.
    """
    row = sums_frame(base, features, weight_vectors).first()
    d = len(features)
    grads = [[row[f"g{k}_{i}"] or 0.0 for i in range(d + 1)] for k in range(len(weight_vectors))]
    losses = [row[f"loss{k}"] or 0.0 for k in range(len(weight_vectors))]
    return int(row["n"]), grads, losses


def sums_frame(base: DataFrame, features: Sequence[str], weight_vectors: Sequence[Sequence[float]]) -> DataFrame:
    """The one-row aggregate behind ``batch_sums_columns``."""
    proj = [F.col(c) for c in features] + [F.col("_y"), F.col("_cw")]
    for k, w in enumerate(weight_vectors):
        proj.append(probability(w, features).alias(f"_p{k}"))
    scored = base.select(*proj)
    errs = []
    for k in range(len(weight_vectors)):
        p = F.col(f"_p{k}")
        errs.append((F.col("_cw") * (p - F.col("_y"))).alias(f"_e{k}"))
        errs.append(_loss_term(p, F.col("_y"), F.col("_cw")).alias(f"_l{k}"))
    scored = scored.select(*[F.col(c) for c in features], *errs)
    aggs = [F.count(F.lit(1)).alias("n")]
    for k in range(len(weight_vectors)):
        e = F.col(f"_e{k}")
        aggs.append(F.sum(e).alias(f"g{k}_0"))
        aggs += [F.sum(e * F.col(c)).alias(f"g{k}_{i + 1}") for i, c in enumerate(features)]
        aggs.append(F.sum(f"_l{k}").alias(f"loss{k}"))
    return scored.agg(*aggs)


def _training_base(train: DataFrame, features: Sequence[str], label: str, weight_col, key: Column | None = None) -> DataFrame:
    cw = F.lit(1.0) if weight_col is None else (
        F.col(weight_col) if isinstance(weight_col, str) else weight_col
    )
    keys = [] if key is None else [key.cast("string").alias("_key")]
    return train.select(*[F.col(c) for c in features], F.col(label).alias("_y"), cw.alias("_cw"), *keys)


def gradient_descent(
    train: DataFrame,
    features: Sequence[str],
    configs: Sequence[tuple[float, float]],
    max_iter: int = 30,
    tol: float = 1e-4,
    label: str = "label",
    weight_col: str | Column | None = None,
    initial: Sequence[float] | None = None,
    method: str = "columns",
    sums: Callable[[Sequence[Sequence[float]]], tuple[int, list[list[float]], list[float]]] | None = None,
) -> list[GDRun]:
    """Fit one weight vector per ``(learning_rate, reg_param)`` in one loop.

    ``train`` should already be materialised (``quarry.materialize``).
    ``weight_col`` is the per-row class weight (default 1.0).  ``method``
    picks the per-iteration pass, ``columns`` or ``arrow`` (see ``batch_sums``);
    ``sums`` replaces it by another pass over the same rows (``dense``).
    """
    d = len(features)
    init = list(initial) if initial is not None else [0.0] * (d + 1)
    runs = [GDRun(GDConfig(lr, reg), list(init)) for lr, reg in configs]
    if sums is None:
        base = _training_base(train, features, label, weight_col)

        def sums(vectors):
            return batch_sums(base, features, vectors, method)

    for it in range(max_iter):
        active = [r for r in runs if not r.done]
        if not active:
            break
        start = time.time()
        n, grads, losses = sums([r.weights for r in active])
        elapsed = time.time() - start
        if n == 0:
            for r in active:
                r.done = True
            break
        for k, r in enumerate(active):
            w = r.weights
            reg = r.config.reg_param
            grad = [grads[k][0] / n] + [grads[k][i] / n + reg * w[i] for i in range(1, d + 1)]
            loss = losses[k] / n + sum(0.5 * reg * w[i] ** 2 for i in range(1, d + 1))
            r.weights = [w[i] - r.config.learning_rate * grad[i] for i in range(d + 1)]
            change = abs(loss - r.previous_loss)
            r.history.append((it + 1, loss, change, elapsed))
            if change < tol:
                r.converged = True
                r.done = True
            r.previous_loss = loss
    return runs


def sgd_fit(
    train: DataFrame,
    features: Sequence[str],
    configs: Sequence[tuple[int, float]],
    reg_param: float = 0.01,
    tol: float = 1e-3,
    label: str = "label",
    method: str = "columns",
    mini_batch_fraction: float = 1.0,
    seed: int = 42,
    key: Column | None = None,
    sums: Callable[[int, Sequence[Sequence[float]]], tuple[int, list[list[float]], list[float]]] | None = None,
) -> list[GDRun]:
    """Logistic regression with the rules of Spark's RDD-based SGD trainer
    (I14), as DataFrame aggregations: no intercept, step ``step/√t`` at
    iteration ``t``, L2 updater ``w ← w·(1 − η·reg) − η·ĝ``, stop after
    ``iterations`` or when ``‖Δw‖ < tol·max(‖w‖, 1)``.

    ``mini_batch_fraction < 1`` averages each step's gradient over the rows
    whose hash of (seed, step, ``key``) falls below it: the same rows whatever
    the partitions, retries or engine.  Without a ``key`` the row's own values
    are it, so equal rows go together.  A step without rows is skipped, as in
    the RDD trainer.  ``sums`` replaces the pass of a step, from 1, by another
    over the same batch (``dense.batch_loss_sums``).

    ``configs`` are ``(iterations, step)`` pairs, all fitted in one loop.
    Returned weights carry a leading 0.0 bias so scoring is shared.
    """
    d = len(features)
    runs = [GDRun(GDConfig(step, reg_param), [0.0] * (d + 1)) for _, step in configs]
    limits = [int(it) for it, _ in configs]
    if sums is None:
        if mini_batch_fraction < 1.0 and key is None:
            key = F.concat_ws("|", *[F.col(c).cast("string") for c in [*features, label]])
        base = _training_base(train, features, label, None, key if mini_batch_fraction < 1.0 else None)

        def sums(t, vectors):
            batch = base if mini_batch_fraction >= 1.0 else base.filter(batch_member(F.col("_key"), mini_batch_fraction, seed, t))
            return batch_sums(batch, features, vectors, method)

    for t in range(1, max(limits) + 1):
        active = [(k, r) for k, r in enumerate(runs) if not r.done and t <= limits[k]]
        if not active:
            break
        start = time.time()
        n, grads, losses = sums(t, [r.weights for _, r in active])
        elapsed = time.time() - start
        if n == 0:
            if mini_batch_fraction < 1.0:
                continue
            break
        for j, (k, r) in enumerate(active):
            eta = r.config.learning_rate / math.sqrt(t)
            old = r.weights
            new = [0.0] + [
                old[i] * (1.0 - eta * reg_param) - eta * grads[j][i] / n for i in range(1, d + 1)
            ]
            r.weights = new
            diff = math.sqrt(sum((a - b) ** 2 for a, b in zip(new[1:], old[1:])))
            norm = math.sqrt(sum(a * a for a in new[1:]))
            r.history.append((t, losses[j] / n, diff, elapsed))
            if t > 1 and diff < tol * max(norm, 1.0):
                r.converged = True
                r.done = True
            if t >= limits[k]:
                r.done = True
    return runs


def history_frame(spark: SparkSession, runs: Sequence[GDRun]) -> DataFrame:
    """Iteration history (I23), one row per configuration and iteration."""
    rows = [
        (i, r.config.learning_rate, r.config.reg_param, it, float(loss), float(change), float(sec))
        for i, r in enumerate(runs)
        for it, loss, change, sec in r.history
    ]
    schema = (
        "config_index int, learning_rate double, reg_param double, iteration int, "
        "loss double, loss_change double, seconds double"
    )
    return spark.createDataFrame(rows, schema)


def score(df: DataFrame, weights: Sequence[float], features: Sequence[str], output: str = "p") -> DataFrame:
    """Batch scoring (I3): probability column from literal weights."""
    return df.withColumn(output, probability(weights, features))


def coefficient_frame(spark: SparkSession, weights: Sequence[float], features: Sequence[str]) -> DataFrame:
    """``(feature, coefficient)`` with the bias as ``intercept`` (I16)."""
    rows = [("intercept", float(weights[0]))] + [
        (f, float(w)) for f, w in zip(features, weights[1:])
    ]
    return spark.createDataFrame(rows, "feature string, coefficient double")
