"""Logistic regression by limited-memory BFGS over distributed sums.

Every step is one pass over the stored rows.  The two-loop recursion over the
last ``history`` pairs of steps and gradient changes gives a direction on the
driver (a few vectors of the model's size); the pass then evaluates loss and
gradient at several step lengths along it at once, so the line search costs no
further pass.  The loss is convex, so its slope along the direction only grows:
of the steps that do not raise the loss, the one with the flattest slope wins.

The objective is the mean (weighted) log-loss plus ``l2 / 2`` times the squared
weights without the intercept; with ``l2 = 0`` and classes that a plane does
not separate it has one optimum, whatever the solver, and ``gradient`` says how
near it the fit came.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.operators.logistic import _training_base, batch_sums

# Step lengths tried along every direction, in one pass.
STEPS = (1.0, 0.5, 2.0, 0.25, 4.0, 0.0625, 16.0)


@dataclass
class LbfgsFit:
    weights: list[float]  # intercept first
    gradient: list[float]
    loss: float
    iterations: int
    rows: int
    converged: bool


def fit(
    train: DataFrame,
    features: Sequence[str],
    label: str = "label",
    weight_col: str | Column | None = None,
    l2: float = 0.0,
    max_iter: int = 100,
    tol: float = 1e-10,
    history: int = 10,
    method: str = "columns",
    sums: Callable[[Sequence[Sequence[float]]], tuple[int, list[list[float]], list[float]]] | None = None,
) -> LbfgsFit:
    """Fit on ``train`` (materialise it first: every step reads it once).
    ``sums`` replaces the pass by another over the same rows (``dense``).

    Stops when the greatest entry of the mean gradient is at most ``tol``, or
    no step along the direction helps any more.  ``method`` names the pass
    (see ``logistic.batch_sums``).  An empty table gives zero weights.
    """
    d = len(features) + 1
    if sums is None:
        base = _training_base(train, features, label, weight_col)

        def sums(vectors):
            return batch_sums(base, features, vectors, method)

    def evaluate(points: Sequence[np.ndarray]) -> tuple[int, list[float], list[np.ndarray]]:
        n, grads, losses = sums([list(map(float, p)) for p in points])
        if not n:
            return 0, [0.0] * len(points), [np.zeros(d)] * len(points)
        penalty = [np.concatenate([[0.0], l2 * p[1:]]) for p in points]
        return (
            n,
            [s / n + 0.5 * l2 * float(p[1:] @ p[1:]) for s, p in zip(losses, points, strict=True)],
            [np.array(g) / n + r for g, r in zip(grads, penalty, strict=True)],
        )

    w = np.zeros(d)
    n, losses, grads = evaluate([w])
    loss, g = losses[0], grads[0]
    pairs: list[tuple[np.ndarray, np.ndarray]] = []
    done = 0
    for done in range(1, max_iter + 1):
        if np.abs(g).max() <= tol:
            done -= 1
            break
        direction = -two_loop(g, pairs)
        points = [w + t * direction for t in STEPS]
        _, losses, grads = evaluate(points)
        # rounding of the sums must not stop the last steps
        allowed = loss + 1e-12 * max(1.0, abs(loss))
        steps = [i for i in range(len(STEPS)) if losses[i] <= allowed and np.isfinite(losses[i])]
        if not steps:
            if not pairs:
                break
            pairs = []  # start again from the steepest descent
            continue
        best = min(steps, key=lambda i: abs(float(grads[i] @ direction)))
        s, y = points[best] - w, grads[best] - g
        stuck = np.abs(grads[best]).max() >= np.abs(g).max() and losses[best] >= loss
        if stuck and np.abs(g).max() <= 1e4 * tol:
            break  # at the limit of the sums' precision
        if float(s @ y) > 1e-300:
            pairs = [*pairs, (s, y)][-history:]
        w, loss, g = points[best], losses[best], grads[best]
    return LbfgsFit(w.tolist(), g.tolist(), float(loss), done, n, bool(np.abs(g).max() <= tol))


def two_loop(gradient: np.ndarray, pairs: Sequence[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """The inverse Hessian's estimate from the pairs, times the gradient."""
    q, kept = gradient.copy(), []
    for s, y in reversed(pairs):
        a = float(s @ q) / float(s @ y)
        q -= a * y
        kept.append(a)
    if pairs:
        s, y = pairs[-1]
        q *= float(s @ y) / float(y @ y)
    for (s, y), a in zip(pairs, reversed(kept), strict=True):
        q += (a - float(y @ q) / float(s @ y)) * s
    return q


def coefficient_frame(spark: SparkSession, found: LbfgsFit, features: Sequence[str]) -> DataFrame:
    """``(feature, coefficient, gradient)``, the intercept as ``intercept``."""
    names = ["intercept", *features]
    return spark.createDataFrame(list(zip(names, found.weights, found.gradient, strict=True)), "feature string, coefficient double, gradient double")
