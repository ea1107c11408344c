"""Evaluation operators.

Counts at fixed thresholds are conditional counts in one aggregate (no join
with a threshold table).  Ordered metrics — the stepwise AUC of the
reference, the tie-aware AUC and the ROC table — use exact running totals
from ``quarry.plans.prefix`` instead of collecting and sorting scores on the
driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.functions.columns import safe_div
from quarry.plans.prefix import running_totals

# Fixed value: the reference's threshold sweep.
SWEEP_THRESHOLDS = (0.1, 0.3, 0.5, 0.7, 0.9)


def _as_col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _report_columns(tp: Column, fp: Column, tn: Column, fn: Column) -> list[Column]:
    total = tp + fp + tn + fn
    precision = safe_div(tp, tp + fp)
    recall = safe_div(tp, tp + fn)
    return [
        safe_div(tp + tn, total).alias("accuracy"),
        precision.alias("precision"),
        recall.alias("recall"),
        F.when(precision + recall == 0, F.lit(0.0))
        .otherwise(2.0 * precision * recall / (precision + recall))
        .alias("f1"),
    ]


def confusion(scored: DataFrame, p: str = "p", label: str = "label", threshold: float = 0.5) -> DataFrame:
    """One row: ``threshold, tp, fp, tn, fn, accuracy, precision, recall, f1``."""
    return threshold_sweep(scored, [threshold], p, label)


def threshold_sweep(
    scored: DataFrame,
    thresholds: Sequence[float] = SWEEP_THRESHOLDS,
    p: str = "p",
    label: str = "label",
) -> DataFrame:
    """Classification report per threshold, all thresholds in one pass."""
    pc, y = _as_col(p), _as_col(label)
    aggs = []
    for i, t in enumerate(thresholds):
        pred = pc >= F.lit(float(t))
        aggs += [
            F.count_if(pred & (y == 1.0)).alias(f"tp{i}"),
            F.count_if(pred & (y == 0.0)).alias(f"fp{i}"),
            F.count_if(~pred & (y == 0.0)).alias(f"tn{i}"),
            F.count_if(~pred & (y == 1.0)).alias(f"fn{i}"),
        ]
    counted = scored.agg(*aggs)
    rows = F.array(
        *[
            F.struct(
                F.lit(float(t)).alias("threshold"),
                F.col(f"tp{i}").alias("tp"),
                F.col(f"fp{i}").alias("fp"),
                F.col(f"tn{i}").alias("tn"),
                F.col(f"fn{i}").alias("fn"),
            )
            for i, t in enumerate(thresholds)
        ]
    )
    out = counted.select(F.inline(rows))
    return out.select(
        "threshold", "tp", "fp", "tn", "fn", *_report_columns(*[F.col(c) for c in ("tp", "fp", "tn", "fn")])
    )


def auc_stepwise(scored: DataFrame, key: Column, p: str = "p", label: str = "label", **kw) -> DataFrame:
    """The reference's AUC: scores descending (ties by ``key``), and at each
    negative add ``(tp + tp_at_previous_negative) / (2·P·N)``.

    Closed form: ``(Σ_neg tp − tp_last_neg / 2) / (P·N)``; 0.0 when a class
    is missing.  One row: ``auc, positives, negatives``.
    """
    g = scored.select(F.lit(0).alias("_g"), _as_col(p).alias("p"), _as_col(label).alias("label"), key.alias("_k"))
    out = auc_stepwise_grouped(g, "_g", F.col("_k"), n_groups=1, **kw)
    # a global aggregate over the (at most one) group row: one row even
    # for empty input, with the reference's 0.0
    return out.agg(
        F.coalesce(F.max("auc"), F.lit(0.0)).alias("auc"),
        F.coalesce(F.max("positives"), F.lit(0)).cast("bigint").alias("positives"),
        F.coalesce(F.max("negatives"), F.lit(0)).cast("bigint").alias("negatives"),
    )


def auc_stepwise_grouped(
    scored: DataFrame, group: str, key: Column, p: str = "p", label: str = "label", n_groups: int | None = None, **kw
) -> DataFrame:
    """``auc_stepwise`` for every value of ``group`` in one ranged pass.

    Identical ``(group, score, key, class)`` rows are first counted (a
    partial aggregate, so a hot duplicate never lands whole in one task);
    running positive counts then follow ``score desc, key asc, positives
    first`` — a unique order, so the range partitioner can balance it.
    """
    pos = F.when(_as_col(label) == 1.0, F.lit(1)).otherwise(F.lit(0))
    g = scored.groupBy(F.col(group), _as_col(p).alias("_p"), key.alias("_k"), pos.alias("_pos")).agg(
        F.count(F.lit(1)).alias("_m")
    )
    ranked = running_totals(
        g,
        order=[F.desc("_p"), F.asc("_k"), F.desc("_pos")],
        values={"pos": F.col("_pos") * F.col("_m")},
        group=[group],
        max_groups=n_groups,
        **kw,
    )
    neg = F.col("_pos") == 0
    # Σ tp over negatives reaches P·N (beyond BIGINT at scale): exact DECIMAL
    exact = "decimal(38,0)"
    agg = ranked.groupBy(group).agg(
        F.sum(F.col("_pos") * F.col("_m")).alias("positives"),
        F.sum(F.when(neg, F.col("_m")).otherwise(0)).alias("negatives"),
        F.sum(F.when(neg, F.col("cum_pos").cast(exact) * F.col("_m").cast(exact))).alias("_sum_tp"),
        F.max(F.when(neg, F.col("cum_pos"))).alias("_last_tp"),
    )
    pn = F.col("positives").cast("double") * F.col("negatives").cast("double")
    auc = F.when((F.col("positives") == 0) | (F.col("negatives") == 0), F.lit(0.0)).otherwise(
        (F.col("_sum_tp").cast("double") - F.col("_last_tp") / 2.0) / pn
    )
    return agg.select(group, auc.alias("auc"), F.col("positives").cast("bigint").alias("positives"),
                      F.col("negatives").cast("bigint").alias("negatives"))


def score_groups(scored: DataFrame, p: str = "p", label: str = "label") -> DataFrame:
    """``(score, pos, neg)`` per distinct score — a partial-aggregated shuffle."""
    y = _as_col(label)
    return scored.groupBy(_as_col(p).alias("score")).agg(
        F.count_if(y == 1.0).alias("pos"), F.count_if(y != 1.0).alias("neg")
    )


def roc_table(scored: DataFrame, p: str = "p", label: str = "label", **kw) -> DataFrame:
    """Per distinct score, descending: cumulative ``tp, fp`` and the rates
    ``tpr (= recall), fpr, precision, f1`` when predicting ``p >= threshold``."""
    groups = score_groups(scored, p, label)
    ranked = running_totals(
        groups, order=[F.desc("score")], values={"tp": F.col("pos"), "fp": F.col("neg")}, **kw
    )
    # Class totals, from the stored groups, enter as literals.
    tot = ranked.agg(F.sum("pos").alias("P"), F.sum("neg").alias("N")).first()
    n_pos, n_neg = F.lit(int(tot["P"] or 0)), F.lit(int(tot["N"] or 0))
    tp, fp = F.col("cum_tp"), F.col("cum_fp")
    precision = safe_div(tp, tp + fp)
    recall = safe_div(tp, n_pos)
    return ranked.select(
        F.col("score").alias("threshold"),
        tp.alias("tp"),
        fp.alias("fp"),
        recall.alias("tpr"),
        safe_div(fp, n_neg).alias("fpr"),
        precision.alias("precision"),
        recall.alias("recall"),
        F.when(precision + recall == 0, F.lit(0.0))
        .otherwise(2.0 * precision * recall / (precision + recall))
        .alias("f1"),
    )


def auc_ties(scored: DataFrame, p: str = "p", label: str = "label", **kw) -> DataFrame:
    """Tie-aware AUC (trapezoids over distinct thresholds = Mann–Whitney with
    ties counted half).  One row: ``auc, positives, negatives``."""
    groups = score_groups(scored, p, label)
    ranked = running_totals(groups, order=[F.desc("score")], values={"tp": F.col("pos")}, **kw)
    agg = ranked.agg(
        F.coalesce(F.sum("pos"), F.lit(0)).alias("positives"),
        F.coalesce(F.sum("neg"), F.lit(0)).alias("negatives"),
        F.sum(F.col("neg") * (F.col("cum_tp") - F.col("pos") / 2.0)).alias("_pairs"),
    )
    pn = F.col("positives").cast("double") * F.col("negatives").cast("double")  # no BIGINT overflow
    auc = F.when(pn == 0, F.lit(0.0)).otherwise(F.col("_pairs") / pn)
    return agg.select(auc.alias("auc"), "positives", "negatives")


def weighted_metrics(pred: DataFrame, prediction: str = "prediction", label: str = "label") -> DataFrame:
    """Accuracy and support-weighted precision / recall / F1.

    ``groupBy(label, prediction)`` is the only pass over rows; the per-class
    arithmetic runs on that small table.
    """
    cells = pred.groupBy(F.lit(0).alias("_g"), F.col(label).alias("label"), F.col(prediction).alias("prediction")).agg(
        F.count(F.lit(1)).alias("n")
    )
    return weighted_metrics_grouped(cells, "_g").drop("_g", "auc")


def weighted_metrics_grouped(cells: DataFrame, group: str) -> DataFrame:
    """Per ``group`` from confusion cells ``(group, label, prediction, n)``:
    accuracy, weighted precision / recall / F1 (Spark's MulticlassMetrics
    definitions, classes = observed labels) and, for 0/1 predictions, the
    area under the ROC of the hard predictions, ``(1 + TPR − FPR) / 2``."""
    y, yhat, n = F.col("label"), F.col("prediction"), F.col("n")
    actual = cells.groupBy(group, y.alias("c")).agg(
        F.sum(n).alias("actual"), F.sum(F.when(y == yhat, n).otherwise(0)).alias("tp")
    )
    predicted = cells.groupBy(group, yhat.alias("c")).agg(F.sum(n).alias("predicted"))
    per_class = actual.join(predicted, [group, "c"], "left").fillna(0, ["predicted"])
    precision = safe_div(F.col("tp"), F.col("predicted"))
    recall = safe_div(F.col("tp"), F.col("actual"))
    f = F.when(precision + recall == 0, F.lit(0.0)).otherwise(2.0 * precision * recall / (precision + recall))
    scored = per_class.select(group, "actual", "tp", precision.alias("pr"), recall.alias("rc"), f.alias("f"))
    total = F.sum("actual")
    rep = scored.groupBy(group).agg(
        (F.sum("tp") / total).alias("accuracy"),
        (F.sum(F.col("pr") * F.col("actual")) / total).alias("weighted_precision"),
        (F.sum(F.col("rc") * F.col("actual")) / total).alias("weighted_recall"),
        (F.sum(F.col("f") * F.col("actual")) / total).alias("weighted_f1"),
        total.alias("n"),
    )
    pos = y == 1.0
    roc = cells.groupBy(group).agg(
        F.sum(F.when(pos & (yhat == 1.0), n).otherwise(0)).alias("_tp"),
        F.sum(F.when(pos, n).otherwise(0)).alias("_P"),
        F.sum(F.when(~pos & (yhat == 1.0), n).otherwise(0)).alias("_fp"),
        F.sum(F.when(~pos, n).otherwise(0)).alias("_N"),
    )
    auc = (F.lit(1.0) + safe_div(F.col("_tp"), F.col("_P")) - safe_div(F.col("_fp"), F.col("_N"))) / 2.0
    return rep.join(roc.select(group, auc.alias("auc")), group)


def regression_metrics(pred: DataFrame, prediction: str = "prediction", label: str = "label") -> DataFrame:
    """``n, mse, rmse, mae, r2`` in one aggregate."""
    err = _as_col(label) - _as_col(prediction)
    agg = pred.agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(err * err).alias("mse"),
        F.avg(F.abs(err)).alias("mae"),
        F.sum(err * err).alias("_sse"),
        F.var_pop(_as_col(label)).alias("_var"),
    )
    r2 = F.when(F.col("_var") == 0, F.lit(0.0)).otherwise(
        F.lit(1.0) - F.col("_sse") / (F.col("_var") * F.col("n"))
    )
    return agg.select("n", "mse", F.sqrt("mse").alias("rmse"), "mae", r2.alias("r2"))
