"""Classification queries: the flagship fraud report, gradient descent and
its grid (I1–I3, I23, F4), evaluation (D19, I4–I7, I15), Spark ML L-BFGS
(I13, I16) and the SGD rules (I14).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.catalog.common import _clean_fraud, fit_fraud_model, query, rounded
from quarry.functions.columns import threshold as hard_threshold
from quarry.functions.scale import fit_std
from quarry.operators import clean, curves, evaluate, library, logistic
from quarry.operators.split import materialized_split
from quarry.session import release
from quarry.sources import fixtures as fx


def _fraud_report(spark: SparkSession, sf_dir: str, wide: bool) -> DataFrame:
    runs, mm, test, n_train = fit_fraud_model(spark, sf_dir, wide=wide)
    run = runs[0]
    w = run.weights
    scored = logistic.score(mm.transform(test), w, fx.FRAUD_FEATURES_WIDE if wide else fx.FRAUD_FEATURES)
    report = evaluate.confusion(scored, "p", "label", 0.5)
    extra = [
        F.lit(n_train).cast("bigint").alias("n_train"),
        F.lit(len(run.history)).cast("bigint").alias("iterations"),
        (F.lit(float(run.history[-1][1])) if run.history else F.lit(None).cast("double")).alias("final_loss"),
    ] + [F.lit(float(v)).alias(f"w{i}") for i, v in enumerate(w)]
    return rounded(report.select("*", *extra))


@query
def fraud_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean, split, scale, weight, fit by gradient descent, report at 0.5."""
    return _fraud_report(spark, sf_dir, wide=False)


@query
def fraud_report_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flagship with the price as a fourth feature: rows stay nearly
    unique, so de-duplication, the split and every iteration scale with
    ``lineitem`` (the benchmark variant of FIXTURES §3)."""
    return _fraud_report(spark, sf_dir, wide=True)


# The reference's (learning rate × regularisation) grid.
GRID_LR = (0.01, 0.1, 0.5)


GRID_REG = (0.001, 0.01, 0.1)


@query
def gd_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """I1 + I23: loss and loss change per iteration of the flagship fit."""
    runs, _, _, _ = fit_fraud_model(spark, sf_dir)
    hist = logistic.history_frame(spark, runs)
    return rounded(hist.select("config_index", "learning_rate", "reg_param",
                               F.col("iteration").cast("bigint").alias("iteration"), "loss", "loss_change"))


def _gd_grid_best(spark: SparkSession, sf_dir: str, wide: bool) -> DataFrame:
    configs = [(lr, reg) for lr in GRID_LR for reg in GRID_REG]
    runs, mm, test, _ = fit_fraud_model(spark, sf_dir, configs=configs, wide=wide, method="arrow")
    feats = fx.FRAUD_FEATURES_WIDE if wide else fx.FRAUD_FEATURES
    stest = mm.transform(test)
    # One row a test row with the array of its nine scores.
    scored = stest.select(
        F.array(*[logistic.probability(r.weights, feats) for r in runs]).alias("scores"), "label", fx.fraud_row_key(wide).alias("key")
    )
    aucs = curves.rank_models(scored, len(runs))
    best = aucs.orderBy(F.desc_nulls_last("auc"), F.asc("config_index")).limit(1)
    lr_col = F.element_at(F.array(*[F.lit(float(c[0])) for c in configs]), F.col("config_index") + 1)
    reg_col = F.element_at(F.array(*[F.lit(float(c[1])) for c in configs]), F.col("config_index") + 1)
    return rounded(best.select(F.col("config_index").cast("bigint").alias("config_index"),
                               lr_col.alias("learning_rate"), reg_col.alias("reg_param"), "auc"))


@query
def gd_grid_best(spark: SparkSession, sf_dir: str) -> DataFrame:
    """I2 + F4: 3×3 (learning rate, reg) grid fitted in one loop (one job per
    iteration for all nine), AUC (reference rule) on the test part, first
    best wins."""
    return _gd_grid_best(spark, sf_dir, wide=False)


@query
def gd_grid_best_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The grid on the four-feature fixture, whose rows stay nearly unique,
    so every iteration of all nine configurations grows with ``lineitem``."""
    return _gd_grid_best(spark, sf_dir, wide=True)


def _scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.scored_fraud(spark, sf_dir)


@query
def confusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D19 + I3 + I4 + H15: report at threshold 0.5."""
    return rounded(evaluate.confusion(_scored(spark, sf_dir)))


@query
def threshold_sweep(spark: SparkSession, sf_dir: str) -> DataFrame:
    """I4 sweep over 0.1, 0.3, 0.5, 0.7, 0.9 in one pass."""
    return rounded(evaluate.threshold_sweep(_scored(spark, sf_dir)))


@query
def auc_stepwise(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F2 + I5: the reference's AUC, ties ordered by the row key."""
    return rounded(evaluate.auc_stepwise(_scored(spark, sf_dir), fx.fraud_row_key()))


@query
def auc_ties(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tie-aware AUC (equals the area under the exact ROC curve)."""
    return rounded(evaluate.auc_ties(_scored(spark, sf_dir)))


@query
def roc_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(threshold, fpr, tpr) per distinct score."""
    return rounded(evaluate.roc_table(_scored(spark, sf_dir)).select("threshold", "fpr", "tpr"))


@query
def metrics_by_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Precision, recall, F1 and counts per distinct score."""
    return rounded(evaluate.roc_table(_scored(spark, sf_dir)).select("threshold", "tp", "fp", "precision", "recall", "f1"))


@query
def weighted_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """I15 + C1: accuracy and support-weighted precision / recall / F1."""
    pred = _scored(spark, sf_dir).withColumn("prediction", hard_threshold(F.col("p"), 0.5))
    return rounded(evaluate.weighted_metrics(pred))


@query
def lr_lbfgs_coefficients(spark: SparkSession, sf_dir: str) -> DataFrame:
    """I13 + I16: Spark ML L-BFGS logistic regression on standard-scaled
    clean fraud rows; coefficients and intercept as a table."""
    df = _clean_fraud(spark, sf_dir)
    _, lr = library.fit_lr_lbfgs(df, fx.FRAUD_FEATURES)
    return library.coefficients_table(spark, lr, fx.FRAUD_FEATURES)


@query
def lr_lbfgs_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """I6 + I7 + I13: training accuracy, AUC and top-bin precision/recall/F."""
    df = _clean_fraud(spark, sf_dir)
    _, lr = library.fit_lr_lbfgs(df, fx.FRAUD_FEATURES)
    return rounded(library.lr_summary_table(spark, lr))


# The reference's (iterations × step) grid of the SGD trainer.
SGD_ITERATIONS = (50, 100, 200)


SGD_STEPS = (0.01, 0.1, 0.5)


@query
def lr_sgd_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """I14 + I15 + F4: 3×3 (iterations × step) SGD-rule grid in one loop on
    standard-scaled fraud rows; test-part accuracy, support-weighted
    precision/recall/F1, AUC of the hard predictions; best by weighted F1."""


    df = clean.dedup(clean.drop_nulls(fx.fraud(spark, sf_dir)))
    (train, test), stored = materialized_split(df, fx.fraud_row_key(), (0.8, 0.2), seed=42, with_stored=True)
    scaler = fit_std(train, fx.FRAUD_FEATURES)
    strain = scaler.transform(train).select(*fx.FRAUD_FEATURES, "label")
    configs = [(it, st) for it in SGD_ITERATIONS for st in SGD_STEPS]
    runs = logistic.sgd_fit(strain, fx.FRAUD_FEATURES, configs, method="arrow")
    release(stored)  # the test part is read from the checkpoint
    stest = scaler.transform(test)
    preds = stest.select(
        "label",
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(i).alias("config_index"),
                        hard_threshold(logistic.probability(r.weights, fx.FRAUD_FEATURES), 0.5).alias("prediction"),
                    )
                    for i, r in enumerate(runs)
                ]
            )
        ),
    )
    # One grouped pass for all nine reports.
    cells = preds.groupBy("config_index", "label", "prediction").agg(F.count(F.lit(1)).alias("n"))
    rep = evaluate.weighted_metrics_grouped(cells, "config_index")
    its = F.element_at(F.array(*[F.lit(c[0]) for c in configs]), F.col("config_index") + 1)
    steps = F.element_at(F.array(*[F.lit(float(c[1])) for c in configs]), F.col("config_index") + 1)
    iters_run = F.element_at(F.array(*[F.lit(len(r.history)) for r in runs]), F.col("config_index") + 1)
    return rounded(
        rep.select(
            F.col("config_index").cast("bigint").alias("config_index"), its.alias("iterations"),
            iters_run.alias("iterations_run"), steps.alias("step"), "accuracy", "weighted_precision",
            "weighted_recall", "weighted_f1", "auc",
        )
    )
