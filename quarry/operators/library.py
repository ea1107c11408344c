"""Spark ML estimators the reference calls directly.

Thin, typed wrappers: they assemble vectors, fit, and return *tables*
(coefficients, importances, cross-validation results) instead of printing.
Fitting is Spark ML's own distributed code (L-BFGS aggregation, tree level
statistics); ``CrossValidator`` gets ``parallelism`` so fold fits overlap.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.regression import DecisionTreeRegressionModel, DecisionTreeRegressor
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The reference's cross-validation grid.
CV_MAX_DEPTH = (5, 7, 10)
CV_MIN_INSTANCES = (1, 10, 50)
CV_FOLDS = 3


def assemble(df: DataFrame, features: Sequence[str], output: str = "features") -> DataFrame:
    """Feature vectors; a NULL or NaN feature raises (see ``complete_rows``)."""
    return VectorAssembler(inputCols=list(features), outputCol=output, handleInvalid="error").transform(df)


def complete_rows(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The rows without NULL or NaN in ``columns`` (an explicit cleaning step)."""
    bad = F.lit(False)
    for c in columns:
        bad = bad | F.col(c).isNull() | F.isnan(F.col(c).cast("double"))
    return df.filter(~bad)


def scale_vectors(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """``features`` and ``scaledFeatures`` vectors (unit deviation, not centred)."""
    scaler = StandardScaler(inputCol="features", outputCol="scaledFeatures", withStd=True, withMean=False)
    assembled = assemble(df, features)
    return scaler.fit(assembled).transform(assembled)


def fit_lr_lbfgs(df: DataFrame, features: Sequence[str], label: str = "label"):
    """Standard-scale (no centring) then L-BFGS logistic regression with
    Spark's defaults.  Returns ``(pipeline_model, lr_model)``."""
    pipe = Pipeline(
        stages=[
            VectorAssembler(inputCols=list(features), outputCol="features"),
            StandardScaler(inputCol="features", outputCol="scaledFeatures", withStd=True, withMean=False),
            LogisticRegression(featuresCol="scaledFeatures", labelCol=label, predictionCol="prediction"),
        ]
    )
    model = pipe.fit(df)
    return model, model.stages[-1]


def coefficients_table(spark: SparkSession, lr_model, features: Sequence[str]) -> DataFrame:
    rows = [("intercept", float(lr_model.intercept))] + [
        (f, float(c)) for f, c in zip(features, lr_model.coefficients.toArray())
    ]
    return spark.createDataFrame(rows, "feature string, coefficient double")


def lr_summary_table(spark: SparkSession, lr_model) -> DataFrame:
    """Training summary as the reference prints it: accuracy, AUC, and the
    precision / recall / F-measure of the *highest* threshold bin."""
    s = lr_model.summary
    top_p = s.precisionByThreshold.orderBy(F.desc("threshold")).first()
    top_r = s.recallByThreshold.orderBy(F.desc("threshold")).first()
    top_f = s.fMeasureByThreshold.orderBy(F.desc("threshold")).first()
    row = (
        float(s.accuracy),
        float(s.areaUnderROC),
        float(top_p["threshold"]),
        float(top_p["precision"]),
        float(top_r["recall"]),
        float(top_f["F-Measure"]),
    )
    return spark.createDataFrame(
        [row], "accuracy double, auc double, top_threshold double, precision double, recall double, f1 double"
    )


def fit_tree_regressor(df: DataFrame, features: Sequence[str], label: str, max_depth: int = 5, seed: int = 42):
    dt = DecisionTreeRegressor(
        featuresCol="features", labelCol=label, maxDepth=max_depth, impurity="variance", seed=seed
    )
    return dt.fit(assemble(df, features))


def importances_table(spark: SparkSession, model, features: Sequence[str]) -> DataFrame:
    rows = [(f, float(v)) for f, v in zip(features, model.featureImportances.toArray())]
    return spark.createDataFrame(rows, "feature string, importance double")


def cross_validate_tree(
    df: DataFrame,
    features: Sequence[str],
    label: str,
    max_depths: Sequence[int] = CV_MAX_DEPTH,
    min_instances: Sequence[int] = CV_MIN_INSTANCES,
    folds: int = CV_FOLDS,
    parallelism: int = 4,
    seed: int = 42,
):
    """Grid × k-fold cross-validation on RMSE; returns ``(cv_model, table)``."""
    dt = DecisionTreeRegressor(featuresCol="features", labelCol=label, impurity="variance", seed=seed)
    grid = (
        ParamGridBuilder().addGrid(dt.maxDepth, list(max_depths)).addGrid(dt.minInstancesPerNode, list(min_instances)).build()
    )
    ev = RegressionEvaluator(labelCol=label, predictionCol="prediction", metricName="rmse")
    cv = CrossValidator(
        estimator=dt, estimatorParamMaps=grid, evaluator=ev, numFolds=folds, seed=seed, parallelism=parallelism
    )
    model = cv.fit(assemble(df, features))
    best = min(range(len(grid)), key=lambda i: (model.avgMetrics[i], i))
    rows = [
        (int(p[dt.maxDepth]), int(p[dt.minInstancesPerNode]), float(m), i == best)
        for i, (p, m) in enumerate(zip(grid, model.avgMetrics))
    ]
    table = df.sparkSession.createDataFrame(
        rows, "max_depth int, min_instances_per_node int, avg_rmse double, is_best boolean"
    )
    return model, table


def save_tree_model(model: DecisionTreeRegressionModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_tree_model(path: str) -> DecisionTreeRegressionModel:
    return DecisionTreeRegressionModel.load(path)
