"""Regression queries: split search and the level-wise tree (D16, F5,
I8–I10, I19, I20), regression metrics (I11, I12), batch scoring (I21,
I22), Spark ML trees and cross-validation (I17–I19), model save/load (A13).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.catalog.common import TREE, fit_trip_tree, query, rounded
from quarry.operators import clean, evaluate, library
from quarry.operators import tree as tree_ops
from quarry.operators.split import hash_split
from quarry.plans.store import Workspace
from quarry.session import release
from quarry.sources import fixtures as fx
from quarry.sources import text


@query
def split_table_level(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D16 + I8: every candidate split of the root with both sides' stats."""
    t = clean.outlier_filter(fx.trips(spark, sf_dir))
    th = tree_ops.feature_thresholds(t, fx.TRIP_FEATURES, TREE["n_thresholds"])
    cands = tree_ops.root_split_table(t, fx.TRIP_FEATURES, "trip_duration", th, TREE["min_side"])
    return rounded(
        cands.select(
            F.col("feature_index").cast("bigint").alias("feature_index"), "threshold", "left_n", "right_n",
            (F.col("mse") / F.col("node_variance")).alias("variance_share"), "valid",
        ),
        6,
    )


@query
def best_split_one_node(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F5 + I8: the accepted root split (empty when the gate rejects all)."""
    t = clean.outlier_filter(fx.trips(spark, sf_dir))
    th = tree_ops.feature_thresholds(t, fx.TRIP_FEATURES, TREE["n_thresholds"])
    scored = tree_ops.root_split_table(t, fx.TRIP_FEATURES, "trip_duration", th, TREE["min_side"])
    best = tree_ops.best_splits(scored, TREE["gain_factor"])
    names = F.array(*[F.lit(c) for c in fx.TRIP_FEATURES])
    return rounded(
        best.select(
            F.element_at(names, F.col("feature_index") + 1).alias("feature"), "threshold",
            (F.col("mse") / F.col("node_variance")).alias("variance_share"), "left_n", "right_n",
        )
    )


@query
def tree_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """I9 + I20 + A13: the fitted tree as a node table."""
    tree, _, _ = fit_trip_tree(spark, sf_dir)
    nodes = tree.node_table(spark)
    return rounded(nodes.withColumn("impurity", F.round("impurity", 2)).withColumn("depth", F.col("depth").cast("bigint")))


@query
def tree_importances(spark: SparkSession, sf_dir: str) -> DataFrame:
    """I19 for the level-wise tree: variance reduction per feature, summing
    to 1 (computed from the node table, no pass over rows)."""
    tree, _, _ = fit_trip_tree(spark, sf_dir)
    imp = tree_ops.feature_importance(tree)
    rows = [(f, float(imp[f])) for f in fx.TRIP_FEATURES]
    return rounded(spark.createDataFrame(rows, "feature string, importance double"))


@query
def tree_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Validation rows scored by the fitted tree (nested CASE)."""
    tree, _, valid = fit_trip_tree(spark, sf_dir)
    return rounded(tree.predict(valid).select("id", "trip_duration", "prediction"))


@query
def regression_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H16 + I11 + I12: MSE, RMSE, MAE, R² of the fitted tree on validation."""
    tree, _, valid = fit_trip_tree(spark, sf_dir)
    m = evaluate.regression_metrics(tree.predict(valid), "prediction", "trip_duration")
    return rounded(m, 4)


@query
def regression_metrics_fixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """I11 + I12 on trips scored by a fixed two-level rule (no fitting)."""
    return rounded(evaluate.regression_metrics(fx.scored_trips(spark, sf_dir), "prediction", "trip_duration"), 4)


@query
def batch_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """I21 + I22: fit on parsed train lines (80 % by id), score the parsed
    test lines, emit ``(id, trip_duration)`` (the regression job)."""
    from quarry.plans.jobs import regression_job

    scored = regression_job(
        spark, fx.trip_lines(spark, sf_dir), fx.trip_lines(spark, sf_dir, test=True),
        fx.TRIP_HEADER, fx.TRIP_TEST_HEADER, tree_params=TREE,
    )
    return rounded(scored)


@query
def dt_importances(spark: SparkSession, sf_dir: str) -> DataFrame:
    """I17 + I19: Spark ML tree (depth 5, seed 42) importances by feature."""
    from quarry.plans.jobs import TRIP_MODEL_FEATURES, split_and_prepare

    (train, _), _, stored = split_and_prepare(fx.trips(spark, sf_dir))
    model = library.fit_tree_regressor(train, TRIP_MODEL_FEATURES, "trip_duration")
    release(stored)
    return rounded(library.importances_table(spark, model, TRIP_MODEL_FEATURES))


@query
def dt_deep_rmse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """I17 + A13 + I11: the RDD-era library tree (depth 20, 32 bins, variance)
    on the six positional features of the parsed train lines, 70/30 key
    split; the model is saved, loaded back and scored on the 30 %."""
    from pyspark.ml.regression import DecisionTreeRegressor

    lines = text.drop_header(fx.trip_lines(spark, sf_dir), fx.TRIP_HEADER)
    parsed = text.accepted(text.parse_trip_train(lines, filters=False))
    # the unfiltered parse lets the text ``nan`` through as a number
    parsed = library.complete_rows(parsed, [*fx.TRIP_FEATURES, "trip_duration"])
    train, valid = hash_split(parsed, F.col("id"), (0.7, 0.3), seed=42)
    dt = DecisionTreeRegressor(featuresCol="features", labelCol="trip_duration", maxDepth=20, maxBins=32,
                               impurity="variance", seed=42)
    model = dt.fit(library.assemble(train, fx.TRIP_FEATURES))
    with Workspace(spark, "dt-deep") as work:
        library.save_tree_model(model, work.path("model"))
        loaded = library.load_tree_model(work.path("model"))
    pred = loaded.transform(library.assemble(valid, fx.TRIP_FEATURES))
    return rounded(evaluate.regression_metrics(pred, "prediction", "trip_duration"), 4)


@query
def dt_cv_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """maxDepth {5,7,10} × minInstancesPerNode {1,10,50}, 3 folds, RMSE."""
    from quarry.plans.jobs import TRIP_MODEL_FEATURES, split_and_prepare

    # 27 fits + a refit read one stored copy of the prepared training rows
    (train, _), _, stored = split_and_prepare(fx.trips(spark, sf_dir))
    _, table = library.cross_validate_tree(train, TRIP_MODEL_FEATURES, "trip_duration")
    release(stored)
    return rounded(table, 4)


@query
def model_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Our tree saved as a node table, loaded back, scoring validation."""
    tree, _, valid = fit_trip_tree(spark, sf_dir)
    with Workspace(spark, "tree") as work:
        tree.save(spark, work.path("tree"))
        loaded = tree_ops.Tree.from_table(spark.read.parquet(work.path("tree")), fx.TRIP_FEATURES)
    return rounded(loaded.predict(valid).select("id", "prediction"))


@query
def structured_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """I21 + I22: the structured regression job as a whole: preparation with
    the flag index of the training rows, the cross-validated tree, and
    ``(id, trip_duration)`` of every trip scored by the best model, written
    as CSV and read back."""
    from quarry.plans.jobs import structured_regression_job
    from quarry.sources import io as qio

    trips = fx.trips(spark, sf_dir)
    with Workspace(spark, "scored") as work:
        structured_regression_job(trips, trips.drop("trip_duration"), output=work.path("csv"))
        return rounded(qio.read_csv(spark, work.path("csv"), schema="id string, trip_duration double")).checkpoint(eager=True)


@query
def cv_best_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """I18 + I19: the best model of the cross-validation: its parameters,
    validation RMSE and R², and its importances, one row a feature."""
    from quarry.plans.jobs import structured_regression_job

    out = structured_regression_job(fx.trips(spark, sf_dir))
    best = out["cv_grid"].filter("is_best").select("max_depth", "min_instances_per_node")
    return rounded(out["best_importances"].crossJoin(F.broadcast(best)).crossJoin(F.broadcast(out["validation"])), 4)


@query
def tree_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fitted tree as text, one line a row, numbers to 6 places."""
    tree, _, _ = fit_trip_tree(spark, sf_dir)
    lines = tree.debug_string(6).split("\n")
    return spark.createDataFrame(list(enumerate(lines)), "line_no long, line string")
