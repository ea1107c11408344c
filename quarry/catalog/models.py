"""Queries of the fits that have no library behind them: binned trees (I17,
I18), L-BFGS (I13, I16), seeded thresholds (I8), dense rows of 29 features (I1,
D11, D14), mini-batches (I14), ranked models (I2, F2), binned score curves (I6,
I7) and stored preparations (I22, A13).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.catalog.classification import GRID_LR, GRID_REG
from quarry.catalog.common import FRAUD_GD, TREE, query, rounded
from quarry.functions.columns import add_apart, haversine_km, threshold, time_parts
from quarry.functions.scale import fit_minmax, fit_std, fit_string_index, minmax_aggs
from quarry.operators import clean, curves, dense, evaluate, forest, lbfgs, library, logistic, preparation, seeded_tree
from quarry.operators import tree as tree_ops
from quarry.operators.split import hash_bucket, split_index
from quarry.plans.store import Workspace
from quarry.sources import fixtures as fx
from quarry.sources import io as qio

# Fixed value: depth of the reference's deep tree.
DEEP = 20


def _deep_tree(spark: SparkSession, sf_dir: str, work: Workspace):
    """Depth 20, 32 bins, variance, on 70 % of the filtered trips; the other
    rows are binned with the same cuts."""
    trips = clean.outlier_filter(fx.trips(spark, sf_dir)).withColumn("_part", split_index(F.col("id"), (0.7, 0.3), seed=42))
    train = forest.prepare(trips.filter("_part = 0"), fx.TRIP_FEATURES, "trip_duration", work)
    return train, trips.filter("_part = 1"), forest.grow(train, [forest.Spec(DEEP)])[0]


@query
def deep_tree_leaves(spark: SparkSession, sf_dir: str) -> DataFrame:
    """I17 + D16: count and mean of every leaf of the deep tree."""
    with Workspace(spark, "deep") as work:
        data, _, tree = _deep_tree(spark, sf_dir, work)
        return rounded(forest.leaves(spark, data, tree))


@query
def deep_tree_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """I17 + I11 + I12: the deep tree on the 30 % it has not seen."""
    with Workspace(spark, "deep") as work:
        data, rest, tree = _deep_tree(spark, sf_dir, work)
        valid = forest.prepare(rest, data.features, "trip_duration", work, cuts=dict(zip(data.features, data.cuts)), name="valid")
        return work.small(rounded(evaluate.regression_metrics(forest.predict(valid, tree), "prediction", "y"), 4))


@query
def cv_forest_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """I18 + I22: max depth x least node size over 3 stored folds of the
    prepared training rows, all 27 fits grown together as 9 trees."""
    from quarry.plans.jobs import TRIP_MODEL_FEATURES, TripPrep, prepare_trips

    raw = fx.trips(spark, sf_dir).withColumn("_part", split_index(F.col("id"), (0.8, 0.2), seed=42))
    train = raw.filter("_part = 0").drop("_part")
    prepared, _ = prepare_trips(train, TripPrep(fit_string_index(train, "store_and_fwd_flag")))
    with Workspace(spark, "cv") as work:
        fold = hash_bucket(F.col("id"), seed=7) % library.CV_FOLDS
        data = forest.prepare(work.store(prepared, "prepared"), TRIP_MODEL_FEATURES, "trip_duration", work, fold=fold)
        table, _ = forest.cross_validate(data, library.CV_FOLDS, library.CV_MAX_DEPTH, library.CV_MIN_INSTANCES)
        return rounded(table, 4)


# --------------------------------------------------------- seeded thresholds
@query
def seeded_tree_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """I8 + I9: the tree whose thresholds are drawn for every node, as nodes."""
    with Workspace(spark, "seeded") as work:
        data = seeded_tree.prepare(clean.outlier_filter(fx.trips(spark, sf_dir)), fx.TRIP_FEATURES, "trip_duration", work)
        tree = seeded_tree.fit(data, TREE["max_depth"], TREE["min_node"], TREE["min_side"], TREE["gain_factor"])
        nodes = tree.node_table(spark).withColumn("impurity", F.round("impurity", 2)).withColumn("depth", F.col("depth").cast("bigint"))
        return rounded(nodes)


@query
def seeded_split_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """I8 + D16: every candidate of the root and of both its children, each
    node with thresholds of its own."""
    with Workspace(spark, "seeded") as work:
        data = seeded_tree.prepare(clean.outlier_filter(fx.trips(spark, sf_dir)), fx.TRIP_FEATURES, "trip_duration", work)
        tree = seeded_tree.fit(data, 1, TREE["min_node"], TREE["min_side"], TREE["gain_factor"])
        table = seeded_tree.split_table(data, tree, [1], TREE["min_side"])
        if not tree.nodes[1].is_leaf:
            table = table.unionByName(seeded_tree.split_table(data, tree, [2, 3], TREE["min_side"]))
        return rounded(table)


# ------------------------------------------------------------------- L-BFGS
def _lbfgs_fit(spark: SparkSession, sf_dir: str, work: Workspace, split: bool):
    """Scaled clean rows (deviation of the rows trained on, not centred), the
    fit, and the scaled rows it has not seen."""
    feats = fx.FRAUD_FEATURES_WIDE
    clean_rows = clean.dedup(clean.drop_nulls(fx.fraud(spark, sf_dir, wide=True, cut=LBFGS_CUT))).withColumn("key", fx.fraud_row_key(True))
    rows = work.store(clean_rows.withColumn("_part", split_index(F.col("key"), (0.8, 0.2), seed=42)), "rows")
    train = rows.filter("_part = 0") if split else rows
    scaler = fit_std(train, feats)
    scaled = scaler.transform(train)
    found = lbfgs.fit(scaled, feats, sums=dense.loss_sums(dense.pack(scaled, feats, work)))
    return found, scaler.transform(rows.filter("_part = 1"))


# Fixed value: the label's cut of these rows; at 4.0 a plane separates them and
# no optimum exists.
LBFGS_CUT = 1.0


def _coefficients(spark: SparkSession, found: lbfgs.LbfgsFit) -> DataFrame:
    table = lbfgs.coefficient_frame(spark, found, fx.FRAUD_FEATURES_WIDE)
    return table.select("feature", F.round("coefficient", 4).alias("coefficient"), F.round(F.abs("gradient"), 6).alias("gradient"))


@query
def lbfgs_coefficients(spark: SparkSession, sf_dir: str) -> DataFrame:
    """I13 + I16: L-BFGS on all clean rows; the gradient there is 0."""
    with Workspace(spark, "lbfgs") as work:
        return _coefficients(spark, _lbfgs_fit(spark, sf_dir, work, split=False)[0])


@query
def lbfgs_split_coefficients(spark: SparkSession, sf_dir: str) -> DataFrame:
    """I13 + I16 + B11: L-BFGS on the training part."""
    with Workspace(spark, "lbfgs") as work:
        return _coefficients(spark, _lbfgs_fit(spark, sf_dir, work, split=True)[0])


@query
def lbfgs_test_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """I13 + I6 + I15: the test part scored by the model of the training part."""
    with Workspace(spark, "lbfgs") as work:
        found, test = _lbfgs_fit(spark, sf_dir, work, split=True)
        scored = work.store(logistic.score(test, found.weights, fx.FRAUD_FEATURES_WIDE), "scored")
        report = evaluate.confusion(scored, "p", "label", 0.5)
        auc = evaluate.auc_ties(scored)
        return work.small(rounded(report.crossJoin(F.broadcast(auc)), 5))  # a row each


@query
def lbfgs_test_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """I13 + C1: probability and prediction of every row of the test part."""
    with Workspace(spark, "lbfgs") as work:
        found, test = _lbfgs_fit(spark, sf_dir, work, split=True)
        scored = logistic.score(test, found.weights, fx.FRAUD_FEATURES_WIDE)
        return scored.select("key", "label", F.round("p", 4).alias("p"), threshold(F.col("p"), 0.5).alias("prediction")).checkpoint(eager=True)


# ----------------------------------------------------------------------- SGD
def _sgd(spark: SparkSession, sf_dir: str, fraction: float) -> DataFrame:
    """SGD at the trainer's defaults (100 iterations, step 1.0) on the scaled
    training part of the four-feature rows; weights and test metrics.  Steps
    over all rows are aggregates in generated code, over the stored columns alone;
    mini-batches are blocks whose rows are hashed for all steps at once."""
    with Workspace(spark, "sgd") as work:
        key = fx.fraud_row_key(True)
        rows = work.store(
            clean.dedup(clean.drop_nulls(fx.fraud(spark, sf_dir, wide=True))).withColumn("key", key).withColumn("_part", split_index(F.col("key"), (0.8, 0.2), seed=42)),
            "rows",
        )
        feats = fx.FRAUD_FEATURES_WIDE
        scaler = fit_std(rows.filter("_part = 0"), feats)
        train = scaler.transform(rows.filter("_part = 0")).select(*feats, "label", "key")
        if fraction >= 1.0:
            run = logistic.sgd_fit(work.store(train, "train"), feats, [SGD_DEFAULT], tol=1e-3)[0]
        else:
            blocks = dense.pack(train, feats, work, batches=dense.Batches(F.col("key"), fraction, 42, SGD_DEFAULT[0]))
            run = logistic.sgd_fit(train, feats, [SGD_DEFAULT], mini_batch_fraction=fraction, tol=0.0, sums=dense.batch_loss_sums(blocks))[0]
        p = logistic.probability(run.weights, feats)
        pred = scaler.transform(rows.filter("_part = 1")).select("label", threshold(p, 0.5).alias("prediction"))
        extra = [F.lit(len(run.history)).cast("bigint").alias("iterations_run"), *[F.lit(float(w)).alias(f"w{i}") for i, w in enumerate(run.weights[1:], 1)]]
        return work.small(rounded(evaluate.weighted_metrics(pred).select("*", *extra)))


# Iterations and step of the trainer where none are given.
SGD_DEFAULT = (100, 1.0)


@query
def sgd_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    """I14 + I15: the single fit at the trainer's defaults."""
    return _sgd(spark, sf_dir, 1.0)


@query
def sgd_minibatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A tenth of the rows a step, by a hash of (seed, step, key)."""
    return _sgd(spark, sf_dir, 0.1)


# -------------------------------------------------------------- score curves
@query
def binned_roc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The curve over 1,000 equal bins of the score."""
    return rounded(curves.binned_curve(fx.scored_fraud(spark, sf_dir)))


@query
def binned_auc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Its area, and how far the exact area can be."""
    return rounded(curves.binned_auc(fx.scored_fraud(spark, sf_dir)))


# ---------------------------------------------------------- 29-feature rows
def _card_blocks(spark: SparkSession, sf_dir: str, work: Workspace):
    """Card rows split by key, min-max scaled and weighted by class with the
    training part's values: the training part, also packed as blocks, and the
    other.  Each pass projects the rows it needs from the table: a third of what
    writing all of them costs, and no second copy of them on disk."""
    rows = fx.card(spark, sf_dir).withColumn("_part", split_index(F.col("key"), (0.8, 0.2), seed=42))
    train = rows.filter("_part = 0")
    feats = fx.CARD_FEATURES
    row = train.agg(*minmax_aggs(feats), F.count_if(F.col("label") == 0.0).alias("n0"), F.count_if(F.col("label") == 1.0).alias("n1")).first()
    scale = fit_minmax(train, feats, row=row)
    weight = logistic.class_weight_col(logistic.inverse_frequency(int(row["n0"]), int(row["n1"])))
    scaled = scale.transform(train)
    return dense.pack(scaled, feats, work, weight=weight), scaled, scale.transform(rows.filter("_part = 1"))


@query
def card_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D11 + D13 + D14 at 29 features: moments, ranges and the correlation with
    the label from merged block moments."""
    with Workspace(spark, "card") as work:
        blocks = dense.pack(fx.card(spark, sf_dir), fx.CARD_FEATURES, work)
        return rounded(dense.summary_frame(spark, blocks, dense.moments(blocks)))


@query
def card_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """I1 + I16 + I4 at 29 features: class-weighted gradient descent over
    blocks; every coefficient, beside the test part's report."""
    with Workspace(spark, "card") as work:
        blocks, train, test = _card_blocks(spark, sf_dir, work)
        run = logistic.gradient_descent(
            train, fx.CARD_FEATURES, [(FRAUD_GD["learning_rate"], FRAUD_GD["reg_param"])], FRAUD_GD["max_iter"], FRAUD_GD["tol"],
            sums=dense.loss_sums(blocks),
        )[0]
        blocks.release()
        report = evaluate.confusion(logistic.score(test, run.weights, fx.CARD_FEATURES), "p", "label", 0.5)
        coefficients = logistic.coefficient_frame(spark, run.weights, fx.CARD_FEATURES)
        return work.small(rounded(coefficients.crossJoin(F.broadcast(report))))  # 30 rows and one


@query
def card_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """I2 + F2 + F4 at 29 features: nine fits in one loop over blocks, ranked
    by the exact stepwise AUC without a row a model."""
    configs = [(lr, reg) for lr in GRID_LR for reg in GRID_REG]
    with Workspace(spark, "card") as work:
        blocks, train, test = _card_blocks(spark, sf_dir, work)
        runs = logistic.gradient_descent(train, fx.CARD_FEATURES, configs, FRAUD_GD["max_iter"], FRAUD_GD["tol"], sums=dense.loss_sums(blocks))
        blocks.release()
        scores = {f"_p{k}": logistic.probability(r.weights, fx.CARD_FEATURES) for k, r in enumerate(runs)}
        scored = add_apart(test, scores, 2).select(F.array(*scores).alias("scores"), "label", "key")
        best = curves.rank_models(work.store(scored, "scored"), len(runs)).orderBy(F.desc_nulls_last("auc"), "config_index").limit(1)
        names = [F.element_at(F.array(*[F.lit(float(c[i])) for c in configs]), F.col("config_index") + 1) for i in (0, 1)]
        return work.small(rounded(best.select(
            F.col("config_index").cast("bigint").alias("config_index"), names[0].alias("learning_rate"), names[1].alias("reg_param"), "auc",
        )))


# -------------------------------------------------------- stored preparation
def trip_preparation(train: DataFrame) -> preparation.Preparation:
    """The structured preparation, learned from training trips."""
    from quarry.plans.jobs import TRIP_MODEL_FEATURES

    return preparation.fit(
        train, TRIP_MODEL_FEATURES, bounds={**clean.STRUCTURED_DURATION_BOUNDS, **clean.STRUCTURED_COORD_BOUNDS},
        required=["store_and_fwd_flag", *fx.TRIP_FEATURES, "trip_duration"], index=["store_and_fwd_flag"], scale=["distance_km"],
    )


def with_trip_parts(trips: DataFrame) -> DataFrame:
    parts = time_parts(F.col("pickup_datetime"))
    distance = haversine_km(*[F.col(c) for c in ("pickup_longitude", "pickup_latitude", "dropoff_longitude", "dropoff_latitude")])
    return trips.withColumns({"pickup_hour": parts["pickup_hour"], "pickup_dayofweek": parts["pickup_dayofweek"], "distance_km": distance})


def _stored_trip_preparation(spark: SparkSession, sf_dir: str, work: Workspace):
    """Fitted on the training trips, saved, and read back from its files; with
    it the trips that were not trained on."""
    trips = with_trip_parts(fx.trips(spark, sf_dir)).withColumn("_part", split_index(F.col("id"), (0.8, 0.2), seed=42))
    trip_preparation(trips.filter("_part = 0")).save(work.path("preparation"))
    return preparation.Preparation.load(spark, work.path("preparation")), trips.filter("_part = 0"), trips.filter("_part = 1")


@query
def preparation_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """I22 + A13: the preparation as a table, after a round trip."""
    with Workspace(spark, "prep") as work:
        stored, _, _ = _stored_trip_preparation(spark, sf_dir, work)
        # the index can have any number of labels, so the table is not collected
        return rounded(stored.table.select("version", "kind", "position", "column", "label", "value", "other")).checkpoint(eager=True)


@query
def prepared_test_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """I22 + H9 + H11: rows it was not fitted on, prepared by the stored table."""
    with Workspace(spark, "prep") as work:
        stored, _, test = _stored_trip_preparation(spark, sf_dir, work)
        return rounded(stored.apply(test, ["id"]).checkpoint(eager=True))


@query
def preparation_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H10 + B8 + I22: how many rows cannot be scored, by reason."""
    with Workspace(spark, "prep") as work:
        stored, train, test = _stored_trip_preparation(spark, sf_dir, work)
        both = stored.apply(train).unionByName(stored.apply(test))
        return work.small(preparation.rejects(both))


@query
def forest_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """I21 + I22 + A11 + A13: the scoring job in two halves that share stored
    tables alone.  Training: preparation and tree, saved.  Scoring: both read
    back, every trip prepared without its label, scored, written as CSV and
    read again."""
    with Workspace(spark, "scoring") as work:
        stored, train, _ = _stored_trip_preparation(spark, sf_dir, work)
        rows = work.store(preparation.complete(stored.apply(train, ["trip_duration"])), "train")
        data = forest.prepare(rows, stored.features(), "trip_duration", work)
        grown = forest.grow(data, [forest.Spec(FOREST_DEPTH, FOREST_LEAST)])[0]
        forest.to_tree(data, grown).save(spark, work.path("tree"))

        loaded = preparation.Preparation.load(spark, work.path("preparation"))
        tree = tree_ops.Tree.from_table(spark.read.parquet(work.path("tree")), loaded.features())
        trips = with_trip_parts(fx.trips(spark, sf_dir).drop("trip_duration"))
        ready = preparation.complete(loaded.apply(trips, ["id"], with_label=False, label="trip_duration"))
        scored = tree.predict(ready, "trip_duration").select("id", "trip_duration")
        qio.write_csv(scored, work.path("scored"))
        return rounded(qio.read_csv(spark, work.path("scored"), schema="id string, trip_duration double")).checkpoint(eager=True)


# The scored tree's depth and least node size.
FOREST_DEPTH, FOREST_LEAST = 7, 10


# ------------------------------------------------------------ smaller pieces
@query
def batch_scoring_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """I21 + I11: the regression job's tree on the 20 % of the train lines that
    it was not fitted on."""
    from quarry.plans.jobs import regression_validation

    metrics = regression_validation(fx.trip_lines(spark, sf_dir), fx.TRIP_HEADER, tree_params=TREE)
    return rounded(metrics, 4)


@query
def csv_inferred(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips written as CSV with a header and read back with inferred
    types: the type and the filled cells of every column."""
    with Workspace(spark, "csv") as work:
        qio.write_csv(fx.trips(spark, sf_dir), work.path("trips"))
        read = qio.read_csv(spark, work.path("trips"), infer=True)
        types = dict(read.dtypes)
        counts = read.agg(*[F.count(c).alias(c) for c in read.columns])
        cells = F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.lit(types[c]).alias("type"), F.col(c).alias("filled")) for c in read.columns]))
        return work.small(counts.select(cells))


@query
def classification_notebook(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The hand-written classification job as a whole, from
    text lines to the sweep of the best of nine models and its AUC."""
    from quarry.plans.jobs import classification_job

    reports = classification_job(spark, fx.fraud_lines(spark, sf_dir), header=fx.FRAUD_HEADER)
    return rounded(reports["sweep"].crossJoin(F.broadcast(reports["auc"])))  # five rows and one
