"""End-to-end jobs (I21, I22): preparation, fitting, scoring and sinks.

These are what a user of the reference runs as a notebook, as functions over
paths.  Fitted state (string index, scaler, weights, tree) is learned on the
training rows only and re-used unchanged on the rows being scored.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.functions.columns import haversine_km, time_parts, wall_clock
from quarry.functions.scale import StringIndex, fit_minmax, fit_string_index
from quarry.operators import clean, curves, evaluate, logistic
from quarry.operators import tree as tree_ops
from quarry.operators.split import hash_split
from quarry.session import release
from quarry.sources import io as qio
from quarry.sources import text

# The columns of the structured regression model.
TRIP_MODEL_FEATURES = [
    "vendor_id", "passenger_count", "pickup_longitude", "pickup_latitude", "dropoff_longitude",
    "dropoff_latitude", "pickup_hour", "pickup_dayofweek", "distance_km", "store_and_fwd_flag_indexed",
]


@dataclass
class TripPrep:
    flag_index: StringIndex


def prepare_trips(df: DataFrame, fitted: TripPrep | None = None, with_label: bool = True) -> tuple[DataFrame, TripPrep]:
    """The structured regression preparation: time parts, haversine
    distance, flag index (fitted once), NULL drop, structured filter."""
    ts = F.col("pickup_datetime")
    if dict(df.dtypes).get("pickup_datetime") == "string":
        ts = wall_clock(ts)
    parts = time_parts(ts)
    out = df.withColumns(
        {
            "pickup_hour": parts["pickup_hour"],
            "pickup_dayofweek": parts["pickup_dayofweek"],
            "distance_km": haversine_km(
                F.col("pickup_longitude"), F.col("pickup_latitude"), F.col("dropoff_longitude"),
                F.col("dropoff_latitude"),
            ),
        }
    )
    if fitted is None:
        fitted = TripPrep(fit_string_index(out, "store_and_fwd_flag"))
    out = clean.structured_filter(clean.drop_nulls(out), with_duration=with_label)
    out = fitted.flag_index.transform(out, "store_and_fwd_flag_indexed")
    return out, fitted


def regression_job(
    spark: SparkSession,
    train_lines: DataFrame,
    test_lines: DataFrame,
    train_header: str | None = None,
    test_header: str | None = None,
    output: str | None = None,
    fmt: str = "csv",
    tree_params: dict | None = None,
) -> DataFrame:
    """The low-level regression job: parse train/test text, fit the
    level-wise tree on 80 % of the train rows, score the test rows, and
    optionally write ``(id, trip_duration)`` as CSV, parquet or text.
    Without explicit headers, the first line of each input is the header
    and every copy of it is dropped (the reference's rule)."""
    train_header = train_header if train_header is not None else text.first_line(train_lines)
    test_header = test_header if test_header is not None else text.first_line(test_lines)
    train = text.accepted(text.parse_trip_train(text.drop_header(train_lines, train_header)))
    fit_part, _ = hash_split(train, F.col("id"), (0.8, 0.2))
    tree = tree_ops.fit_tree(fit_part, tree_ops_features(), "trip_duration", **(tree_params or {}))
    test = text.accepted(text.parse_trip_test(text.drop_header(test_lines, test_header, strip_both=True)))
    scored = tree.predict(test, "trip_duration").select("id", "trip_duration")
    if output:
        if fmt == "csv":
            qio.write_csv(scored, output)
        elif fmt == "parquet":
            qio.write_parquet(scored, output)
        else:
            qio.write_tuple_text(scored, output, "id", "trip_duration")
    return scored


def regression_validation(train_lines: DataFrame, train_header: str | None = None, tree_params: dict | None = None) -> DataFrame:
    """``n, mse, rmse, mae, r2`` of the job's tree on the 20 % of the accepted
    train rows that it is not fitted on; the lines are parsed and split once."""
    from quarry.operators.split import materialized_split

    train_header = train_header if train_header is not None else text.first_line(train_lines)
    train = text.accepted(text.parse_trip_train(text.drop_header(train_lines, train_header)))
    (fit_part, valid), stored = materialized_split(train, F.col("id"), (0.8, 0.2), with_stored=True)
    tree = tree_ops.fit_tree(fit_part, tree_ops_features(), "trip_duration", prepared=True, **(tree_params or {}))
    release(stored)
    return evaluate.regression_metrics(tree.predict(valid), "prediction", "trip_duration")


def tree_ops_features() -> list[str]:
    return ["vendor_id", "passenger_count", "pickup_longitude", "pickup_latitude", "dropoff_longitude",
            "dropoff_latitude"]


def classification_job(
    spark: SparkSession,
    lines: DataFrame,
    header: str | None = None,
    drop: Sequence[str] = ("time",),
    learning_rates: Sequence[float] = (0.01, 0.1, 0.5),
    reg_params: Sequence[float] = (0.001, 0.01, 0.1),
    max_iter: int = 30,
    tol: float = 1e-4,
    thresholds: Sequence[float] = evaluate.SWEEP_THRESHOLDS,
    features_output: str | None = None,
) -> dict[str, DataFrame]:
    """The hand-written classification notebook as one job.

    Parse (first line = header, every copy dropped; rejects kept), profile,
    de-duplicate, key-hash split, fit min-max and class weights on the
    training part, fit the whole (learning rate × reg) grid in one loop, pick
    the highest stepwise AUC on the test part (first wins), then report the
    threshold sweep.  Returns named report DataFrames; optionally writes the
    scaled features as parquet.
    """
    from quarry.operators import profile
    from quarry.operators.split import materialized_split

    header = header if header is not None else text.first_line(lines)
    names = header.split(",")
    label = names[-1]
    dropped = {d.lower() for d in drop}
    skip = tuple(c for c in names[:-1] if c.lower() in dropped)  # e.g. "Time"
    parsed = text.parse_labelled(text.drop_header(lines, header), names, skip=skip)
    feats = [c for c in names[:-1] if c not in skip]
    report = profile.cleaning_report(parsed, F.col(text.REASON).isNull(), feats + [label], len(feats))
    clean_rows = clean.dedup(text.accepted(parsed))
    key = F.concat_ws("|", *[F.col(c).cast("string") for c in feats + [label]])
    (train, test), stored = materialized_split(clean_rows, key, (0.8, 0.2), with_stored=True)
    # the reports read the stored rows, not the text again
    cleaned = stored.drop("_part")
    from quarry.functions.scale import minmax_aggs

    row = train.agg(
        *minmax_aggs(feats),
        F.count_if(F.col(label) == 0.0).alias("n0"),
        F.count_if(F.col(label) == 1.0).alias("n1"),
    ).first()
    mm = fit_minmax(train, feats, row=row)
    cw = logistic.inverse_frequency(int(row["n0"]), int(row["n1"]))
    prepared = mm.transform(train).select(*feats, label, logistic.class_weight_col(cw, label).alias("_w"))
    configs = [(lr, reg) for lr in learning_rates for reg in reg_params]
    runs = logistic.gradient_descent(prepared, feats, configs, max_iter, tol, label, weight_col="_w", method="arrow")
    stest = mm.transform(test)
    scored = stest.select(
        F.array(*[logistic.probability(r.weights, feats) for r in runs]).alias("scores"), F.col(label).alias("label"), key.alias("key")
    )
    aucs = curves.rank_models(scored, len(runs)).filter("ordered").collect()
    best_i, best_auc = None, 0.0
    for r in sorted(aucs, key=lambda r: r["config_index"]):
        if r["auc"] > best_auc:  # strict, from 0.0: first best wins
            best_i, best_auc = r["config_index"], r["auc"]
    best_i = 0 if best_i is None else best_i
    weights = runs[best_i].weights
    final = logistic.score(stest, weights, feats)
    out = {
        "cleaning": report,
        "class_distribution": profile.class_distribution(cleaned, label),
        "feature_summary": profile.feature_summary(cleaned, feats),
        "correlation": profile.label_correlation(cleaned, feats, label),
        "history": logistic.history_frame(spark, runs),
        "coefficients": logistic.coefficient_frame(spark, weights, feats),
        "sweep": evaluate.threshold_sweep(final, thresholds, "p", label),
        "auc": evaluate.auc_stepwise(final, key, "p", label),
        "rejects": text.rejected(parsed),
    }
    if features_output:
        qio.write_parquet(mm.transform(cleaned), features_output)
    release(stored)
    return out


def split_and_prepare(df: DataFrame) -> tuple[list[DataFrame], TripPrep, DataFrame]:
    """80/20 key split, then the preparation with the flag index fitted on the
    training rows alone.  One stored copy of the prepared complete rows feeds
    all later fits and metrics: ``([train, valid], fitted, stored)``."""
    from quarry.operators import library
    from quarry.operators.split import materialized_split

    raw_train, _ = hash_split(df, F.col("id"), (0.8, 0.2))
    fitted = TripPrep(fit_string_index(raw_train, "store_and_fwd_flag"))
    prepared, _ = prepare_trips(df, fitted)
    prepared = library.complete_rows(prepared, TRIP_MODEL_FEATURES)
    parts, stored = materialized_split(prepared, F.col("id"), (0.8, 0.2), with_stored=True)
    return parts, fitted, stored


def structured_regression_job(
    df: DataFrame,
    test: DataFrame | None = None,
    output: str | None = None,
    max_depths: Sequence[int] = (5, 7, 10),
    min_instances: Sequence[int] = (1, 10, 50),
    folds: int = 3,
) -> dict[str, DataFrame]:
    """The structured regression notebook as one job: prepare (time parts,
    haversine, flag index fitted on the training rows and re-used), 80/20
    key split, Spark ML tree (depth 5) and a cross-validated grid, RMSE/R²
    on the validation part, and optional scoring of ``test`` to CSV."""
    from quarry.operators import library

    (train, valid), fitted, stored = split_and_prepare(df)
    base = library.fit_tree_regressor(train, TRIP_MODEL_FEATURES, "trip_duration")
    cv_model, grid = library.cross_validate_tree(
        train, TRIP_MODEL_FEATURES, "trip_duration", max_depths, min_instances, folds
    )
    best = cv_model.bestModel
    pred = best.transform(library.assemble(valid, TRIP_MODEL_FEATURES))
    spark = df.sparkSession
    out = {
        "base_importances": library.importances_table(spark, base, TRIP_MODEL_FEATURES),
        "cv_grid": grid,
        "best_importances": library.importances_table(spark, best, TRIP_MODEL_FEATURES),
        "validation": evaluate.regression_metrics(pred, "prediction", "trip_duration"),
    }
    if test is not None:
        prepared_test, _ = prepare_trips(test, fitted, with_label=False)
        prepared_test = library.complete_rows(prepared_test, TRIP_MODEL_FEATURES)
        scored = best.transform(library.assemble(prepared_test, TRIP_MODEL_FEATURES)).select(
            "id", F.col("prediction").alias("trip_duration")
        )
        out["scored"] = scored
        if output:
            qio.write_csv(scored, output)
    release(stored)
    return out
