"""Every registered query runs on sf0.001 and keeps a stable schema; the
streaming scorer applies the same compiled model to a file stream."""

import os

import pytest

import __spark_entry__ as entry
from conftest import SF001

from quarry.catalog import QUERIES

# the two full cross-validated jobs run on a reduced grid below
QUICK = [k for k in QUERIES if k not in ("structured_scoring", "cv_best_model")]


def test_entry_smoke(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert len(rows) == 1 and rows[0]["tp"] + rows[0]["fp"] + rows[0]["tn"] + rows[0]["fn"] > 0


def test_every_query_has_an_oracle_or_is_listed_rows_only():
    rows_only = set(QUERIES) - set(entry.oracle_sql())
    assert rows_only <= {"lr_lbfgs_coefficients", "lr_lbfgs_summary", "dt_importances", "dt_cv_grid",
                         "dt_deep_rmse", "structured_scoring", "cv_best_model", "tree_text"}


@pytest.mark.parametrize("name", QUICK)
def test_query_runs(spark, name):
    df = entry.queries()[name](spark, SF001)
    schema = df.schema
    n = df.count()
    assert n >= 0
    assert df.schema == schema


def test_stream_scoring(spark, tmp_path):
    from quarry.catalog import fit_trip_tree
    from quarry.sources import fixtures as fx
    from quarry.streaming import scoring

    tree, _, valid = fit_trip_tree(spark, SF001)
    src = str(tmp_path / "in")
    valid.write.parquet(src)
    stream = scoring.read_stream(spark, src, valid.schema, maxFilesPerTrigger=1)
    q = scoring.write_stream(
        scoring.scored_stream(stream, tree.predict_col(), ["id"]), str(tmp_path / "out"),
        checkpoint=str(tmp_path / "ckpt"), trigger_once=True,
    )
    q.awaitTermination(120)
    out = spark.read.parquet(str(tmp_path / "out"))
    batch = tree.predict(valid).select("id", "prediction")
    assert out.count() == valid.count()
    assert out.exceptAll(batch).count() == 0
    assert os.path.isdir(str(tmp_path / "ckpt"))


def test_regression_job_sinks(spark, tmp_path):
    from quarry.catalog import TREE
    from quarry.plans.jobs import regression_job
    from quarry.sources import fixtures as fx

    for fmt in ("csv", "parquet", "text"):
        out = str(tmp_path / fmt)
        scored = regression_job(spark, fx.trip_lines(spark, SF001), fx.trip_lines(spark, SF001, test=True),
                                fx.TRIP_HEADER, fx.TRIP_TEST_HEADER, output=out, fmt=fmt, tree_params=TREE)
        n = scored.count()
        back = {"csv": lambda: spark.read.option("header", True).csv(out),
                "parquet": lambda: spark.read.parquet(out), "text": lambda: spark.read.text(out)}[fmt]()
        assert back.count() == n > 0


def test_classification_job(spark, tmp_path):
    from quarry.plans.jobs import classification_job
    from quarry.sources import fixtures as fx

    out = classification_job(spark, fx.fraud_lines(spark, SF001), header=fx.FRAUD_HEADER,
                             learning_rates=(0.1, 0.5), reg_params=(0.01,),
                             max_iter=5, features_output=str(tmp_path / "features"))
    rep = out["cleaning"].first()
    assert rep["valid"] + rep["rejected"] == rep["raw_lines"]
    assert out["sweep"].count() == 5 and 0.0 <= out["auc"].first()["auc"] <= 1.0
    assert out["history"].count() >= 2 and out["coefficients"].count() == 4
    assert spark.read.parquet(str(tmp_path / "features")).count() == rep["distinct_valid"]


def test_structured_regression_job(spark, tmp_path):
    from quarry.plans.jobs import structured_regression_job
    from quarry.sources import fixtures as fx

    trips = fx.trips(spark, SF001)
    test = trips.drop("trip_duration")
    out = structured_regression_job(trips, test, str(tmp_path / "sub"), max_depths=(2, 3), min_instances=(1,), folds=2)
    assert out["cv_grid"].count() == 2
    assert out["validation"].first()["n"] > 0
    assert spark.read.option("header", True).csv(str(tmp_path / "sub")).count() == out["scored"].count()


def test_stream_scoring_logistic(spark, tmp_path):
    from quarry.catalog import fit_fraud_model
    from quarry.operators import logistic
    from quarry.sources import fixtures as fx
    from quarry.streaming import scoring

    runs, mm, test, _ = fit_fraud_model(spark, SF001)
    rows = mm.transform(test).withColumn("key", fx.fraud_row_key())
    src = str(tmp_path / "in")
    rows.write.parquet(src)
    stream = scoring.read_stream(spark, src, rows.schema)
    prob = logistic.probability(runs[0].weights, fx.FRAUD_FEATURES)
    q = scoring.write_stream(scoring.scored_stream(stream, prob, ["key"], "p"), str(tmp_path / "out"),
                             checkpoint=str(tmp_path / "ckpt"), trigger_once=True)
    q.awaitTermination(120)
    out = spark.read.parquet(str(tmp_path / "out"))
    batch = logistic.score(rows, runs[0].weights, fx.FRAUD_FEATURES).select("key", "p")
    assert out.count() == rows.count() and out.exceptAll(batch).count() == 0
