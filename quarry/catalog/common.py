"""Shared pieces of the catalogue: the query registry, rounding of published
values, scratch paths, and the fits several queries reuse (the fraud model,
the trips tree).
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from quarry.functions.scale import fit_minmax, minmax_aggs
from quarry.operators import clean, logistic
from quarry.operators import tree as tree_ops
from quarry.operators.split import hash_split, materialized_split
from quarry.session import checkpoint_dir, release
from quarry.sources import fixtures as fx


DIGITS = 6


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


def rounded(df: DataFrame, digits: int = DIGITS) -> DataFrame:
    """Round every floating column (published values only)."""
    return df.select(
        *[
            F.round(F.col(f.name), digits).alias(f.name)
            if isinstance(f.dataType, (DoubleType, FloatType))
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )


# Iterations and tolerance of the gradient-descent fits.
FRAUD_GD = {"learning_rate": 0.5, "reg_param": 0.01, "max_iter": 30, "tol": 1e-4}


def fraud_clean_split(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """fraud → drop NULL rows → exact de-duplication → 80/20 key-hash split."""
    df = clean.dedup(clean.drop_nulls(fx.fraud(spark, sf_dir)))
    train, test = hash_split(df, fx.fraud_row_key(), (0.8, 0.2), seed=42)
    return train, test


def fit_fraud_model(spark: SparkSession, sf_dir: str, configs=None, wide: bool = False, method: str = "columns"):
    """Fit the class-weighted logistic model on the training part.

    The cleaned, de-duplicated rows are checkpointed once with their split
    part; min-max ranges and class counts come from one aggregate over the
    training part; every iteration reads the checkpoint.
    Returns ``(runs, minmax, test, n_train)``.
    """
    df = clean.dedup(clean.drop_nulls(fx.fraud(spark, sf_dir, wide=wide)))
    (train, test), stored = materialized_split(df, fx.fraud_row_key(wide), (0.8, 0.2), seed=42, with_stored=True)
    feats = fx.FRAUD_FEATURES_WIDE if wide else fx.FRAUD_FEATURES
    row = train.agg(
        *minmax_aggs(feats),
        F.count_if(F.col("label") == 0.0).alias("n0"),
        F.count_if(F.col("label") == 1.0).alias("n1"),
    ).first()
    mm = fit_minmax(train, feats, row=row)
    n0, n1 = int(row["n0"]), int(row["n1"])
    cw = logistic.inverse_frequency(n0, n1)
    prepared = mm.transform(train).select(*feats, "label", logistic.class_weight_col(cw).alias("cw"))
    runs = logistic.gradient_descent(
        prepared,
        feats,
        configs or [(FRAUD_GD["learning_rate"], FRAUD_GD["reg_param"])],
        max_iter=FRAUD_GD["max_iter"],
        tol=FRAUD_GD["tol"],
        weight_col="cw",
        method=method,
    )
    release(stored)  # the stored rows stay readable from the checkpoint
    return runs, mm, test, n0 + n1


TRIP_NUMERIC = [
    "passenger_count", "pickup_longitude", "pickup_latitude", "dropoff_longitude", "dropoff_latitude",
    "trip_duration",
]


def _clean_fraud(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.dedup(clean.drop_nulls(fx.fraud(spark, sf_dir)))


# Tree parameters for the small scale factors (FIXTURES §4): the reference's
# 2000/1000 minimums would stop at the root below sf0.1.
TREE = {"max_depth": 4, "min_node": 100, "min_side": 50, "gain_factor": 0.95, "n_thresholds": 10}


def fit_trip_tree(spark: SparkSession, sf_dir: str):
    """The fitted tree and its training and validation parts: the source is
    read and split once, and every pass reads the stored rows."""
    t = clean.outlier_filter(fx.trips(spark, sf_dir))
    t = t.select("id", *[F.col(c).cast("double").alias(c) for c in fx.TRIP_FEATURES], "trip_duration")
    (train, valid), stored = materialized_split(t, F.col("id"), (0.8, 0.2), seed=42, with_stored=True)
    tree = tree_ops.fit_tree(train, fx.TRIP_FEATURES, "trip_duration", prepared=True, **TREE)
    release(stored)  # the parts stay readable from the checkpoint
    return tree, train, valid


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint directory."""
    return os.path.join(checkpoint_dir(spark), "scratch", f"{name}-{uuid.uuid4().hex}")
