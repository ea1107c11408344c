"""Profiling queries (D1–D18): counts, frequencies, class balance, missing
values, summaries, quantiles, correlation, histograms.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quarry.catalog.common import TRIP_NUMERIC, fraud_clean_split, query, rounded
from quarry.operators import clean, logistic, profile
from quarry.sources import fixtures as fx


@query
def row_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D1."""
    return profile.row_count(fx.fraud(spark, sf_dir))


@query
def duplicate_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D3 (and D2's extra-row count) over all fraud columns."""
    return profile.duplicate_summary(fx.fraud(spark, sf_dir))


@query
def frequency_passengers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D4 + F1."""
    return profile.frequency(fx.trips(spark, sf_dir), "passenger_count")


@query
def frequency_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D4 (NULL is its own group)."""
    return profile.frequency(fx.trips(spark, sf_dir), "store_and_fwd_flag")


@query
def class_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D5 on clean, de-duplicated fraud rows."""
    df = clean.dedup(clean.drop_nulls(fx.fraud(spark, sf_dir)))
    return rounded(profile.class_distribution(df))


@query
def class_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D6 on the training part of the fraud split."""
    train, _ = fraud_clean_split(spark, sf_dir)
    return rounded(logistic.class_weights_frame(train))


@query
def missing_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """NULL or NaN per fraud column."""
    return profile.missing_counts(fx.fraud(spark, sf_dir))


@query
def null_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """NULL only, per trips column."""
    return profile.missing_counts(fx.trips(spark, sf_dir), nan=False)


@query
def describe_numeric(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Count, mean, sample stddev, min, max."""
    return rounded(profile.describe(fx.trips(spark, sf_dir), TRIP_NUMERIC))


@query
def feature_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean, population stddev, min, max of clean fraud features."""
    df = clean.dedup(clean.drop_nulls(fx.fraud(spark, sf_dir)))
    return rounded(profile.feature_summary(df, fx.FRAUD_FEATURES))


@query
def feature_min_max(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Min and max of the six trip features after the outlier rule."""
    df = clean.outlier_filter(fx.trips(spark, sf_dir))
    return profile.min_max(df, fx.TRIP_FEATURES)


@query
def quantile_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Min, exact 25/50/75 % and max of trip duration."""
    return profile.exact_quantiles(fx.trips(spark, sf_dir), ["trip_duration"])


@query
def quantile_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D10 without a sketch: exact quartiles of every numeric trip column
    from grouped counts and distributed running totals."""
    return profile.exact_quantiles(fx.trips(spark, sf_dir), TRIP_NUMERIC)


@query
def label_correlation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pearson correlation of each fraud feature with the label."""
    df = clean.drop_nulls(fx.fraud(spark, sf_dir))
    return rounded(profile.label_correlation(df, fx.FRAUD_FEATURES))


@query
def target_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D15 + D17: count, mean and population variance of trip duration."""
    df = clean.outlier_filter(fx.trips(spark, sf_dir))
    return rounded(profile.target_stats(df, "trip_duration"), 4)


@query
def target_variance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Population variance and count of the target (0.0, 0 when empty)."""
    df = clean.outlier_filter(fx.trips(spark, sf_dir))
    return rounded(profile.target_stats(df, "trip_duration").select("variance", "n"), 4)


@query
def target_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean of the target — the leaf value of a tree node (0.0 when empty)."""
    df = clean.outlier_filter(fx.trips(spark, sf_dir))
    return rounded(profile.target_stats(df, "trip_duration").select("mean"), 4)


@query
def histogram_50(spark: SparkSession, sf_dir: str) -> DataFrame:
    """50 equal-width bins of every fraud column, one grouped pass."""
    df = clean.drop_nulls(fx.fraud(spark, sf_dir))
    return rounded(profile.histogram(df, fx.FRAUD_FEATURES + ["label"]))
