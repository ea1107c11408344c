"""Feature queries (B4, H4–H12): time parts, haversine distance, string
index, standard and min-max scaling.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.catalog.common import _clean_fraud, query, rounded
from quarry.functions.columns import haversine_km, time_parts, wall_clock
from quarry.functions.scale import fit_minmax, fit_std, fit_string_index, string_index_table
from quarry.operators.split import hash_split
from quarry.sources import fixtures as fx


@query
def trip_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B1 + B4 + H4–H7 + K1: hour, day of week (1 = Sunday), haversine km."""
    t = fx.trips(spark, sf_dir)
    # The fixture's pickup time is already a timestamp (without zone), so
    # hour/day are wall-clock values independent of the session time zone.
    parts = time_parts(F.col("pickup_datetime"))
    dist = haversine_km(
        F.col("pickup_longitude"), F.col("pickup_latitude"), F.col("dropoff_longitude"), F.col("dropoff_latitude")
    )
    return rounded(
        t.select("id", parts["pickup_hour"].alias("pickup_hour"), parts["pickup_dayofweek"].alias("pickup_dayofweek"),
                 dist.alias("distance_km"))
    )


@query
def flag_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H9: string index of the flag by descending frequency, ties by value."""
    return string_index_table(fx.trips(spark, sf_dir), "store_and_fwd_flag").select(
        F.col("store_and_fwd_flag").alias("value"), "count", "index"
    )


@query
def index_reuse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H9 fitted on the train part of trips, applied to the test part
    (unseen/NULL → index = number of labels, ``handleInvalid='keep'``)."""
    t = fx.trips(spark, sf_dir)
    train, test = hash_split(t, F.col("id"), (0.8, 0.2), seed=7)
    idx = fit_string_index(train, "store_and_fwd_flag")
    return idx.transform(test, "flag_index", "keep").select("id", "store_and_fwd_flag", "flag_index")


@query
def standard_scale(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H10 + H11: divide by the sample stddev, no centring."""
    df = _clean_fraud(spark, sf_dir)
    return rounded(fit_std(df, fx.FRAUD_FEATURES).transform(df))


@query
def minmax_scale(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C2 + H12: ``(x − min) / max(max − min, 1e-8)`` fitted on the same rows."""
    df = _clean_fraud(spark, sf_dir)
    return rounded(fit_minmax(df, fx.FRAUD_FEATURES).transform(df))


@query
def pickup_time_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H4–H6: pickup time parsed from its text form, then hour and day of
    week (1 = Sunday); unparsable text gives NULL instead of failing."""
    t = fx.trips(spark, sf_dir).select(
        "id", F.date_format("pickup_datetime", "yyyy-MM-dd HH:mm:ss").alias("pickup_text")
    )
    parts = time_parts(wall_clock(F.col("pickup_text")))
    return t.select("id", "pickup_text", parts["pickup_hour"].alias("pickup_hour"),
                    parts["pickup_dayofweek"].alias("pickup_dayofweek"))
