"""Ingest queries: validated text parsing with reject reasons (A1–A7, B8),
row filters and de-duplication (B3–B11), sinks and round trips (A8–A15),
and the deterministic first rows (F3).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.catalog.common import _clean_fraud, query, rounded, scratch_path
from quarry.operators import clean, library, profile
from quarry.operators.split import split_index
from quarry.sources import fixtures as fx
from quarry.sources import io as qio
from quarry.sources import text


FRAUD_NAMES = fx.FRAUD_HEADER.split(",")


def _fraud_parsed(spark: SparkSession, sf_dir: str, with_time: bool = True) -> DataFrame:
    lines = text.drop_header(fx.fraud_lines(spark, sf_dir), fx.FRAUD_HEADER)
    return text.parse_labelled(lines, FRAUD_NAMES, skip=() if with_time else ("time",))


@query
def parse_fraud_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A1 + A2: header lines dropped, strict parse of all fields."""
    return text.accepted(_fraud_parsed(spark, sf_dir))


@query
def parse_fraud_lines_no_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A3: as A2 but ``time`` is neither validated nor returned."""
    return text.accepted(_fraud_parsed(spark, sf_dir, with_time=False))


@query
def parse_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rejected lines with the first failed check."""
    return text.rejected(_fraud_parsed(spark, sf_dir))


@query
def cleaning_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D1 + D2: raw, valid, rejected, distinct, duplicate counts (no time)."""
    parsed = _fraud_parsed(spark, sf_dir, with_time=False)
    cols = ["f1", "f2", "f3", "label"]
    return rounded(profile.cleaning_report(parsed, F.col("reason").isNull(), cols, len(cols) - 1))


def _trip_lines_parsed(spark: SparkSession, sf_dir: str, test: bool, filters: bool) -> DataFrame:
    lines = fx.trip_lines(spark, sf_dir, test=test)
    if test:
        lines = text.drop_header(lines, fx.TRIP_TEST_HEADER, strip_both=True)
        return text.parse_trip_test(lines, filters=filters)
    lines = text.drop_header(lines, fx.TRIP_HEADER)
    return text.parse_trip_train(lines, filters=filters)


@query
def parse_trip_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A4: positional parse of train lines with the outlier filters."""
    return text.accepted(_trip_lines_parsed(spark, sf_dir, test=False, filters=True))


@query
def parse_trip_test_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A5: test lines (stripped header match), coordinate/passenger/vendor filters."""
    return text.accepted(_trip_lines_parsed(spark, sf_dir, test=True, filters=True))


@query
def parse_labeled_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Positional parse to (features, label), no range filters."""
    return text.accepted(_trip_lines_parsed(spark, sf_dir, test=False, filters=False))


@query
def parse_feature_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Positional parse of test lines to features (id kept)."""
    return text.accepted(_trip_lines_parsed(spark, sf_dir, test=True, filters=False))


@query
def trip_reject_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reject reasons of the train-line parser, counted."""
    rej = text.rejected(_trip_lines_parsed(spark, sf_dir, test=False, filters=True))
    return rej.groupBy("reason").agg(F.count(F.lit(1)).alias("lines"))


@query
def dropna_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips without any NULL."""
    return clean.drop_nulls(fx.trips(spark, sf_dir))


@query
def dedup_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct fraud rows (NULLs compare equal)."""
    return clean.dedup(fx.fraud(spark, sf_dir))


@query
def range_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B5 + B10: structured rule — duration 60..14400 s, NYC box."""
    return clean.structured_filter(fx.trips(spark, sf_dir))


@query
def outlier_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B6 + B7: low-level rule — tighter box, passengers 1..9, vendor {1,2}."""
    return clean.outlier_filter(fx.trips(spark, sf_dir))


@query
def hash_split_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per part of the 80/20 key-hash split of clean fraud rows."""
    df = clean.dedup(clean.drop_nulls(fx.fraud(spark, sf_dir)))
    part = split_index(fx.fraud_row_key(), (0.8, 0.2), seed=42)
    return df.groupBy(part.cast("bigint").alias("part")).agg(F.count(F.lit(1)).alias("rows"))


@query
def first_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """the first five trips by id — a deterministic ``take(5)`` (top-k
    per task, then a merge of k rows per task; no global sort)."""
    return fx.trips(spark, sf_dir).orderBy("id").limit(5)


@query
def csv_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A8 + A11: trips written as CSV (parallel parts) and read with a schema."""
    t = fx.trips(spark, sf_dir)
    path = scratch_path(spark, "csv")
    qio.write_csv(t, path)
    return qio.read_csv(spark, path, schema=t.schema)


@query
def parquet_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A9 + A10 + A14: assembled and scaled vectors stored as arrays in
    parquet, read back and turned into vectors again."""
    from pyspark.ml.functions import vector_to_array

    df = _clean_fraud(spark, sf_dir)
    pre = library.scale_vectors(df, fx.FRAUD_FEATURES).select("features", "label", "scaledFeatures")
    path = scratch_path(spark, "parquet")
    qio.write_parquet(qio.vectors_to_arrays(pre, ["features", "scaledFeatures"]), path)
    back = qio.arrays_to_vectors(qio.read_parquet(spark, path), ["features", "scaledFeatures"])
    arr = vector_to_array("features")
    sarr = vector_to_array("scaledFeatures")
    return rounded(
        back.select(
            *[arr[i].alias(c) for i, c in enumerate(fx.FRAUD_FEATURES)],
            *[sarr[i].alias(f"scaled_{c}") for i, c in enumerate(fx.FRAUD_FEATURES)],
            "label",
        )
    )


@query
def text_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``('id', prediction)`` lines written as text and read back."""
    path = scratch_path(spark, "text")
    qio.write_tuple_text(fx.scored_trips(spark, sf_dir), path, "id", "prediction")
    return spark.read.text(path)


@query
def schema_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trips schema as a table."""
    return qio.schema_table(fx.trips(spark, sf_dir))
