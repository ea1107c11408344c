"""Typed scans and sinks.

Sinks write in parallel by default; ``partitions=1`` reproduces the
reference's single part file but funnels the output through one task, so it
is an explicit opt-in for small outputs only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


# Timestamps keep microseconds in CSV (Spark's default text keeps millis).
CSV_TIME_OPTIONS = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


def read_csv(
    spark: SparkSession, path: str, schema: StructType | str | None = None, infer: bool = False
) -> DataFrame:
    """CSV with header.  Pass a schema: inference costs an extra full pass, and
    takes times in any of Spark's usual forms."""
    reader = spark.read.option("header", True)
    if schema is None and infer:
        return reader.option("inferSchema", True).csv(path)
    reader = reader.options(**CSV_TIME_OPTIONS)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.csv(path)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def _sized(df: DataFrame, partitions: int | None) -> DataFrame:
    return df.coalesce(partitions) if partitions else df


def write_parquet(df: DataFrame, path: str, partitions: int | None = None) -> None:
    _sized(df, partitions).write.mode("overwrite").parquet(path)


def write_csv(df: DataFrame, path: str, partitions: int | None = None) -> None:
    _sized(df, partitions).write.mode("overwrite").option("header", True).options(**CSV_TIME_OPTIONS).csv(path)


def tuple_lines(df: DataFrame, id_col: str, value_col: str) -> DataFrame:
    """``('id', value)`` text lines — the reference's text output format."""
    return df.select(
        F.format_string("('%s', %s)", F.col(id_col), F.col(value_col).cast("string")).alias("value")
    )


def write_tuple_text(df: DataFrame, path: str, id_col: str, value_col: str, partitions: int | None = None) -> None:
    _sized(tuple_lines(df, id_col, value_col), partitions).write.mode("overwrite").text(path)


def vectors_to_arrays(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """ML vectors → ``array<double>`` for storage."""
    from pyspark.ml.functions import vector_to_array

    return df.withColumns({c: vector_to_array(c) for c in columns})


def arrays_to_vectors(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    from pyspark.ml.functions import array_to_vector

    return df.withColumns({c: array_to_vector(c) for c in columns})


def schema_table(df: DataFrame) -> DataFrame:
    """``(position, column, type, nullable)`` of a frame's schema."""
    rows = [
        (i, f.name, f.dataType.simpleString(), bool(f.nullable)) for i, f in enumerate(df.schema.fields)
    ]
    return df.sparkSession.createDataFrame(rows, "position int, column string, type string, nullable boolean")
