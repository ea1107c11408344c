"""Scans of the driver-provided parquet tables.

A scan is a plain ``spark.read.parquet``; callers ``select``/``filter`` on it
and Catalyst pushes both into the parquet reader (``ReadSchema`` /
``PushedFilters``), so no helper here pre-selects columns.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def spread(df: DataFrame) -> DataFrame:
    """``df`` over at least as many partitions as the cluster runs tasks: a
    small file is one task's work, and so is all that is derived from it."""
    target = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= target else df.repartition(target)
