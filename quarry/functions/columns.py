"""Scalar Column expressions: time parts, haversine, sigmoid, thresholds.

All of these replace per-row Python (the reference's haversine UDF, sigmoid
and dot-product helpers) with native expressions that stay inside whole-stage
codegen.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Earth radius in km and the sigmoid overflow guard.
EARTH_RADIUS_KM = 6371.0
SIGMOID_GUARD = 500.0


def haversine_km(lon1: Column, lat1: Column, lon2: Column, lat2: Column) -> Column:
    """Great-circle distance, ``2·R·atan2(√a, √(1−a))``; ``a`` clamped to [0, 1]."""
    dlat = F.radians(lat2 - lat1)
    dlon = F.radians(lon2 - lon1)
    a = F.pow(F.sin(dlat / 2.0), 2) + F.cos(F.radians(lat1)) * F.cos(
        F.radians(lat2)
    ) * F.pow(F.sin(dlon / 2.0), 2)
    a = F.least(F.greatest(a, F.lit(0.0)), F.lit(1.0))
    return F.lit(2.0 * EARTH_RADIUS_KM) * F.atan2(F.sqrt(a), F.sqrt(F.lit(1.0) - a))


# Fixed value: the wall-clock text layout of the reference's trip files.
WALL_CLOCK_PATTERN = r"^(\d{4})-(\d{2})-(\d{2})[ T](\d{2}):(\d{2}):(\d{2}(?:\.\d{1,6})?)$"


def wall_clock(text: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss[.ffffff]`` text → timestamp without zone.

    Built from the extracted parts with ``try_make_timestamp_ntz``, so the
    value is the written wall-clock time whatever the session time zone (no
    DST shift) and malformed or impossible dates give NULL, not an error.
    """
    part = lambda i, t: F.regexp_extract(text, WALL_CLOCK_PATTERN, i).try_cast(t)
    return F.try_make_timestamp_ntz(
        part(1, "int"), part(2, "int"), part(3, "int"), part(4, "int"), part(5, "int"), part(6, "decimal(16,6)")
    )


def time_parts(ts: Column) -> dict[str, Column]:
    """``pickup_hour`` (0-23) and ``pickup_dayofweek`` (1 = Sunday)."""
    return {"pickup_hour": F.hour(ts), "pickup_dayofweek": F.dayofweek(ts)}


def linear(weights: Sequence[float], features: Sequence[str | Column]) -> Column:
    """``w0 + Σ w_i·x_i`` with the weights as literals (bias first)."""
    z = F.lit(float(weights[0]))
    for w, x in zip(weights[1:], features):
        z = z + F.lit(float(w)) * (F.col(x) if isinstance(x, str) else x)
    return z


def sigmoid(z: Column, guard: float = SIGMOID_GUARD) -> Column:
    """``1/(1+e^-z)``, exactly 0 below ``-guard`` and 1 above ``guard``."""
    return (
        F.when(z < -guard, F.lit(0.0))
        .when(z > guard, F.lit(1.0))
        .otherwise(F.lit(1.0) / (F.lit(1.0) + F.exp(-z)))
    )


def threshold(p: Column, t: float | Column) -> Column:
    """Hard prediction: 1.0 when ``p >= t`` else 0.0."""
    t = t if isinstance(t, Column) else F.lit(float(t))
    return F.when(p >= t, F.lit(1.0)).otherwise(F.lit(0.0))


def safe_div(num: Column, den: Column) -> Column:
    """``num/den`` or 0.0 when the denominator is 0 (the reference's rule)."""
    return F.when(den == 0, F.lit(0.0)).otherwise(num.cast("double") / den)


def add_apart(df: DataFrame, columns: Mapping[str, Column], at_once: int) -> DataFrame:
    """``withColumns``, but ``at_once`` columns at a time with a ``coalesce`` to
    the same partitions between.  Long projections in one piece of generated
    code make a method above the 8,000 bytes that the JVM compiles, which then
    runs interpreted, some ten times slower."""
    partitions = df.rdd.getNumPartitions()
    names = list(columns)
    for first in range(0, len(names), at_once):
        df = df.coalesce(partitions).withColumns({c: columns[c] for c in names[first : first + at_once]})
    return df.coalesce(partitions)
