"""Projections, row filters and de-duplication.

Each filter is one Column predicate so Catalyst can push it into the parquet
scan; de-duplication is a hash aggregate whose partial (map-side) phase
collapses hot duplicate groups before the shuffle.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Bounds of the two taxi cleaning rules of the reference.
# Structured rule (B5): coordinates only, applied to train and test.
STRUCTURED_COORD_BOUNDS = {
    "pickup_latitude": (40.0, 41.0),
    "pickup_longitude": (-74.0, -73.0),
    "dropoff_latitude": (40.0, 41.0),
    "dropoff_longitude": (-74.0, -73.0),
}
STRUCTURED_DURATION_BOUNDS = {"trip_duration": (60.0, 14400.0)}
# Low-level rule (B6 + B7).
OUTLIER_BOUNDS = {
    "pickup_longitude": (-74.3, -73.7),
    "dropoff_longitude": (-74.3, -73.7),
    "pickup_latitude": (40.5, 41.0),
    "dropoff_latitude": (40.5, 41.0),
    "passenger_count": (1.0, 9.0),
}
OUTLIER_DURATION_BOUNDS = {"trip_duration": (60.0, 36000.0)}
VENDOR_MEMBERS = {"vendor_id": (1, 2)}
BINARY_LABELS = (0.0, 1.0)


def drop_nulls(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """Drop rows with any NULL (and NaN in float columns), like ``dropna()``."""
    return df.dropna(how="any", subset=list(subset) if subset else None)


def dedup(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """Exact de-duplication on all (or the given) columns."""
    return df.dropDuplicates(list(subset)) if subset else df.dropDuplicates()


def bounds_predicate(bounds: Mapping[str, tuple[float, float]]) -> Column:
    """AND of inclusive ``lo <= col <= hi`` checks."""
    pred = F.lit(True)
    for name, (lo, hi) in bounds.items():
        pred = pred & F.col(name).between(F.lit(lo), F.lit(hi))
    return pred


def members_predicate(members: Mapping[str, Iterable]) -> Column:
    pred = F.lit(True)
    for name, values in members.items():
        pred = pred & F.col(name).isin(*list(values))
    return pred


def range_filter(df: DataFrame, bounds: Mapping[str, tuple[float, float]]) -> DataFrame:
    return df.filter(bounds_predicate(bounds))


def structured_filter(df: DataFrame, with_duration: bool = True) -> DataFrame:
    """Duration 60..14400 s (train only) and NYC box −74..−73 / 40..41."""
    bounds = dict(STRUCTURED_COORD_BOUNDS)
    if with_duration:
        bounds = {**STRUCTURED_DURATION_BOUNDS, **bounds}
    return range_filter(df, bounds)


def outlier_filter(df: DataFrame, with_duration: bool = True) -> DataFrame:
    """Coordinates, passengers 1..9, duration 60..36000 s, vendor in {1, 2}."""
    bounds = dict(OUTLIER_BOUNDS)
    if with_duration:
        bounds.update(OUTLIER_DURATION_BOUNDS)
    return df.filter(bounds_predicate(bounds) & members_predicate(VENDOR_MEMBERS))
