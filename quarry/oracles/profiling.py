"""Twins of the profiling queries (D1–D18), including exact quantiles.
"""

from __future__ import annotations

from quarry.oracles.base import FRAUD, FRAUD_CLEAN, FRAUD_SPLIT, ORACLES
from quarry.oracles.ingest import TRIPS, TRIPS_OUTLIER


ORACLES["row_count"] = "SELECT count(*)::BIGINT AS rows FROM lineitem"


ORACLES["duplicate_groups"] = f"""
WITH g AS (SELECT f1, f2, f3, label, count(*) AS n FROM ({FRAUD}) f GROUP BY ALL)
SELECT sum(n)::BIGINT AS rows, count(*)::BIGINT AS distinct_rows, (sum(n) - count(*))::BIGINT AS duplicate_rows,
       count_if(n > 1)::BIGINT AS duplicate_groups FROM g"""


ORACLES["frequency_passengers"] = (
    f"SELECT passenger_count, count(*)::BIGINT AS count FROM ({TRIPS}) t GROUP BY 1"
)


ORACLES["frequency_flag"] = f"SELECT store_and_fwd_flag, count(*)::BIGINT AS count FROM ({TRIPS}) t GROUP BY 1"


ORACLES["class_distribution"] = f"""
SELECT label, count(*)::BIGINT AS count, round(count(*) / sum(count(*)) OVER () * 100.0, 6) AS percent
FROM ({FRAUD_CLEAN}) c GROUP BY label"""


ORACLES["class_weights"] = f"""
WITH train AS (SELECT * FROM ({FRAUD_SPLIT}) s WHERE bucket < 80),
     c AS (SELECT count_if(label = 0.0)::BIGINT AS n0, count_if(label = 1.0)::BIGINT AS n1 FROM train)
SELECT n0, n1,
       round(CASE WHEN n0 = 0 OR n1 = 0 THEN 1.0 ELSE (n0 + n1)::DOUBLE / (n0 * 2.0) END, 6) AS w0,
       round(CASE WHEN n0 = 0 OR n1 = 0 THEN 1.0 ELSE (n0 + n1)::DOUBLE / (n1 * 2.0) END, 6) AS w1
FROM c"""


def unpivot_rows(select_per_column: dict[str, str], source: str) -> str:
    return "\nUNION ALL\n".join(f"SELECT '{c}' AS column, {sel} FROM ({source}) s" for c, sel in select_per_column.items())


ORACLES["missing_counts"] = unpivot_rows(
    {c: f"count_if({c} IS NULL OR isnan({c}))::BIGINT AS missing" for c in ["f1", "f2", "f3", "label"]}, FRAUD
)


_TRIP_ALL = ["id", "vendor_id", "passenger_count", "pickup_datetime", "pickup_longitude", "pickup_latitude",
             "dropoff_longitude", "dropoff_latitude", "store_and_fwd_flag", "trip_duration"]


ORACLES["null_counts"] = unpivot_rows({c: f"count_if({c} IS NULL)::BIGINT AS missing" for c in _TRIP_ALL}, TRIPS)


_TRIP_NUMERIC = ["passenger_count", "pickup_longitude", "pickup_latitude", "dropoff_longitude",
                 "dropoff_latitude", "trip_duration"]


ORACLES["describe_numeric"] = unpivot_rows(
    {
        c: f"count({c})::BIGINT AS count, round(avg({c}::DOUBLE), 6) AS mean, "
        f"round(stddev_samp({c}::DOUBLE), 6) AS stddev, round(min({c}::DOUBLE), 6) AS min, "
        f"round(max({c}::DOUBLE), 6) AS max"
        for c in _TRIP_NUMERIC
    },
    TRIPS,
)


ORACLES["feature_summary"] = unpivot_rows(
    {
        c: f"round(avg({c}), 6) AS mean, round(stddev_pop({c}), 6) AS stddev, round(min({c}), 6) AS min, "
        f"round(max({c}), 6) AS max"
        for c in ["f1", "f2", "f3"]
    },
    FRAUD_CLEAN,
)


ORACLES["feature_min_max"] = unpivot_rows(
    {c: f"min({c})::DOUBLE AS min, max({c})::DOUBLE AS max" for c in
     ["vendor_id", "passenger_count", "pickup_longitude", "pickup_latitude", "dropoff_longitude", "dropoff_latitude"]},
    TRIPS_OUTLIER,
)


ORACLES["quantile_summary"] = unpivot_rows(
    {"trip_duration": "min(trip_duration) AS min, quantile_disc(trip_duration, 0.25) AS q25, "
     "quantile_disc(trip_duration, 0.5) AS q50, quantile_disc(trip_duration, 0.75) AS q75, "
     "max(trip_duration) AS max"},
    TRIPS,
)


_FRAUD_NN = f"SELECT * FROM ({FRAUD}) f WHERE f1 IS NOT NULL AND f2 IS NOT NULL AND f3 IS NOT NULL"


def _corr(c: str) -> str:
    n = "count(*)::DOUBLE"
    my, mx = f"(sum(label) / {n})", f"(sum({c}) / {n})"
    cov = f"(sum({c} * label) / {n} - {mx} * {my})"
    vx = f"(sum({c} * {c}) / {n} - {mx} * {mx})"
    vy = f"(sum(label * label) / {n} - {my} * {my})"
    return f"round(CASE WHEN count(*) = 0 THEN 0.0 ELSE {cov} / sqrt(greatest({vx} * {vy}, 1e-10)) END, 6) AS correlation"


ORACLES["label_correlation"] = unpivot_rows({c: _corr(c) for c in ["f1", "f2", "f3"]}, _FRAUD_NN)


ORACLES["target_stats"] = f"""
SELECT count(trip_duration)::BIGINT AS n, round(coalesce(avg(trip_duration), 0.0), 4) AS mean,
       round(coalesce(var_pop(trip_duration), 0.0), 4) AS variance FROM ({TRIPS_OUTLIER}) t"""


def _hist(c: str) -> str:
    return f"""
SELECT '{c}' AS column, bin, round(lo + bin * w, 6) AS lo, round(lo + (bin + 1) * w, 6) AS hi, count(*)::BIGINT AS count
FROM (SELECT lo, w, CASE WHEN w > 0 THEN least(49, floor(({c} - lo) / w))::BIGINT ELSE 0::BIGINT END AS bin
      FROM ({_FRAUD_NN}) f, (SELECT min({c}) AS lo, (max({c}) - min({c})) / 50.0 AS w FROM ({_FRAUD_NN}) g) s
      WHERE {c} IS NOT NULL AND NOT isnan({c})) b
GROUP BY bin, lo, w"""


ORACLES["histogram_50"] = "\nUNION ALL\n".join(_hist(c) for c in ["f1", "f2", "f3", "label"])


ORACLES["quantile_exact"] = unpivot_rows(
    {c: f"min({c})::DOUBLE AS min, quantile_disc({c}, 0.25)::DOUBLE AS q25, quantile_disc({c}, 0.5)::DOUBLE AS q50, "
        f"quantile_disc({c}, 0.75)::DOUBLE AS q75, max({c})::DOUBLE AS max" for c in _TRIP_NUMERIC},
    TRIPS,
)

ORACLES["target_variance"] = f"""
SELECT round(coalesce(var_pop(trip_duration), 0.0), 4) AS variance, count(trip_duration)::BIGINT AS n
FROM ({TRIPS_OUTLIER}) t"""
ORACLES["target_mean"] = f"""
SELECT round(coalesce(avg(trip_duration), 0.0), 4) AS mean FROM ({TRIPS_OUTLIER}) t"""
