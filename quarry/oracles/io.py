"""Twins of the round-trip and schema queries (the original rows).
"""

from __future__ import annotations

from quarry.oracles.base import FRAUD_CLEAN, ORACLES
from quarry.oracles.ingest import TRIPS
from quarry.oracles.tree import _FIXED, _TRIP_TRAIN, _TRIP_VALID, route_sql, tree_sql


ORACLES["csv_round_trip"] = TRIPS


ORACLES["text_round_trip"] = (
    f"SELECT '(''' || id || ''', ' || CAST(prediction AS VARCHAR) || ')' AS value "
    f"FROM (SELECT id, {_FIXED.split('SELECT trip_duration AS y,', 1)[1]}) s"
)


ORACLES["model_round_trip"] = f"""
WITH {tree_sql(_TRIP_TRAIN, 't_')}
SELECT id, round(prediction, 6) AS prediction FROM ({route_sql(_TRIP_VALID, 't_nodes')}) s"""


ORACLES["schema_listing"] = """
SELECT * FROM (VALUES
  (0, 'id', 'string', true), (1, 'vendor_id', 'bigint', true), (2, 'passenger_count', 'bigint', true),
  (3, 'pickup_datetime', 'timestamp_ntz', true), (4, 'pickup_longitude', 'double', true),
  (5, 'pickup_latitude', 'double', true), (6, 'dropoff_longitude', 'double', true),
  (7, 'dropoff_latitude', 'double', true), (8, 'store_and_fwd_flag', 'string', true),
  (9, 'trip_duration', 'double', true)) AS t(position, "column", type, nullable)"""


ORACLES["parquet_round_trip"] = f"""
WITH c AS ({FRAUD_CLEAN}), s AS (SELECT stddev_samp(f1) AS s1, stddev_samp(f2) AS s2, stddev_samp(f3) AS s3 FROM c)
SELECT round(f1, 6) AS f1, round(f2, 6) AS f2, round(f3, 6) AS f3,
       round(CASE WHEN s1 > 0 THEN f1 / s1 ELSE 0.0 END, 6) AS scaled_f1,
       round(CASE WHEN s2 > 0 THEN f2 / s2 ELSE 0.0 END, 6) AS scaled_f2,
       round(CASE WHEN s3 > 0 THEN f3 / s3 ELSE 0.0 END, 6) AS scaled_f3, round(label, 6) AS label
FROM c, s"""
