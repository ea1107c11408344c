"""Twins of the feature queries: time parts, haversine, string index,
scaling.
"""

from __future__ import annotations

from quarry.oracles.base import FRAUD_CLEAN, ORACLES, hash_bucket
from quarry.oracles.ingest import TRIPS


def _hav(lon1, lat1, lon2, lat2) -> str:
    a = (f"pow(sin(radians({lat2} - {lat1}) / 2.0), 2) + cos(radians({lat1})) * cos(radians({lat2})) "
         f"* pow(sin(radians({lon2} - {lon1}) / 2.0), 2)")
    a = f"least(greatest({a}, 0.0), 1.0)"
    return f"12742.0 * atan2(sqrt({a}), sqrt(1.0 - {a}))"


ORACLES["trip_features"] = f"""
SELECT id, hour(pickup_datetime)::INTEGER AS pickup_hour, (dayofweek(pickup_datetime) + 1)::INTEGER AS pickup_dayofweek,
       round({_hav('pickup_longitude', 'pickup_latitude', 'dropoff_longitude', 'dropoff_latitude')}, 6) AS distance_km
FROM ({TRIPS}) t"""


_FLAG_RANKS = """
SELECT store_and_fwd_flag AS value, count(*)::BIGINT AS count,
       (row_number() OVER (ORDER BY count(*) DESC, store_and_fwd_flag) - 1)::DOUBLE AS index
FROM ({src}) t WHERE store_and_fwd_flag IS NOT NULL GROUP BY store_and_fwd_flag"""


ORACLES["flag_index"] = _FLAG_RANKS.format(src=TRIPS)


_TRIP_SPLIT = f"SELECT *, {hash_bucket('id', 7)} AS bucket FROM ({TRIPS}) t"


ORACLES["index_reuse"] = f"""
WITH ranks AS ({_FLAG_RANKS.format(src=f"SELECT * FROM ({_TRIP_SPLIT}) s WHERE bucket < 80")}),
     nl AS (SELECT count(*)::DOUBLE AS n FROM ranks)
SELECT t.id, t.store_and_fwd_flag, coalesce(r.index, nl.n) AS flag_index
FROM (SELECT * FROM ({_TRIP_SPLIT}) s WHERE bucket >= 80) t LEFT JOIN ranks r ON t.store_and_fwd_flag = r.value, nl"""


ORACLES["standard_scale"] = f"""
WITH c AS ({FRAUD_CLEAN}), s AS (SELECT stddev_samp(f1) AS s1, stddev_samp(f2) AS s2, stddev_samp(f3) AS s3 FROM c)
SELECT round(CASE WHEN s1 > 0 THEN f1 / s1 ELSE 0.0 END, 6) AS f1, round(CASE WHEN s2 > 0 THEN f2 / s2 ELSE 0.0 END, 6) AS f2,
       round(CASE WHEN s3 > 0 THEN f3 / s3 ELSE 0.0 END, 6) AS f3, round(label, 6) AS label FROM c, s"""


ORACLES["minmax_scale"] = f"""
WITH c AS ({FRAUD_CLEAN}),
     s AS (SELECT min(f1) AS lo1, greatest(max(f1) - min(f1), 1e-8) AS r1, min(f2) AS lo2,
                  greatest(max(f2) - min(f2), 1e-8) AS r2, min(f3) AS lo3, greatest(max(f3) - min(f3), 1e-8) AS r3 FROM c)
SELECT round((f1 - lo1) / r1, 6) AS f1, round((f2 - lo2) / r2, 6) AS f2, round((f3 - lo3) / r3, 6) AS f3,
       round(label, 6) AS label FROM c, s"""


ORACLES["pickup_time_parts"] = f"""
SELECT id, strftime(pickup_datetime, '%Y-%m-%d %H:%M:%S') AS pickup_text,
       hour(strptime(strftime(pickup_datetime, '%Y-%m-%d %H:%M:%S'), '%Y-%m-%d %H:%M:%S'))::INTEGER AS pickup_hour,
       (dayofweek(strptime(strftime(pickup_datetime, '%Y-%m-%d %H:%M:%S'), '%Y-%m-%d %H:%M:%S')) + 1)::INTEGER AS pickup_dayofweek
FROM ({TRIPS}) t"""
