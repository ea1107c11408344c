"""Twins of the ingest queries: the trips fixture, the damaged text lines,
the Python-float grammar and both parsers as SQL, row filters and the
key-hash split, the deterministic first rows.
"""

from __future__ import annotations

from quarry.oracles.base import FRAUD, FRAUD_SPLIT, ORACLES, r


def d(x) -> str:
    """A DOUBLE literal."""
    return f"{float(x)!r}::DOUBLE"


TRIP_LON = "(-74.4::DOUBLE + ((event_id * 37) % 800) / 1000.0::DOUBLE)"


TRIPS = f"""
SELECT CAST(event_id AS VARCHAR) AS id,
       1 + user_id % 3 AS vendor_id,
       event_id % 11 AS passenger_count,
       ts AS pickup_datetime,
       {TRIP_LON} AS pickup_longitude,
       40.4::DOUBLE + ((event_id * 53) % 700) / 1000.0::DOUBLE AS pickup_latitude,
       -74.4::DOUBLE + ((event_id * 71 + user_id) % 800) / 1000.0::DOUBLE AS dropoff_longitude,
       40.4::DOUBLE + ((event_id * 97 + user_id) % 700) / 1000.0::DOUBLE AS dropoff_latitude,
       CASE WHEN event_id % 997 = 0 THEN NULL WHEN event_id % 20 = 0 THEN 'Y' ELSE 'N' END AS store_and_fwd_flag,
       CASE WHEN event_id % 500 = 0 THEN 40000.0::DOUBLE
            ELSE value * 20.0::DOUBLE + 8000.0::DOUBLE * abs({TRIP_LON} + 74.0::DOUBLE)
                 + CASE WHEN hour(ts) BETWEEN 7 AND 9 THEN 1500.0::DOUBLE ELSE 0.0::DOUBLE END
       END AS trip_duration
FROM events"""


FRAUD_HEADER = "time,f1,f2,f3,label"


_M = "((l_orderkey * 31 + l_linenumber) % 100)"


_T = f"(CASE WHEN {_M} = 8 THEN 'x' ELSE CAST(l_orderkey AS VARCHAR) END)"


_F1 = "CAST(CAST(l_quantity AS BIGINT) AS VARCHAR)"


_F2 = "CAST(CAST(round(l_discount * 100.0::DOUBLE) AS BIGINT) AS VARCHAR)"


_F3 = "CAST(CAST(round(l_tax * 100.0::DOUBLE) AS BIGINT) AS VARCHAR)"


_LAB = "(CASE WHEN l_quantity * l_discount > 4.0::DOUBLE THEN '1' ELSE '0' END)"


FRAUD_LINES = f"""
SELECT CASE WHEN {_M} = 6 THEN '{FRAUD_HEADER}'
            WHEN {_M} = 4 THEN concat_ws(',', {_T}, f1, f2, f3)
            ELSE concat_ws(',', {_T}, f1, f2, f3, lab) END AS value
FROM (SELECT *,
        CASE WHEN {_M} = 1 THEN 'NaN' WHEN {_M} = 5 THEN '"' || {_F1} || '"' ELSE {_F1} END AS f1,
        CASE WHEN {_M} = 0 THEN '' WHEN {_M} = 7 THEN ' ' || {_F2} || ' ' ELSE {_F2} END AS f2,
        CASE WHEN {_M} = 2 THEN 'abc' ELSE {_F3} END AS f3,
        CASE WHEN {_M} = 3 THEN '2' WHEN {_M} = 9 THEN '"' || {_LAB} || '"' ELSE {_LAB} END AS lab
      FROM lineitem) li"""


PY_FLOAT_RE = (
    r"[+-]?(?:(?:[0-9](?:_?[0-9])*(?:\.(?:[0-9](?:_?[0-9])*)?)?|\.[0-9](?:_?[0-9])*)"
    r"(?:[eE][+-]?[0-9](?:_?[0-9])*)?|(?i:inf|infinity|nan))"
)


def strip(x: str) -> str:
    return f"regexp_replace({x}, '^\\s+|\\s+$', '', 'g')"


def py_float(x: str) -> str:
    s = strip(x)
    return (
        f"(CASE WHEN {s} IS NULL OR NOT regexp_full_match({s}, '{PY_FLOAT_RE}') THEN NULL::DOUBLE "
        f"WHEN lower({s}) IN ('nan', '+nan', '-nan') THEN 'nan'::DOUBLE "
        f"ELSE TRY_CAST(replace({s}, '_', '') AS DOUBLE) END)"
    )


def clean_field(x: str) -> str:
    return f"replace({strip(x)}, '\"', '')"


def parse_labelled(lines: str, names: list[str], skip: tuple = ()) -> str:
    """``value, reason, <names…>`` like ``quarry.sources.text.parse_labelled``."""
    n = len(names)
    checks = [(f"len(parts) <> {n}", "field_count")]
    values = []
    for i, name in enumerate(names[:-1]):
        if name in skip:
            continue
        c = clean_field(f"parts[{i + 1}]")
        checks.append((f"({c} = '' OR lower({c}) = 'nan')", f"missing:{name}"))
        checks.append((f"{py_float(c)} IS NULL", f"not_numeric:{name}"))
        values.append((name, py_float(c)))
    lab = py_float(clean_field(f"parts[{n}]"))
    checks.append((f"{lab} IS NULL", f"not_numeric:{names[-1]}"))
    checks.append((f"{lab} NOT IN (0.0, 1.0)", "bad_label"))
    values.append((names[-1], lab))
    reason = "CASE " + " ".join(f"WHEN {c} THEN '{r}'" for c, r in checks) + " ELSE NULL END"
    vals = ", ".join(f"CASE WHEN ({reason}) IS NULL THEN {v} END AS {k}" for k, v in values)
    return f"""
SELECT value, {reason} AS reason, {vals}
FROM (SELECT value, string_split(value, ',') AS parts FROM ({lines}) l) p"""


def parse_positional(lines: str, positions: dict, bounds: dict | None, members: dict | None) -> str:
    need = max(positions.values())
    checks = [(f"len(parts) <= {need}", "field_count")]
    vals = {k: py_float(f"parts[{p + 1}]") for k, p in positions.items()}
    for k in positions:
        checks.append((f"{vals[k]} IS NULL", f"not_numeric:{k}"))
    for k, (lo, hi) in (bounds or {}).items():
        checks.append((f"NOT ({vals[k]} BETWEEN {d(lo)} AND {d(hi)})", f"out_of_range:{k}"))
    for k, allowed in (members or {}).items():
        checks.append((f"{vals[k]} NOT IN ({', '.join(str(float(a)) for a in allowed)})", f"not_member:{k}"))
    reason = "CASE " + " ".join(f"WHEN {c} THEN '{r}'" for c, r in checks) + " ELSE NULL END"
    cols = ", ".join(f"CASE WHEN ({reason}) IS NULL THEN {v} END AS {k}" for k, v in vals.items())
    return f"""
SELECT value, {reason} AS reason, CASE WHEN len(parts) > {need} THEN parts[1] END AS id, {cols}
FROM (SELECT value, string_split(value, ',') AS parts FROM ({lines}) l) p"""


_FRAUD_BODY = f"SELECT value FROM ({FRAUD_LINES}) fl WHERE value <> '{FRAUD_HEADER}'"


FRAUD_PARSED = parse_labelled(_FRAUD_BODY, FRAUD_HEADER.split(","))


FRAUD_PARSED_NO_TIME = parse_labelled(_FRAUD_BODY, FRAUD_HEADER.split(","), skip=("time",))


ORACLES["parse_fraud_lines"] = f"SELECT time, f1, f2, f3, label FROM ({FRAUD_PARSED}) x WHERE reason IS NULL"


ORACLES["parse_fraud_lines_no_time"] = (
    f"SELECT f1, f2, f3, label FROM ({FRAUD_PARSED_NO_TIME}) x WHERE reason IS NULL"
)


ORACLES["parse_rejects"] = f"SELECT value, reason FROM ({FRAUD_PARSED}) x WHERE reason IS NOT NULL"


ORACLES["cleaning_report"] = f"""
WITH g AS (SELECT reason IS NULL AS ok, f1, f2, f3, label, count(*) AS n
           FROM ({FRAUD_PARSED_NO_TIME}) x GROUP BY ALL),
     r AS (SELECT sum(n)::BIGINT AS raw_lines, coalesce(sum(n) FILTER (WHERE ok), 0)::BIGINT AS valid,
                  count_if(ok)::BIGINT AS distinct_valid FROM g)
SELECT raw_lines, valid, raw_lines - valid AS rejected, distinct_valid, valid - distinct_valid AS duplicates,
       3::BIGINT AS features,
       round(CASE WHEN valid = 0 THEN 0.0 ELSE (valid - distinct_valid)::DOUBLE / valid END, 6) AS duplicate_share
FROM r"""


# Trip lines (train and test layouts).
TRIP_HEADER = (
    "id,vendor_id,pickup_datetime,dropoff_datetime,passenger_count,pickup_longitude,"
    "pickup_latitude,dropoff_longitude,dropoff_latitude,store_and_fwd_flag,trip_duration"
)


TRIP_TEST_HEADER = (
    "id,vendor_id,pickup_datetime,passenger_count,pickup_longitude,"
    "pickup_latitude,dropoff_longitude,dropoff_latitude,store_and_fwd_flag"
)


def trip_lines(test: bool) -> str:
    m = "((event_id * 31 + user_id) % 100)"
    ts = "strftime(pickup_datetime, '%Y-%m-%d %H:%M:%S')"
    pc = f"CASE WHEN {m} = 0 THEN '' ELSE CAST(passenger_count AS VARCHAR) END"
    plon = f"CASE WHEN {m} = 1 THEN 'abc' ELSE printf('%.3f', pickup_longitude) END"
    head = ["id", "CAST(vendor_id AS VARCHAR)", ts] + ([] if test else [ts])
    body = [pc, plon, "printf('%.3f', pickup_latitude)", "printf('%.3f', dropoff_longitude)",
            "printf('%.3f', dropoff_latitude)", "coalesce(store_and_fwd_flag, '')"]
    if not test:
        body.append("printf('%.1f', trip_duration)")
    full = f"concat_ws(',', {', '.join(head + body)})"
    short = f"concat_ws(',', {', '.join(head + body[:-1])})"
    header = TRIP_TEST_HEADER if test else TRIP_HEADER
    src = TRIPS.replace("FROM events", ", event_id, user_id FROM events")
    return f"""
SELECT CASE WHEN {m} = 3 THEN '{header}' WHEN {m} = 2 THEN {short} ELSE {full} END AS value
FROM ({src}) t"""


TRAIN_POSITIONS = {"vendor_id": 1, "passenger_count": 4, "pickup_longitude": 5, "pickup_latitude": 6,
                   "dropoff_longitude": 7, "dropoff_latitude": 8, "trip_duration": 10}


TEST_POSITIONS = {"vendor_id": 1, "passenger_count": 3, "pickup_longitude": 4, "pickup_latitude": 5,
                  "dropoff_longitude": 6, "dropoff_latitude": 7}


TRIP_BOUNDS = {"pickup_longitude": (-74.3, -73.7), "dropoff_longitude": (-74.3, -73.7),
               "pickup_latitude": (40.5, 41.0), "dropoff_latitude": (40.5, 41.0),
               "passenger_count": (1.0, 9.0), "trip_duration": (60.0, 36000.0)}


VENDORS = {"vendor_id": (1, 2)}


_TRAIN_BODY = f"SELECT value FROM ({trip_lines(False)}) t WHERE value <> '{TRIP_HEADER}'"


_TEST_BODY = f"SELECT value FROM ({trip_lines(True)}) t WHERE {strip('value')} <> '{TRIP_TEST_HEADER}'"


TRIP_TRAIN_PARSED = parse_positional(_TRAIN_BODY, TRAIN_POSITIONS, TRIP_BOUNDS, VENDORS)


TRIP_TEST_PARSED = parse_positional(
    _TEST_BODY, TEST_POSITIONS, {k: v for k, v in TRIP_BOUNDS.items() if k != "trip_duration"}, VENDORS
)


_TRAIN_COLS = "id, " + ", ".join(TRAIN_POSITIONS)


_TEST_COLS = "id, " + ", ".join(TEST_POSITIONS)


ORACLES["parse_trip_lines"] = f"SELECT {_TRAIN_COLS} FROM ({TRIP_TRAIN_PARSED}) x WHERE reason IS NULL"


ORACLES["parse_trip_test_lines"] = f"SELECT {_TEST_COLS} FROM ({TRIP_TEST_PARSED}) x WHERE reason IS NULL"


ORACLES["parse_labeled_points"] = (
    f"SELECT {_TRAIN_COLS} FROM ({parse_positional(_TRAIN_BODY, TRAIN_POSITIONS, None, None)}) x "
    "WHERE reason IS NULL"
)


ORACLES["parse_feature_points"] = (
    f"SELECT {_TEST_COLS} FROM ({parse_positional(_TEST_BODY, TEST_POSITIONS, None, None)}) x "
    "WHERE reason IS NULL"
)


ORACLES["trip_reject_reasons"] = (
    f"SELECT reason, count(*)::BIGINT AS lines FROM ({TRIP_TRAIN_PARSED}) x WHERE reason IS NOT NULL GROUP BY reason"
)


TRIP_COLS = ("id, vendor_id, passenger_count, pickup_datetime, pickup_longitude, pickup_latitude, "
             "dropoff_longitude, dropoff_latitude, store_and_fwd_flag, trip_duration")


ORACLES["dropna_rows"] = f"SELECT * FROM ({TRIPS}) t WHERE store_and_fwd_flag IS NOT NULL"


ORACLES["dedup_rows"] = f"SELECT DISTINCT * FROM ({FRAUD}) f"


ORACLES["range_filter"] = f"""
SELECT * FROM ({TRIPS}) t
WHERE trip_duration BETWEEN 60.0 AND 14400.0
  AND pickup_latitude BETWEEN 40.0 AND 41.0 AND pickup_longitude BETWEEN -74.0 AND -73.0
  AND dropoff_latitude BETWEEN 40.0 AND 41.0 AND dropoff_longitude BETWEEN -74.0 AND -73.0"""


TRIPS_OUTLIER = f"""
SELECT * FROM ({TRIPS}) t
WHERE pickup_longitude BETWEEN -74.3 AND -73.7 AND dropoff_longitude BETWEEN -74.3 AND -73.7
  AND pickup_latitude BETWEEN 40.5 AND 41.0 AND dropoff_latitude BETWEEN 40.5 AND 41.0
  AND passenger_count BETWEEN 1 AND 9 AND trip_duration BETWEEN 60.0 AND 36000.0
  AND vendor_id IN (1, 2)"""


ORACLES["outlier_filter"] = TRIPS_OUTLIER


ORACLES["hash_split_counts"] = f"""
SELECT CASE WHEN bucket < 80 THEN 0 ELSE 1 END::BIGINT AS part, count(*)::BIGINT AS rows
FROM ({FRAUD_SPLIT}) s GROUP BY 1"""


ORACLES["first_rows"] = f"SELECT * FROM ({TRIPS}) t ORDER BY id LIMIT 5"
