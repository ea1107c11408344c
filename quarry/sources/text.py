"""Delimited text scan and validated parsing.

A parser turns a DataFrame of lines (``value``) into typed columns plus a
``reason`` column: NULL for accepted lines, otherwise the first failed check
in the reference's order.  ``accepted``/``rejected`` split that one frame, so
rejects are data rather than printed warnings.  All checks are Column
expressions: no Python per row.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.functions.parse import clean_field, fields, is_missing_token, py_float, strip

REASON = "reason"


def first_line(lines: DataFrame) -> str | None:
    """The header as the reference takes it: the first line of the input."""
    row = lines.limit(1).first()
    return None if row is None else row[0]


def drop_header(lines: DataFrame, header: str, strip_both: bool = False) -> DataFrame:
    """Drop *every* line equal to the header (A1); ``strip_both`` compares
    stripped text on both sides (the reference's test-file rule)."""
    if strip_both:
        return lines.filter(strip(F.col("value")) != F.lit(header.strip()))
    return lines.filter(F.col("value") != F.lit(header))


def _keep_if(parsed: DataFrame, cond: Column, cols: Sequence[str]) -> DataFrame:
    """Rows where ``cond`` holds, as a 0-or-1-row ``inline`` per input row.

    A plain ``filter(reason IS NULL)`` is pushed below the parsing
    projections and Catalyst inlines the whole parse into the predicate, so
    every line would be parsed twice; a generator is not pushed through.
    """
    row = F.array(F.struct(*[F.col(c) for c in cols]))
    return parsed.select(F.inline(F.when(cond, row)))


def accepted(parsed: DataFrame) -> DataFrame:
    cols = [c for c in parsed.columns if c not in (REASON, "value")]
    return _keep_if(parsed, F.col(REASON).isNull(), cols)


def rejected(parsed: DataFrame) -> DataFrame:
    return _keep_if(parsed, F.col(REASON).isNotNull(), ["value", REASON])


def _first_failure(checks: Sequence[tuple[Column, str]]) -> Column:
    """One flat CASE: the first failed check names the reason, else NULL."""
    expr = None
    for cond, reason in checks:
        expr = F.when(cond, F.lit(reason)) if expr is None else expr.when(cond, F.lit(reason))
    return expr


def parse_labelled(
    lines: DataFrame,
    names: Sequence[str],
    skip: Sequence[str] = (),
    labels: Sequence[float] = (0.0, 1.0),
) -> DataFrame:
    """Strict parse of ``f_1,…,f_k,label`` lines (the fraud rule, A2/A3).

    Exactly ``len(names)`` fields; each feature stripped and unquoted, empty
    or ``nan`` is missing, then it must be a float; the label (last field)
    must parse and be one of ``labels``.  Features named in ``skip`` are
    neither validated nor returned (A3 drops ``Time``).

    The work is staged in three projections (fields → cleaned text → parsed
    doubles → reason) so each field is cleaned and parsed once and the
    generated code stays small enough for whole-stage codegen.
    """
    n = len(names)
    label = names[-1]
    used = [(i, nm) for i, nm in enumerate(names[:-1]) if nm not in skip]
    parts = lines.select("value", fields(F.col("value")).alias("_parts"))
    cleaned = parts.select(
        "value",
        F.size("_parts").alias("_n"),
        *[clean_field(F.get(F.col("_parts"), i)).alias(f"_c_{nm}") for i, nm in used],
        clean_field(F.get(F.col("_parts"), n - 1)).alias(f"_c_{label}"),
    )
    typed = cleaned.select(
        "*", *[py_float(F.col(f"_c_{nm}")).alias(f"_v_{nm}") for _, nm in used + [(n - 1, label)]]
    )
    checks: list[tuple[Column, str]] = [(F.col("_n") != n, "field_count")]
    for _, nm in used:
        checks.append((is_missing_token(F.col(f"_c_{nm}")), f"missing:{nm}"))
        checks.append((F.col(f"_v_{nm}").isNull(), f"not_numeric:{nm}"))
    lab = F.col(f"_v_{label}")
    checks.append((lab.isNull(), f"not_numeric:{label}"))
    checks.append((~lab.isin(*[float(x) for x in labels]), "bad_label"))
    with_reason = typed.select("*", _first_failure(checks).alias(REASON))
    ok = F.col(REASON).isNull()
    return with_reason.select(
        "value",
        REASON,
        *[F.when(ok, F.col(f"_v_{nm}")).alias(nm) for _, nm in used + [(n - 1, label)]],
    )


def parse_positional(
    lines: DataFrame,
    positions: Mapping[str, int],
    id_position: int | None = None,
    bounds: Mapping[str, tuple[float, float]] | None = None,
    members: Mapping[str, Sequence[float]] | None = None,
) -> DataFrame:
    """Positional parse (the taxi rule, A4–A7).

    No field-count check beyond "the used positions exist"; each field is a
    Python ``float`` (which strips blanks but not quotes); then the range and
    membership filters, in the reference's order (coordinates, passengers,
    duration, vendor).  Output: ``value, reason, id`` (if any), the doubles.
    """
    need = max(list(positions.values()) + ([id_position] if id_position is not None else []))
    parts = lines.select("value", fields(F.col("value")).alias("_parts"))
    extra = []
    if id_position is not None:
        extra.append(
            F.when(F.size("_parts") > need, F.get(F.col("_parts"), id_position)).alias("id")
        )
    typed = parts.select(
        "value",
        F.size("_parts").alias("_n"),
        *extra,
        *[py_float(F.get(F.col("_parts"), pos)).alias(f"_v_{nm}") for nm, pos in positions.items()],
    )
    checks: list[tuple[Column, str]] = [(F.col("_n") <= need, "field_count")]
    for nm in positions:
        checks.append((F.col(f"_v_{nm}").isNull(), f"not_numeric:{nm}"))
    for nm, (lo, hi) in (bounds or {}).items():
        checks.append((~F.col(f"_v_{nm}").between(F.lit(lo), F.lit(hi)), f"out_of_range:{nm}"))
    for nm, allowed in (members or {}).items():
        checks.append((~F.col(f"_v_{nm}").isin(*[float(a) for a in allowed]), f"not_member:{nm}"))
    with_reason = typed.select("*", _first_failure(checks).alias(REASON))
    ok = F.col(REASON).isNull()
    return with_reason.select(
        "value",
        REASON,
        *(["id"] if id_position is not None else []),
        *[F.when(ok, F.col(f"_v_{nm}")).alias(nm) for nm in positions],
    )


# --------------------------------------------------------------- the taxi files
# Field positions of the reference's taxi train and test files.
TRAIN_POSITIONS = {
    "vendor_id": 1,
    "passenger_count": 4,
    "pickup_longitude": 5,
    "pickup_latitude": 6,
    "dropoff_longitude": 7,
    "dropoff_latitude": 8,
    "trip_duration": 10,
}
TEST_POSITIONS = {
    "vendor_id": 1,
    "passenger_count": 3,
    "pickup_longitude": 4,
    "pickup_latitude": 5,
    "dropoff_longitude": 6,
    "dropoff_latitude": 7,
}
# Order of the reference's range checks (coordinates first).
TRIP_CHECK_ORDER = (
    "pickup_longitude",
    "dropoff_longitude",
    "pickup_latitude",
    "dropoff_latitude",
    "passenger_count",
    "trip_duration",
)


def parse_trip_train(lines: DataFrame, filters: bool = True) -> DataFrame:
    """A4 (``filters``) or A6 (no filters): id, 6 features, ``trip_duration``."""
    from quarry.operators.clean import OUTLIER_BOUNDS, OUTLIER_DURATION_BOUNDS, VENDOR_MEMBERS

    b = {**OUTLIER_BOUNDS, **OUTLIER_DURATION_BOUNDS}
    bounds = {k: b[k] for k in TRIP_CHECK_ORDER} if filters else None
    return parse_positional(
        lines, TRAIN_POSITIONS, id_position=0, bounds=bounds, members=VENDOR_MEMBERS if filters else None
    )


def parse_trip_test(lines: DataFrame, filters: bool = True) -> DataFrame:
    """A5 (``filters``) or A7 (no filters): id and 6 features."""
    from quarry.operators.clean import OUTLIER_BOUNDS, VENDOR_MEMBERS

    bounds = {k: OUTLIER_BOUNDS[k] for k in TRIP_CHECK_ORDER if k in OUTLIER_BOUNDS} if filters else None
    return parse_positional(
        lines, TEST_POSITIONS, id_position=0, bounds=bounds, members=VENDOR_MEMBERS if filters else None
    )
