"""Column profiling (D1–D18): every report is one aggregation pass.

Wide one-row aggregates are turned into one row per column with
``inline(array(struct, ...))`` — a projection, not another job.  Grouped
reports (frequencies, histograms, duplicate groups) are hash aggregates whose
map-side partial phase shrinks hot keys before the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from quarry.functions.columns import safe_div

# Quantile points of the reference's summary, histogram bins,
# and the correlation denominator floor.
QUANTILES = (0.25, 0.5, 0.75)
HISTOGRAM_BINS = 50
CORR_FLOOR = 1e-10


def _is_float(df: DataFrame, c: str) -> bool:
    return isinstance(df.schema[c].dataType, (DoubleType, FloatType))


def _per_column(agg_row: DataFrame, columns: Sequence[str], fields: dict[str, str]) -> DataFrame:
    """One-row wide aggregate → one row per column (``column`` + fields)."""
    rows = F.array(
        *[
            F.struct(
                F.lit(c).alias("column"),
                *[
                    (F.expr if "[" in pattern else F.col)(pattern.format(c=c)).alias(name)
                    for name, pattern in fields.items()
                ],
            )
            for c in columns
        ]
    )
    return agg_row.select(F.inline(rows))


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("rows"))


def missing_counts(df: DataFrame, columns: Sequence[str] | None = None, nan: bool = True) -> DataFrame:
    """``(column, missing)``: NULL, or NaN for float columns when ``nan``."""
    columns = list(columns or df.columns)
    aggs = []
    for c in columns:
        cond = F.col(c).isNull()
        if nan and _is_float(df, c):
            cond = cond | F.isnan(c)
        aggs.append(F.count_if(cond).alias(f"m_{c}"))
    return _per_column(df.agg(*aggs), columns, {"missing": "m_{c}"})


def describe(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``count, mean, stddev (sample), min, max`` per column, typed."""
    aggs = []
    for c in columns:
        x = F.col(c).cast("double")
        aggs += [
            F.count(x).alias(f"n_{c}"),
            F.avg(x).alias(f"mean_{c}"),
            F.stddev_samp(x).alias(f"sd_{c}"),
            F.min(x).alias(f"min_{c}"),
            F.max(x).alias(f"max_{c}"),
        ]
    return _per_column(
        df.agg(*aggs),
        columns,
        {"count": "n_{c}", "mean": "mean_{c}", "stddev": "sd_{c}", "min": "min_{c}", "max": "max_{c}"},
    )


def feature_summary(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``mean, stddev (population), min, max`` per column."""
    aggs = []
    for c in columns:
        x = F.col(c).cast("double")
        aggs += [
            F.avg(x).alias(f"mean_{c}"),
            F.stddev_pop(x).alias(f"sd_{c}"),
            F.min(x).alias(f"min_{c}"),
            F.max(x).alias(f"max_{c}"),
        ]
    return _per_column(
        df.agg(*aggs), columns, {"mean": "mean_{c}", "stddev": "sd_{c}", "min": "min_{c}", "max": "max_{c}"}
    )


def min_max(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    aggs = []
    for c in columns:
        aggs += [F.min(c).cast("double").alias(f"min_{c}"), F.max(c).cast("double").alias(f"max_{c}")]
    return _per_column(df.agg(*aggs), columns, {"min": "min_{c}", "max": "max_{c}"})


def quantile_summary(
    df: DataFrame, columns: Sequence[str], quantiles: Sequence[float] = QUANTILES, accuracy: int = 10_000
) -> DataFrame:
    """``min, q25, q50, q75, max`` per column via ``percentile_approx``.

    A sketch: each quantile's rank is off by up to ``n / accuracy``, so its
    error grows with the rows.  ``exact_quantiles`` has none.
    """
    aggs = []
    for c in columns:
        x = F.col(c).cast("double")
        aggs += [
            F.min(x).alias(f"min_{c}"),
            F.percentile_approx(x, list(quantiles), accuracy).alias(f"q_{c}"),
            F.max(x).alias(f"max_{c}"),
        ]
    fields = {"min": "min_{c}"}
    for i, q in enumerate(quantiles):
        fields[f"q{int(round(q * 100))}"] = "q_{c}[" + str(i) + "]"
    fields["max"] = "max_{c}"
    return _per_column(df.agg(*aggs), columns, fields)


def exact_quantiles(
    df: DataFrame, columns: Sequence[str], quantiles: Sequence[float] = QUANTILES
) -> DataFrame:
    """``min, q.., max`` per column, exactly: the q-quantile is the smallest
    value whose cumulative count reaches ``q·n`` (rank ``⌈q·n⌉``).

    No sketch memory: values are counted per (column, value) — a partial
    aggregate, so a value held by a third of all rows is one row — then
    ranked by the distributed running totals of ``quarry.plans.prefix``; the
    per-column row counts (one row per column) set the target ranks.
    """
    import math

    from quarry.plans.prefix import running_totals

    cols = list(columns)
    values = df.select(
        F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value")) for c in cols]))
    ).filter(F.col("value").isNotNull())
    counts = values.groupBy("column", "value").agg(F.count(F.lit(1)).alias("c"))
    ranked = running_totals(counts, [F.asc("value")], {"c": F.col("c")}, group=["column"], max_groups=len(cols))
    # row counts a column, from the stored value counts
    n_by_col = {r["column"]: int(r["n"]) for r in ranked.groupBy("column").agg(F.sum("c").alias("n")).collect()}
    aggs = [F.min("value").alias("min")]
    for q in quantiles:
        target = F.lit(None).cast("bigint")
        for c in cols:
            r = max(1, math.ceil(q * n_by_col.get(c, 0)))
            target = F.when(F.col("column") == c, F.lit(r)).otherwise(target)
        aggs.append(F.min(F.when(F.col("cum_c") >= target, F.col("value"))).alias(f"q{int(round(q * 100))}"))
    aggs.append(F.max("value").alias("max"))
    return ranked.groupBy("column").agg(*aggs)


def label_correlation(df: DataFrame, columns: Sequence[str], label: str = "label") -> DataFrame:
    """Pearson correlation of each column with the label, denominator
    ``sqrt(max(var_x·var_y, 1e-10))`` so a constant column gives 0 instead
    of a division error.

    The reference sums raw moments (Σx², Σxy), which cancel catastrophically
    for large-mean columns over billions of rows; Spark's ``covar_pop`` /
    ``var_pop`` merge centred moments per task, so the same formula stays
    accurate at scale."""
    y = F.col(label).cast("double")
    aggs = [F.count(F.lit(1)).alias("n"), F.var_pop(y).alias("vy")]
    for c in columns:
        x = F.col(c).cast("double")
        aggs += [F.covar_pop(x, y).alias(f"cov_{c}"), F.var_pop(x).alias(f"vx_{c}")]
    moments = df.agg(*aggs)
    cols = []
    for c in columns:
        corr = F.when(F.col("n") == 0, F.lit(0.0)).otherwise(
            F.col(f"cov_{c}") / F.sqrt(F.greatest(F.col(f"vx_{c}") * F.col("vy"), F.lit(CORR_FLOOR)))
        )
        cols.append(corr.alias(f"r_{c}"))
    return _per_column(moments.select(*cols), columns, {"correlation": "r_{c}"})


def target_stats(df: DataFrame, target: str) -> DataFrame:
    """``n, mean (0.0 when empty), variance (population, 0.0 when empty)``."""
    y = F.col(target).cast("double")
    return df.agg(
        F.count(y).alias("n"),
        F.coalesce(F.avg(y), F.lit(0.0)).alias("mean"),
        F.coalesce(F.var_pop(y), F.lit(0.0)).alias("variance"),
    )


def frequency(df: DataFrame, column: str) -> DataFrame:
    """``(value, count)`` ordered by value (NULL first, like Spark's ascending)."""
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("count")).orderBy(F.asc_nulls_first(column))


def class_distribution(df: DataFrame, label: str = "label") -> DataFrame:
    """``(label, count, percent)``: one grouped pass; the total row count is
    a one-row aggregate entering the percentage as a literal."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("count"))
    total = counts.agg(F.sum("count").alias("t")).first()["t"] or 0
    pct = F.lit(0.0) if total == 0 else F.col("count") / F.lit(float(total)) * 100.0
    return counts.select(label, "count", pct.alias("percent"))


def duplicate_summary(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """``rows, distinct_rows, duplicate_rows (extra copies), duplicate_groups``."""
    cols = list(columns or df.columns)
    groups = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("_n"))
    return groups.agg(
        F.sum("_n").cast("bigint").alias("rows"),
        F.count(F.lit(1)).alias("distinct_rows"),
        (F.sum("_n") - F.count(F.lit(1))).cast("bigint").alias("duplicate_rows"),
        F.count_if(F.col("_n") > 1).alias("duplicate_groups"),
    )


def histogram(df: DataFrame, columns: Sequence[str], bins: int = HISTOGRAM_BINS) -> DataFrame:
    """Equal-width histogram of every column in one grouped pass.

    Edges come from one min/max aggregate (literals); the top edge falls in
    the last bin; NULL and NaN are skipped; a constant column has one bin.
    Output ``(column, bin, lo, hi, count)``.
    """
    stats = df.agg(
        *[F.min(F.col(c).cast("double")).alias(f"lo_{c}") for c in columns],
        *[F.max(F.col(c).cast("double")).alias(f"hi_{c}") for c in columns],
    ).first()
    structs = []
    for c in columns:
        lo, hi = stats[f"lo_{c}"], stats[f"hi_{c}"]
        if lo is None:
            continue
        width = (hi - lo) / bins
        x = F.col(c).cast("double")
        if width > 0:
            b = F.least(F.lit(bins - 1), F.floor((x - F.lit(lo)) / F.lit(width))).cast("bigint")
        else:
            b = F.lit(0).cast("bigint")
        b = F.when(x.isNull() | F.isnan(x), F.lit(None).cast("bigint")).otherwise(b)
        structs.append(
            F.struct(F.lit(c).alias("column"), b.alias("bin"), F.lit(lo).alias("_lo"), F.lit(width).alias("_w"))
        )
    if not structs:
        return df.sparkSession.createDataFrame([], "column string, bin bigint, lo double, hi double, count bigint")
    exploded = df.select(F.inline(F.array(*structs))).filter(F.col("bin").isNotNull())
    counted = exploded.groupBy("column", "bin", "_lo", "_w").agg(F.count(F.lit(1)).alias("count"))
    return counted.select(
        "column",
        "bin",
        (F.col("_lo") + F.col("bin") * F.col("_w")).alias("lo"),
        (F.col("_lo") + (F.col("bin") + 1) * F.col("_w")).alias("hi"),
        "count",
    )


def cleaning_report(parsed: DataFrame, valid: Column, value_cols: Sequence[str], n_features: int) -> DataFrame:
    """Raw, valid, rejected, distinct and duplicate counts in one grouped pass.

    ``parsed`` holds every input line with its parsed values; ``valid`` marks
    the accepted ones.  Rows are grouped by (valid, values) — the partial
    aggregate collapses copies map-side — and the report is summed from the
    groups.
    """
    groups = parsed.groupBy(valid.alias("_ok"), *value_cols).agg(F.count(F.lit(1)).alias("_n"))
    ok = F.col("_ok")
    rep = groups.agg(
        F.sum("_n").cast("bigint").alias("raw_lines"),
        F.coalesce(F.sum(F.when(ok, F.col("_n"))), F.lit(0)).cast("bigint").alias("valid"),
        F.count_if(ok).alias("distinct_valid"),
    )
    return rep.select(
        "raw_lines",
        "valid",
        (F.col("raw_lines") - F.col("valid")).alias("rejected"),
        "distinct_valid",
        (F.col("valid") - F.col("distinct_valid")).alias("duplicates"),
        F.lit(n_features).cast("bigint").alias("features"),
        safe_div(F.col("valid") - F.col("distinct_valid"), F.col("valid")).alias("duplicate_share"),
    )
