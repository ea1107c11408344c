"""Fitted column transforms: min-max, standard scaling, string indexing.

Fitting is one aggregation whose single-row result comes to the driver as
plain floats; applying is Column arithmetic with those floats as literals,
so a fitted transform costs no join and no broadcast at scoring time.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed value: floor of a min-max range (the reference's epsilon).
RANGE_EPSILON = 1e-8


@dataclass(frozen=True)
class MinMax:
    columns: tuple[str, ...]
    mins: tuple[float, ...]
    maxs: tuple[float, ...]

    @property
    def ranges(self) -> tuple[float, ...]:
        return tuple(max(hi - lo, RANGE_EPSILON) for lo, hi in zip(self.mins, self.maxs))

    def transform(self, df: DataFrame, suffix: str = "") -> DataFrame:
        cols = {
            c + suffix: (F.col(c) - F.lit(lo)) / F.lit(r)
            for c, lo, r in zip(self.columns, self.mins, self.ranges)
        }
        return df.withColumns(cols)


def fit_minmax(df: DataFrame, columns: Sequence[str], row=None) -> MinMax:
    """Fit from one aggregate (or from ``row`` holding ``lo_c``/``hi_c``,
    when the caller folded the min/max into a larger aggregate)."""
    if row is None:
        row = df.agg(*minmax_aggs(columns)).first()
    mins = tuple(float(row[f"lo_{c}"]) if row[f"lo_{c}"] is not None else 0.0 for c in columns)
    maxs = tuple(float(row[f"hi_{c}"]) if row[f"hi_{c}"] is not None else 0.0 for c in columns)
    return MinMax(tuple(columns), mins, maxs)


def minmax_aggs(columns: Sequence[str]) -> list:
    aggs = []
    for c in columns:
        aggs += [F.min(c).alias(f"lo_{c}"), F.max(c).alias(f"hi_{c}")]
    return aggs


@dataclass(frozen=True)
class StdScale:
    columns: tuple[str, ...]
    stds: tuple[float, ...]

    def transform(self, df: DataFrame, suffix: str = "") -> DataFrame:
        """``x / stddev_samp`` without centring; zero variance gives 0.0."""
        cols = {
            c + suffix: (F.col(c) / F.lit(s)) if s > 0 else F.lit(0.0)
            for c, s in zip(self.columns, self.stds)
        }
        return df.withColumns(cols)


def fit_std(df: DataFrame, columns: Sequence[str]) -> StdScale:
    row = df.agg(*[F.stddev_samp(c).alias(c) for c in columns]).first()
    return StdScale(tuple(columns), tuple(float(row[c] or 0.0) for c in columns))


@dataclass(frozen=True)
class StringIndex:
    """Label → index by descending frequency, ties alphabetical (StringIndexer).

    The index stays a table (value, count, index) of any number of labels; it
    is joined, and the planner broadcasts it where its size allows."""

    column: str
    table: DataFrame
    n_labels: int

    def transform(self, df: DataFrame, output: str, handle_invalid: str = "keep") -> DataFrame:
        """Add ``output``: unseen and NULL values get the number of labels
        (``keep``), NULL (``null``) or lose their row (``skip``)."""
        index = self.table.select(F.col(self.column).cast("string").alias("_label"), F.col("index").alias("_index"))
        out = df.join(index, F.col(self.column).cast("string") == F.col("_label"), "left")
        value = F.coalesce("_index", F.lit(float(self.n_labels))) if handle_invalid == "keep" else F.col("_index")
        out = out.withColumn(output, value).drop("_label", "_index")
        return out.filter(F.col(output).isNotNull()) if handle_invalid == "skip" else out


def fit_string_index(df: DataFrame, column: str) -> StringIndex:
    """Fit on the distinct values, however many; the ranked table is stored
    once (a reliable checkpoint) and read by every transform."""
    from quarry.session import materialize

    table = materialize(string_index_table(df, column), balance=False, cache=False)
    return StringIndex(column, table, table.count())


def string_index_table(df: DataFrame, column: str) -> DataFrame:
    """The fitted index as a table ``(value, count, index)``.

    Distinct values are counted with a partial aggregate, then ranked by
    (count desc, value asc) with the distributed running count of
    ``quarry.plans.prefix`` — no single-task window even for a
    high-cardinality column."""
    from quarry.plans.prefix import running_totals

    counts = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("count"))
    ranked = running_totals(counts, [F.desc("count"), F.asc(column)], {"rank": F.lit(1)})
    return ranked.select(column, "count", (F.col("cum_rank") - 1).cast("double").alias("index"))
