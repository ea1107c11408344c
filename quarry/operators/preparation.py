"""A fitted preparation as one versioned table.

Everything a scoring job must know of the training rows is a row of one table
``(version, kind, position, column, label, value, other)``:

* ``column``  the feature at ``position`` of the model, in order;
* ``bound``   inclusive range ``value .. other`` that a row must lie in;
* ``fill``    the columns a row must have (neither NULL nor NaN);
* ``scale``   the column is divided by ``value`` after subtracting ``other``;
* ``index``   the label of a string column and its index, one row a label;
* ``labels``  the number of labels of that column, given to any other label.

``fit`` learns it from training rows, ``save`` and ``load`` move it between
sessions, and ``apply`` needs nothing else: bounds, scales and the order are
literals (their number is that of the columns), the index is joined as a table,
whatever its size, and broadcast where the planner finds it small.

``apply`` keeps every row and says in ``reason`` why one cannot be scored
(``missing <column>`` or ``range <column>``, the first in the table's order),
NULL if it can: ``complete`` selects those.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.functions.scale import string_index_table

SCHEMA = "version int, kind string, position int, column string, label string, value double, other double"
VERSION = 1
REASON = "reason"


@dataclass
class Preparation:
    table: DataFrame

    def save(self, path: str) -> None:
        self.table.write.mode("overwrite").parquet(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> Preparation:
        table = spark.read.schema(SCHEMA).parquet(path)
        versions = [r["version"] for r in table.select("version").distinct().collect()]
        if versions != [VERSION]:
            raise ValueError(f"a preparation of version {VERSION} was expected, found {versions}")
        return cls(table)

    def _rows(self, kind: str) -> list:
        """Rows of a kind that has at most one a column."""
        return sorted(self.table.filter(F.col("kind") == kind).collect(), key=lambda r: r["position"])

    def features(self) -> list[str]:
        return [r["column"] for r in self._rows("column")]

    def apply(self, df: DataFrame, keep: Sequence[str] = (), with_label: bool = True, label: str | None = None) -> DataFrame:
        """``(keep.., features.., reason)`` of every row of ``df``.  Checks of
        the ``label`` column are left out without it."""
        out = df
        for r in self._rows("labels"):
            c = r["column"]
            index = self.table.filter((F.col("kind") == "index") & (F.col("column") == c)).select(F.col("label").alias("_label"), F.col("value").alias("_index"))
            joined = out.join(index, F.col(c).cast("string") == F.col("_label"), "left")
            out = joined.withColumn(f"{c}_indexed", F.coalesce("_index", F.lit(r["value"]))).drop("_label", "_index")
        reason = F.lit(None).cast("string")
        checks = []
        for r in self._rows("fill"):
            value = F.col(r["column"])
            missing = value.isNull()
            if dict(out.dtypes).get(r["column"]) in ("double", "float"):
                missing = missing | F.isnan(value)
            checks.append((r["column"], missing, f"missing {r['column']}"))
        for r in self._rows("bound"):
            checks.append((r["column"], ~F.col(r["column"]).between(r["value"], r["other"]), f"range {r['column']}"))
        for column, failed, name in reversed(checks):
            if with_label or column != label:
                reason = F.when(failed, F.lit(name)).otherwise(reason)
        scales = {r["column"]: r for r in self._rows("scale")}
        columns = []
        for c in self.features():
            value = F.col(c).cast("double")
            if c in scales:
                value = (value - F.lit(scales[c]["other"])) / F.lit(scales[c]["value"])
            columns.append(value.alias(c))
        return out.select(*keep, *columns, reason.alias(REASON))


def fit(
    train: DataFrame,
    features: Sequence[str],
    bounds: Mapping[str, tuple[float, float]] | None = None,
    required: Sequence[str] = (),
    index: Sequence[str] = (),
    scale: Sequence[str] = (),
) -> Preparation:
    """Learn from ``train``: indexes of the ``index`` columns by descending
    frequency, sample deviations of the ``scale`` columns (not centred; 1 where
    a column does not vary).  Bounds and required columns are taken as given."""
    spark = train.sparkSession
    rows = [(VERSION, "column", i, c, None, None, None) for i, c in enumerate(features)]
    rows += [(VERSION, "fill", i, c, None, None, None) for i, c in enumerate(required)]
    rows += [(VERSION, "bound", i, c, None, float(lo), float(hi)) for i, (c, (lo, hi)) in enumerate((bounds or {}).items())]
    if scale:
        got = train.agg(*[F.stddev_samp(F.col(c).cast("double")).alias(c) for c in scale]).first()
        rows += [(VERSION, "scale", i, c, None, float(got[c]) if got[c] and got[c] > 0 else 1.0, 0.0) for i, c in enumerate(scale)]
    table = None
    for i, c in enumerate(index):
        ranked = string_index_table(train, c).select(F.col(c).cast("string").alias("label"), "index")
        part = ranked.select(
            F.lit(VERSION).alias("version"), F.lit("index").alias("kind"), F.col("index").cast("int").alias("position"),
            F.lit(c).alias("column"), "label", F.col("index").alias("value"), F.lit(None).cast("double").alias("other"),
        )
        table = part if table is None else table.unionByName(part)
        rows.append((VERSION, "labels", i, c, None, float(train.filter(F.col(c).isNotNull()).select(c).distinct().count()), None))
    fixed = spark.createDataFrame(rows, SCHEMA)
    return Preparation(fixed if table is None else fixed.unionByName(table))


def complete(prepared: DataFrame) -> DataFrame:
    return prepared.filter(F.col(REASON).isNull()).drop(REASON)


def rejects(prepared: DataFrame) -> DataFrame:
    """``(reason, rows)`` of the rows that cannot be scored, with the number of
    the others under NULL."""
    return prepared.groupBy(REASON).agg(F.count(F.lit(1)).alias("rows"))
