"""Exact running totals over a global order without a one-task window.

``Window.orderBy(...)`` with no ``partitionBy`` moves every row into a single
task.  Instead:

1. ``repartitionByRange(group..., order...)`` — Spark samples the sort key
   and cuts it into balanced ranges (``spark.sql.shuffle.partitions`` of
   them, or ``num_partitions``; AQE may merge adjacent small ranges), so even
   a score shared by a third of all rows is spread over many partitions when
   the order key is unique (callers add a row key as the last order column,
   or aggregate identical rows first).
2. The range-partitioned frame is checkpointed, which freezes the
   partition number (``spark_partition_id``) of every row.
3. Per-partition totals form a table of at most ``n + groups`` rows; a window
   over it gives each partition its starting offset.
4. The local running sum inside each range partition is computed where the
   rows already are: ``sortWithinPartitions`` then a numpy cumulative sum per
   Arrow batch, carried across the batches of a partition (``local="arrow"``,
   no shuffle).  ``local="window"`` uses a window partitioned by the
   partition number instead, which costs one more hash shuffle of all rows.
   Adding the offset (joined by partition number) gives the global sum.

The offsets table is broadcast only when its bound (``n`` partitions, plus
the number of groups when totals restart per group) is below
``max_broadcast_rows``; otherwise the join is left to the planner.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.session import materialize

PID = "_range_part"


def running_totals(
    df: DataFrame,
    order: Sequence[Column],
    values: Mapping[str, Column],
    group: Sequence[str] = (),
    num_partitions: int | None = None,
    max_groups: int | None = None,
    max_broadcast_rows: int = 100_000,
    local: str = "arrow",
) -> DataFrame:
    """Add ``cum_<name>`` = inclusive running sum of each value in ``order``.

    Totals restart for each combination of ``group`` columns.  ``max_groups``
    is the caller's bound on the number of groups (needed to broadcast the
    offsets when grouping).
    """
    spark = df.sparkSession
    # Without an explicit count, AQE may coalesce adjacent ranges to the data
    # size (order is kept); the count never exceeds the shuffle partitions.
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    group = list(group)
    names = list(values)
    base = df.withColumns(dict(values))
    keys = [*[F.col(g) for g in group], *order]
    ranged = base.repartitionByRange(num_partitions, *keys) if num_partitions else base.repartitionByRange(*keys)
    ranged = ranged.withColumn(PID, F.spark_partition_id())
    ranged = materialize(ranged, balance=False, cache=False)

    totals = ranged.groupBy(PID, *group).agg(*[F.sum(v).alias(f"_tot_{v}") for v in names])
    before = Window.partitionBy(*group).orderBy(PID).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        PID,
        *group,
        *[F.coalesce(F.sum(f"_tot_{v}").over(before), F.lit(0)).alias(f"_off_{v}") for v in names],
    )
    bound = n + (max_groups or 0) if group else n
    if (not group or max_groups is not None) and bound <= max_broadcast_rows:
        offsets = F.broadcast(offsets)

    if local == "window":
        upto = Window.partitionBy(PID, *group).orderBy(*order).rowsBetween(
            Window.unboundedPreceding, Window.currentRow
        )
        summed = ranged.withColumns({f"_loc_{v}": F.sum(v).over(upto) for v in names})
    else:
        summed = _local_cumsum(ranged.sortWithinPartitions(*[F.col(g) for g in group], *order), group, names)
    # null-safe, so rows of a NULL group keep their offset
    offsets = offsets.withColumnsRenamed({c: f"_at_{c}" for c in (PID, *group)})
    same = F.lit(True)
    for c in (PID, *group):
        same = same & F.col(c).eqNullSafe(F.col(f"_at_{c}"))
    out = summed.join(offsets, same, "inner").drop(*[f"_at_{c}" for c in (PID, *group)])
    out = out.withColumns({f"cum_{v}": F.col(f"_loc_{v}") + F.col(f"_off_{v}") for v in names})
    return out.drop(PID, *[f"_loc_{v}" for v in names], *[f"_off_{v}" for v in names])


def _local_cumsum(sorted_df: DataFrame, group: Sequence[str], names: Sequence[str]) -> DataFrame:
    """Running sums within each (partition, group) of a frame already sorted
    within its partitions; batches of one partition arrive in order, so a
    carry per group continues the sum across batch boundaries."""
    from pyspark.sql.types import StructField, StructType

    fields = {f.name: f for f in sorted_df.schema.fields}
    schema = StructType(
        list(sorted_df.schema.fields) + [StructField(f"_loc_{v}", fields[v].dataType) for v in names]
    )
    # NULL and NaN look the same in pandas: a flag tells them apart
    flags = [f"_null_{g}" for g in group]
    sorted_df = sorted_df.withColumns({f: F.col(g).isNull() for f, g in zip(flags, group)})
    keys = [PID, *group, *flags]

    def run(batches):
        import numpy as np
        import pandas as pd
        import pyarrow as pa

        carry: dict = {}
        for batch in batches:
            kept = batch.drop_columns(flags) if flags else batch
            pdf = batch.select([*keys, *names]).to_pandas()
            sums = []
            if not pdf.empty:
                # group ids in order of first appearance; keys of those groups
                gid = pdf.groupby(keys, sort=False, dropna=False).ngroup().to_numpy()
                ukeys = [
                    tuple("missing" if pd.isna(x) else ("", x) for x in key)
                    for key in pdf[keys].drop_duplicates().itertuples(index=False, name=None)
                ]
                last_row = pd.Series(np.arange(len(gid))).groupby(gid).max().to_numpy()
            for v in names:
                kind = batch.schema.field(v).type
                if pdf.empty:
                    sums.append(pa.array([], kind))
                    continue
                cs = pdf[v].groupby(gid, sort=False).cumsum().to_numpy()
                start = np.array([carry.get((k, v), 0) for k in ukeys])
                loc = cs + start[gid]
                for j, k in enumerate(ukeys):
                    carry[(k, v)] = loc[last_row[j]]
                sums.append(pa.array(loc.astype(pdf[v].dtype, copy=False)).cast(kind))
            fields = [*kept.schema, *(pa.field(f"_loc_{v}", x.type) for v, x in zip(names, sums))]
            yield pa.RecordBatch.from_arrays([*kept.columns, *sums], schema=pa.schema(fields))

    # Arrow batches as they are: through pandas a NaN would come back as NULL
    return sorted_df.mapInArrow(run, schema)
