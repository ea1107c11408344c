"""Score curves from bounded histograms, and ranking of many models.

``binned_curve`` counts classes in ``bins`` equal parts of [0, 1]: partial sums
that merge across tasks, a curve of at most ``bins`` points, and an area whose
error is at most half the pairs that share a bin.

``rank_models`` finds the best of k models by the stepwise AUC of ``evaluate``
exactly, without a row for each model.  A row carries the array of its k scores:

1. one pass counts both classes by (model, bin); a bin that holds one class
   alone is settled, since the order inside it does not matter.  The counts
   bound every model's AUC from both sides (the bins' inner pairs all wrong or
   all right);
2. only models whose upper bound reaches the best lower bound go on, and of
   their rows only those in bins of both classes are ordered (range partitions
   and running sums inside a bin).

The result equals ordering all rows for all models; what is shuffled is the
rows that can still decide.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.operators.evaluate import safe_div
from quarry.plans.prefix import running_totals

CURVE_BINS = 1000
RANK_BINS = 1 << 14


def bin_of(p: Column, bins: int) -> Column:
    """Bin 0 .. bins - 1 of a score in [0, 1]."""
    return F.least(F.floor(p * F.lit(float(bins))), F.lit(bins - 1)).cast("int")


def class_bins(scored: DataFrame, p: str = "p", label: str = "label", bins: int = CURVE_BINS) -> DataFrame:
    """``(bin, pos, neg)``; rows without a score are left out."""
    y = F.col(label)
    rows = scored.filter(F.col(p).isNotNull() & ~F.isnan(p))
    return rows.groupBy(bin_of(F.col(p), bins).alias("bin")).agg(F.count_if(y == 1.0).alias("pos"), F.count_if(y != 1.0).alias("neg"))


def binned_curve(scored: DataFrame, p: str = "p", label: str = "label", bins: int = CURVE_BINS) -> DataFrame:
    """Per bin that holds rows, from the top: ``threshold`` (its lower edge),
    ``tp, fp, tpr, fpr, precision, f1`` when predicting ``p >= threshold``."""
    down = Window.partitionBy(F.lit(0)).orderBy(F.desc("bin")).rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy(F.lit(0))
    got = class_bins(scored, p, label, bins).select(  # at most `bins` rows
        "bin", F.sum("pos").over(down).alias("tp"), F.sum("neg").over(down).alias("fp"), F.sum("pos").over(whole).alias("P"), F.sum("neg").over(whole).alias("N")
    )
    tp, fp = F.col("tp"), F.col("fp")
    precision, recall = safe_div(tp, tp + fp), safe_div(tp, F.col("P"))
    f1 = F.when(precision + recall == 0, F.lit(0.0)).otherwise(2.0 * precision * recall / (precision + recall))
    return got.select(
        (F.col("bin") / F.lit(float(bins))).alias("threshold"), "tp", "fp", recall.alias("tpr"), safe_div(fp, F.col("N")).alias("fpr"),
        precision.alias("precision"), f1.alias("f1"),
    )


def binned_auc(scored: DataFrame, p: str = "p", label: str = "label", bins: int = CURVE_BINS) -> DataFrame:
    """``auc, error_bound, positives, negatives``: trapezoids over the bins.
    The tie-aware AUC of the exact scores differs by at most ``error_bound``."""
    down = Window.partitionBy(F.lit(0)).orderBy(F.desc("bin")).rowsBetween(Window.unboundedPreceding, 0)
    got = class_bins(scored, p, label, bins).withColumn("tp", F.sum("pos").over(down))
    wide = "decimal(38,0)"
    twice = F.col("neg").cast(wide) * (2 * F.col("tp") - F.col("pos")).cast(wide)
    total = got.agg(
        F.coalesce(F.sum("pos"), F.lit(0)).alias("positives"), F.coalesce(F.sum("neg"), F.lit(0)).alias("negatives"),
        F.sum(twice).cast("double").alias("twice"), F.sum((F.col("pos").cast(wide) * F.col("neg").cast(wide))).cast("double").alias("shared"),
    )
    pairs = F.col("positives").cast("double") * F.col("negatives").cast("double")
    none = (F.col("positives") == 0) | (F.col("negatives") == 0)
    return total.select(
        F.when(none, F.lit(0.0)).otherwise(F.col("twice") / 2.0 / pairs).alias("auc"),
        F.when(none, F.lit(0.0)).otherwise(F.col("shared") / 2.0 / pairs).alias("error_bound"), "positives", "negatives",
    )


# ---------------------------------------------------------------- ranking
def rank_models(scored: DataFrame, k: int, scores: str = "scores", label: str = "label", key: str = "key", bins: int = RANK_BINS) -> DataFrame:
    """``(config_index, auc, lower, upper, ordered)`` of k models, one row each.

    ``scored`` holds an array of k scores in [0, 1], the label and a key that
    breaks ties (ascending, positives first).  ``auc`` is the exact stepwise
    AUC of every model that can be the best (``ordered``), NULL for the others;
    all models have bounds.  0.0 throughout when a class is missing.
    """
    spark = scored.sparkSession
    pos, neg = _histograms(scored, k, scores, label, bins)
    P, N = int(pos[0].sum()) if k else 0, int(neg[0].sum()) if k else 0
    schema = "config_index int, auc double, lower double, upper double, ordered boolean"
    if not P or not N:
        return spark.createDataFrame([(i, 0.0, 0.0, 0.0, True) for i in range(k)], schema)
    # bins from the top; positives above each bin
    above = np.stack([np.concatenate([[0], np.cumsum(row[::-1])[:-1]])[::-1] for row in pos])
    mixed = (pos > 0) & (neg > 0)
    settled = [sum(int(a) * int(b) for a, b in zip(above[i][neg[i] > 0], neg[i][neg[i] > 0])) for i in range(k)]  # exact
    inner = [sum(int(a) * int(b) for a, b in zip(pos[i][mixed[i]], neg[i][mixed[i]])) for i in range(k)]
    last = [int(np.flatnonzero(row)[0]) for row in neg]  # the lowest bin with a negative
    pairs = float(P) * float(N)
    lower = [float(settled[i] - (above[i][last[i]] + (pos[i][last[i]] if mixed[i][last[i]] else 0)) / 2.0) / pairs for i in range(k)]
    upper = [float(settled[i] + inner[i] - above[i][last[i]] / 2.0) / pairs for i in range(k)]
    running = [i for i in range(k) if upper[i] >= max(lower)]
    exact = {r["m"]: r for r in _inside(scored, running, mixed, last, scores, label, key, bins).collect()}  # a row a model
    rows = []
    for i in range(k):
        auc = None
        if i in running:
            r = exact.get(i)
            within = int(r["within"]) if r is not None else 0
            tail = int(above[i][last[i]]) + (int(r["tail"]) if mixed[i][last[i]] else 0)
            auc = (float(settled[i] + within) - tail / 2.0) / pairs
        rows.append((i, auc, lower[i], upper[i], i in running))
    return spark.createDataFrame(rows, schema)


def _histograms(scored: DataFrame, k: int, scores: str, label: str, bins: int) -> tuple[np.ndarray, np.ndarray]:
    """Counts of positives and of other rows by (model, bin); one pass."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(2 * k * bins, np.int64)
        for batch in batches:
            p = batch.column("scores").flatten().to_numpy(zero_copy_only=False).reshape(-1, k)
            other = (batch.column("pos").to_numpy(zero_copy_only=False) == 0).astype(np.int64)
            at = np.minimum((p * float(bins)).astype(np.int64), bins - 1) + np.arange(k) * bins + (other * k * bins)[:, None]
            total += np.bincount(at.ravel(), minlength=len(total))
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"at": some, "n": total[some]})

    rows = scored.select(F.col(scores).alias("scores"), (F.col(label) == 1.0).cast("int").alias("pos"))
    cells = rows.mapInArrow(run, "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).toArrow()  # at most 2 k bins
    total = np.zeros(2 * k * bins, np.int64)
    total[cells.column("at").to_numpy()] = cells.column("n").to_numpy()
    pos, neg = total.reshape(2, k, bins)
    return pos, neg


def _inside(scored: DataFrame, running: list[int], mixed: np.ndarray, last: list[int], scores: str, label: str, key: str, bins: int) -> DataFrame:
    """``(m, within, tail)`` of the running models: the sum over negatives in
    mixed bins of the positives before them in their bin, and the positives
    before the last negative in the ``last`` bin with one."""
    packed = {i: np.packbits(mixed[i]).tobytes() for i in running}
    names = ["m", "bin", "p", "key", "pos"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flags = {i: np.unpackbits(np.frombuffer(v, np.uint8))[:bins].astype(bool) for i, v in packed.items()}
        for batch in batches:
            scores_of = batch.column("scores").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            for i, flag in flags.items():
                p = scores_of[:, i]
                b = np.minimum((p * float(bins)).astype(np.int64), bins - 1)
                at = np.flatnonzero(flag[b])
                if len(at):
                    take = pa.array(at)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(at), i, np.int32)), pa.array(b[at].astype(np.int32)), pa.array(p[at]),
                         batch.column("key").take(take), batch.column("pos").take(take)], names=names)

    rows = scored.select(F.col(scores).alias("scores"), F.col(key).cast("string").alias("key"), (F.col(label) == 1.0).cast("int").alias("pos"))
    open_rows = rows.mapInArrow(run, "m int, bin int, p double, key string, pos int")
    same = open_rows.groupBy(*names).agg(F.count(F.lit(1)).alias("c"))
    ranked = running_totals(
        same, order=[F.desc("p"), F.asc("key"), F.desc("pos")], values={"before": F.col("pos") * F.col("c")}, group=["m", "bin"],
    )
    negative = F.col("pos") == 0
    wide = "decimal(38,0)"
    lowest = F.element_at(F.array(*[F.lit(b) for b in last]), F.col("m") + 1)
    return ranked.groupBy("m").agg(
        F.coalesce(F.sum(F.when(negative, F.col("cum_before").cast(wide) * F.col("c").cast(wide))), F.lit(0)).alias("within"),
        F.max(F.when(negative & (F.col("bin") == lowest), F.col("cum_before"))).alias("tail"),
    )
