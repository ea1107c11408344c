"""Physical-plan properties the design relies on."""

from pyspark.sql import functions as F

from conftest import SF01
from quarry import catalog
from quarry.operators import evaluate
from quarry.sources import fixtures as fx


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_fixture_scan_prunes_columns(spark):
    plan = _plan(fx.fraud(spark, SF01).filter(F.col("f1") > 3))
    assert "ReadSchema: struct<l_quantity:double,l_discount:double,l_tax:double>" in plan
    assert "PushedFilters: [IsNotNull(l_quantity), GreaterThan(l_quantity,3.0)]" in plan


def test_dedup_uses_partial_aggregation(spark):
    df = catalog.dedup_rows(spark, SF01)
    df.collect()
    plan = _plan(df)
    assert plan.count("HashAggregate") >= 2 and "Exchange" in plan


def test_running_totals_have_no_single_partition_window(spark):
    scored = fx.scored_fraud(spark, SF01)
    df = evaluate.auc_stepwise(scored, fx.fraud_row_key())
    df.collect()
    lines = _plan(df).split("== Initial Plan ==")[0].splitlines()
    windows = []
    for i, ln in enumerate(lines):
        if "Window [" in ln:
            below = next((x for x in lines[i + 1:] if "Exchange" in x), "")
            inside_broadcast = any("BroadcastExchange" in x for x in lines[:i]
                                   if len(x) - len(x.lstrip(" :+-")) < len(ln) - len(ln.lstrip(" :+-")))
            windows.append(("SinglePartition" in below, inside_broadcast))
    # local sums run where the range partitions are (no row-level window or
    # hash shuffle by partition id); the only window is over the per-partition
    # offsets table (≤ n rows), which is broadcast
    assert windows and all(inside for _, inside in windows)
    assert any("MapInArrow" in ln for ln in lines)
    # a shuffle keyed by partition id appears only inside the broadcast
    # subtree (the tiny totals aggregate), never on the row path
    b = next(i for i, ln in enumerate(lines) if "BroadcastExchange" in ln)
    assert all(i > b for i, ln in enumerate(lines) if "hashpartitioning(_range_part" in ln)


def test_parse_once_no_pushed_parse_predicate(spark):
    df = catalog.parse_fraud_lines(spark, SF01)
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" in plan
    filters = [ln for ln in plan.splitlines() if ln.strip().lstrip("+-: ").startswith("Filter")]
    assert filters and not any("RLIKE" in ln for ln in filters)


def test_gradient_iteration_is_one_aggregate(spark):
    from quarry.operators import logistic

    df = spark.range(1000).select((F.col("id") / 1000.0).alias("x"), (F.col("id") % 2).cast("double").alias("label"))
    base = logistic._training_base(df.repartition(4), ["x"], "label", None)
    agg = logistic.sums_frame(base, ["x"], [[0.0, 0.1 * k] for k in range(9)])
    agg.collect()
    plan = _plan(agg).split("== Initial Plan ==")[0]
    # partial aggregate per task, one exchange to a single final merge
    assert plan.count("HashAggregate") == 2
    assert plan.count("Exchange SinglePartition") == 1
