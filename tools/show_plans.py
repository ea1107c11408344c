"""Write PLANS.md: executed physical plans of representative operators.

    python tools/show_plans.py [--sf /root/testdata/sf0.01] [--out PLANS.md]

Each plan is taken after execution (AQE final plan), so it shows the shuffles,
partial aggregates, broadcasts and scans that actually ran.
"""

from __future__ import annotations

import argparse
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from quarry import catalog  # noqa: E402
from quarry.operators import clean, evaluate, logistic, profile  # noqa: E402
from quarry.operators import tree as T  # noqa: E402
from quarry.session import get_spark, materialize  # noqa: E402
from quarry.sources import fixtures as fx  # noqa: E402


def final_plan(df) -> str:
    df.collect()  # runs this very query execution, so AQE's final plan is kept
    plan = df._jdf.queryExecution().executedPlan().toString()
    plan = plan.split("== Initial Plan ==")[0]
    return "\n".join(ln[:220] for ln in plan.splitlines())


def scan_details(df) -> str:
    text = df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )
    keep = [ln for ln in text.splitlines() if ln.startswith(("ReadSchema", "PushedFilters", "(1) Scan"))]
    return "\n".join(keep)


def main() -> None:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.01")
    ap.add_argument("--out", default=os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md"))
    args = ap.parse_args()
    spark = get_spark(8)
    sf = args.sf
    sections = []

    scan = fx.fraud(spark, sf).filter(F.col("f1") > 3.0).select("f1", "label")
    sections.append(("Fixture scan: pruning and pushdown", scan_details(scan) + "\n\n" + final_plan(scan)))

    sections.append(("De-duplication (partial → final aggregate)", final_plan(catalog.dedup_rows(spark, sf))))

    train = materialize(
        clean.dedup(clean.drop_nulls(fx.fraud(spark, sf))).select(*fx.FRAUD_FEATURES, "label")
    )
    base = logistic._training_base(train, fx.FRAUD_FEATURES, "label", None)
    sums = logistic.sums_frame(base, fx.FRAUD_FEATURES, [[0.0, 0.1 * k, 0.2, -0.1] for k in range(9)])
    sections.append(("One gradient-descent iteration, nine configurations", final_plan(sums)))

    trips = catalog.fit_trip_tree(spark, sf)[1]
    data = materialize(trips.select(*fx.TRIP_FEATURES, F.col("trip_duration").alias("y")))
    th = T.feature_thresholds(data, fx.TRIP_FEATURES)
    g = T.grouped_bins(data, F.lit(1), fx.TRIP_FEATURES, th, F.col("y"))
    sections.append(("One tree level (node totals + best split per node)",
                     final_plan(T.level_summary(g, fx.TRIP_FEATURES, th, 50, 100))))

    auc = evaluate.auc_stepwise(fx.scored_fraud(spark, sf), fx.fraud_row_key())
    sections.append(("Stepwise AUC over range-partitioned running totals", final_plan(auc)))

    sections.append(("Parse once: accepted rows selected by a generator", final_plan(catalog.parse_fraud_lines(spark, sf))))

    hist = profile.histogram(clean.drop_nulls(fx.fraud(spark, sf)), fx.FRAUD_FEATURES)
    sections.append(("Histogram of every column in one grouped pass", final_plan(hist)))

    with open(args.out, "w") as fh:
        fh.write("# Physical plans of representative operators\n\n")
        fh.write(f"Generated by `tools/show_plans.py` at `{os.path.basename(sf)}` on local[8]; AQE final plans.\n")
        for title, body in sections:
            fh.write(f"\n## {title}\n\n```\n{body}\n```\n")
    spark.stop()


if __name__ == "__main__":
    main()
