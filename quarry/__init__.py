"""quarry: tabular analytics and model fitting as Spark DataFrame operators.

Everything row-level runs as Spark jobs (projections, aggregations, windows,
range partitioning); only small statistics — gradients, split tables, counts —
come back to the driver, where the iterative loops live.

Sub-packages:

* ``quarry.sources``   — table scans, fixtures, validated text parsing, sinks
* ``quarry.functions`` — Column-expression helpers (numeric parsing, haversine,
  sigmoid, scaling)
* ``quarry.operators`` — cleaning, profiling, splitting, logistic regression,
  regression trees, evaluation, tuning, library-model wrappers
* ``quarry.plans``     — distributed running totals, end-to-end jobs
  (classification, regression, batch scoring)
* ``quarry.streaming`` — the batch-scoring plan applied to a streaming source
* ``quarry.catalog``   — one registered query per inventory item (the driver
  contract's ``queries()``), with DuckDB twins in ``quarry.oracles``
"""

from quarry.session import get_spark, materialize

__all__ = ["get_spark", "materialize"]
