"""Query catalogue: one callable ``(spark, sf_dir) -> DataFrame`` per operator
of the survey's inventory, registered in ``__spark_entry__.queries()``.

Every query reads the driver tables (through the fixtures) in full.  Doubles
in published results are rounded to 6 places, because the DuckDB oracle adds
in a different order; counts are BIGINT on both sides.

Modules: ``common`` (registry and shared fits), ``ingest``, ``profiling``,
``features``, ``classification``, ``regression``, ``models``.  Importing the package
registers every query in ``QUERIES``; each is also an attribute of the
package (``quarry.catalog.fraud_report``).
"""

from quarry.catalog import classification, features, ingest, models, profiling, regression  # noqa: F401  (registers)
from quarry.catalog.common import (  # noqa: F401
    DIGITS,
    FRAUD_GD,
    QUERIES,
    TREE,
    TRIP_NUMERIC,
    _clean_fraud,
    fit_fraud_model,
    fit_trip_tree,
    fraud_clean_split,
    query,
    rounded,
    scratch_path,
)
from quarry.catalog.ingest import FRAUD_NAMES  # noqa: F401

globals().update(QUERIES)
