"""DuckDB twins of the catalogue queries (``__spark_entry__.oracle_sql``).

The views ``lineitem``, ``events`` … are registered by the checker.  Each
string recomputes the query from the raw tables with the same rules, so the
pair is an end-to-end check.  Decimal constants are written as DOUBLE.

Modules mirror ``quarry.catalog``: ``base`` (registry, fraud fixture, SQL
helpers, gradient descent as a recursive CTE), ``ingest``, ``profiling``,
``features``, ``classification``, ``tree``, ``forest``, ``models``, ``io``.  Importing the package
fills ``ORACLES``.
"""

from quarry.oracles import base, classification, features, forest, ingest, io, models, profiling, tree  # noqa: F401  (registers)
from quarry.oracles.base import ORACLES  # noqa: F401
