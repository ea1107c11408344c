"""Operators for preparing language-model training data.

Thirteen numbered operators, each in a module of its own, and their registered
queries in ``catalog``.  Nothing outside this package imports it; the package
can be removed whole.  Shared conventions:

* a null text counts as the empty text, and every row of ``documents`` gives
  one row of the result (also repeated rows, null and repeated ids);
* columns other than the ones an operator names are ignored, so extra or
  clashing column names change nothing;
* texts are processed whole, in Arrow batches cut by bytes, never by a prefix;
* intermediate tables live in the folder of ``spark.checkpoint.dir``.
"""
