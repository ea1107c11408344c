"""Connected components by alternating large-star and small-star rounds.

Each round replaces edges by edges towards smaller neighbours (joins and
minimum aggregates only, so a hub's edges stay spread: the minimum is combined
before the shuffle, and the join's large side can be split at run time).  The
edge table is written to the scratch folder between rounds.  The rounds needed
grow with the logarithm of the graph's diameter.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import Scratch


def components(edges: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """(node, root) of every node of ``edges`` (a, b), root being its component's least node."""
    now = scratch.store(_small_to_large(edges.filter("a <> b")).distinct(), f"{name}-0")
    mark, i = _mark(now), 0
    while True:
        i += 1
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        # large star: greater neighbours move to the least neighbour
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        # small star: a node and its lesser neighbours move to the least of them
        down = _small_to_large(large).select(F.col("b").alias("a"), F.col("a").alias("b")).distinct()
        least = down.groupBy("a").agg(F.min("b").alias("m"))
        moved = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        small = moved.unionByName(least.select("a", F.col("m").alias("b"))).filter("a <> b")
        new = scratch.store(_small_to_large(small).distinct(), f"{name}-{i}")
        scratch.delete(f"{name}-{i - 1}")
        now, old, mark = new, mark, _mark(new)
        if mark == old:
            break
    roots = now.select(F.col("b").alias("node"), F.col("a").alias("root"))
    return roots.unionByName(now.select(F.col("a").alias("node"), F.col("a").alias("root"))).distinct()


def _small_to_large(edges: DataFrame) -> DataFrame:
    return edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))


def _mark(edges: DataFrame) -> tuple:
    digest = F.xxhash64("a", "b")
    return tuple(edges.agg(F.count("*"), F.sum(digest.cast("decimal(38,0)"))).first())
