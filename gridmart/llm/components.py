"""Connected components of a large edge table, by alternating large-star and small-star rounds.

Every round is two aggregations and two joins over the edges; the edges of a round are written to the
shared folder, so lineage stays short and no link, label or component passes through the driver
(only a row count and a checksum do, to see that nothing changed). Rounds grow with the logarithm of
the component's size. Hubs are pre-aggregated (min with map-side combine); the join that hands a
hub's minimum to its neighbours is one that Spark's skew handling may split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from gridmart.llm.common import stored


def _kept(edges: DataFrame) -> tuple[DataFrame, tuple]:
    """The edges, written, with their count and a checksum (observed while writing)."""
    seen = Observation()
    total = F.sum(F.xxhash64("hi", "lo").cast("decimal(20,0)"))
    written = stored(edges.observe(seen, F.count("*").alias("n"), total.alias("sum")), "edges")
    return written, (seen.get["n"], seen.get["sum"])


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionByName(
        edges.select(F.col("lo").alias("u"), F.col("hi").alias("v"))
    )
    least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("k"), F.least("u", "m").alias("m"))
    moved = both.join(least, F.col("u") == F.col("k")).where("v > u")
    return moved.select(F.col("v").alias("hi"), F.col("m").alias("lo"))


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("hi").agg(F.min("lo").alias("m"))
    named = least.select(F.col("hi").alias("k"), "m")
    moved = edges.join(named, F.col("hi") == F.col("k")).select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
    own = least.select("hi", F.col("m").alias("lo"))
    return moved.unionByName(own).where("hi != lo").distinct()


def components(edges: DataFrame) -> DataFrame:
    """From edges (a, b) of any comparable type: (node, root), root the least node reachable.

    Nodes without an edge to another node do not appear. Null ends, loops and repeated edges are ignored.
    """
    named = edges.where("a != b").select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).distinct()
    now, state = _kept(named)
    while state[0]:
        then = state
        now, state = _kept(_small_star(_large_star(now)))
        if then == state:
            break
    return now.select(F.col("hi").alias("node"), F.col("lo").alias("root")).unionByName(
        now.select(F.col("lo").alias("node"), F.col("lo").alias("root")).distinct()
    )
