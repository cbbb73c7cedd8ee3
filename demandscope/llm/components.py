"""Connected components of a large graph by alternating star contractions; nothing is gathered on the driver but a count."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, release


def _smallest(pairs: DataFrame) -> DataFrame:
    """(u, v) with m, the smallest of u and its v's: an aggregate and a join, so that a hub's rows are never sorted as one group."""
    least = pairs.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("u2"), F.least("u", "m").alias("m"))
    return pairs.join(least, F.col("u") == F.col("u2")).drop("u2")


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """Edges (a, b) of non-null longs to (node, root), root being the smallest node of the component.

    Only nodes with an edge to another node are returned; repeated, reversed and self edges are fine; no edges give no rows.
    Rounds grow with the logarithm of a component's size; a table of the shared folder cuts the lineage of each.
    """
    pairs = lambda e: e.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()
    mark = lambda e: tuple(e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
    now = materialize(pairs(edges), name)
    seen = mark(now)
    while seen[0]:
        both = now.select(F.col("a").alias("u"), F.col("b").alias("v")).union(now.select(F.col("b").alias("u"), F.col("a").alias("v")))
        large = _smallest(both).where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
        down = _smallest(pairs(large).select(F.col("a").alias("u"), F.col("b").alias("v")))
        small = down.select(F.col("v").alias("a"), F.col("m").alias("b")).union(down.select(F.col("u").alias("a"), F.col("m").alias("b")))
        after = materialize(pairs(small), name)
        done = mark(after)
        release(now)
        now = after
        if done == seen:
            break
        seen = done
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(now.select(F.col("b"), F.col("b"))).distinct()
