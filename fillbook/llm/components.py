"""Connected components of an edge table, by alternating star contractions.

Every round hangs each node on the smallest node it sees: first its larger
neighbours (large star), then its smaller ones (small star). The number of
rounds grows with the logarithm of the longest chain. Minima are aggregates
(combined before the shuffle) and joins are left to AQE, which splits a hot
centre; each round is cut with a reliable checkpoint.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _large_star(e: DataFrame) -> DataFrame:
    both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()


def _small_star(e: DataFrame) -> DataFrame:
    low = e.groupBy("u").agg(F.min("v").alias("m"))
    hung = e.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return hung.unionByName(low.select("u", F.col("m").alias("v"))).distinct()


def _digest(e: DataFrame):
    return e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()


def components(edges: DataFrame) -> DataFrame:
    """``(u, v)`` edges to one row ``(node, root)`` per node that has an edge,
    roots (the smallest node of each component) left out.

    Loops, repeated edges and either direction are accepted; no edges give no rows.
    """
    e = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct().checkpoint()
    seen = _digest(e)
    while seen[0]:
        e = _small_star(_large_star(e)).checkpoint()
        now = _digest(e)
        if tuple(now) == tuple(seen):
            break
        seen = now
    return e.select(F.col("u").alias("node"), F.col("v").alias("root"))
