"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorweave.llm.common import dropped, written


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node's larger neighbours are tied to the smallest of its neighbourhood."""
    both = edges.union(edges.select("v", "u"))
    lowest = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.join(lowest, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours are tied to the smallest of these."""
    lowest = edges.groupBy("u").agg(F.min("v").alias("m"))
    rest = edges.join(lowest, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return rest.union(lowest.select("u", F.col("m").alias("v"))).distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root`` (the smallest node reachable) of all nodes of edges ``u``, ``v``.

    Each round is written to the shared folder, so a lost executor repeats one round
    at most. The rounds grow with the logarithm of the longest path.
    """
    spark = edges.sparkSession
    ordered = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u > v").distinct()
    state = F.struct(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v") % (1 << 40)))
    current, path = written(ordered, "edges")
    mark = current.agg(state).first()[0]
    while True:
        following, next_path = written(_small_star(_large_star(current)), "edges")
        next_mark = following.agg(state).first()[0]
        dropped(spark, path)
        current, path = following, next_path
        if next_mark == mark:
            break
        mark = next_mark
    return current.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        current.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )
