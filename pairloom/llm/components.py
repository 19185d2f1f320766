"""Connected components by alternating large and small stars, one join and one sum each."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairloom.llm.scratch import keep, remove


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select("v", "u")).toDF("u", "v")
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    down = down.where("u != v")
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).where("u != v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``(node, component)`` for each end of ``edges (u, v)``; the label is the least node.

    Hot nodes are safe: minima combine before they are shuffled and Spark splits the skewed
    side of the joins. Loops and repeated edges are allowed. Each round is a written table.
    """
    spark = edges.sparkSession
    pairs = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    now = keep(pairs.where("u != v").distinct(), "edges")
    state = None
    while True:
        after = keep(_small_star(_large_star(now)), "edges")
        row = after.agg(
            F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")
        ).first()
        remove(spark, now)
        now = after
        if state == (row.n, row.x):
            break
        state = (row.n, row.x)
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)
