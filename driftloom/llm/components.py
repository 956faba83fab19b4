"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftloom.sources.scratch import settle


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """`node` and `component` (the component's smallest node) of every node of an edge.

    Alternating large-star and small-star steps (Kiveris et al. 2014): each links the neighbours
    of a node to the smallest of them, until every node hangs on its component's smallest. Every
    round is a written table, so a lost executor costs one round at most. Only counts reach the
    driver. A node's minimum is a partial aggregate, so a node with very many neighbours costs
    no task more than its share.
    """
    pairs = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u <> v").distinct()
    current = settle(pairs)

    def star(sym: DataFrame, least: DataFrame) -> DataFrame:
        return sym.join(least.withColumnRenamed("u", "k"), sym["u"] == F.col("k")).drop("k")

    def state(df: DataFrame):
        return df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()

    before = state(current)
    while before[0]:
        both = current.select("u", "v").union(current.select(F.col("v"), F.col("u")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = star(both, least).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = settle(large.filter("u <> v").distinct())
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        linked = star(large, least).select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v")))
        current = settle(linked.filter("u <> v").distinct())
        now = state(current)
        if now == before:
            break
        before = now
    roots = current.select(F.col("v").alias("node")).distinct().withColumn("component", F.col("node"))
    return current.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)
