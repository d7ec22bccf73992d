"""Connected components of a graph given as edges, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratiform.llm.common import discard, staged


def _stars(edges: DataFrame) -> DataFrame:
    """One large-star and one small-star step; edges are (a, b) with a > b before and after."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("u"), F.least("a", "m").alias("m"))
    large = both.join(least, both["a"] == least["u"]).where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    large = large.where("a > b").distinct()
    least = large.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("u"), "m")
    moved = large.join(least, large["a"] == least["u"]).where("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select(F.col("u").alias("a"), F.col("m").alias("b"))).distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """``edges`` (a long, b long, any order, loops and nulls ignored) to (node, root).

    ``root`` is the smallest node of the component. Nodes without an edge to another node are absent.
    Every round is written to the shared folder; the number of rounds grows with the logarithm of the
    size of a component, and nothing but two totals comes to the driver.
    """
    now = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"), F.lit(True).alias("ok"))
    now = staged(now.where("a > b AND a IS NOT NULL AND b IS NOT NULL").select("a", "b").distinct(), "edges")
    total = None
    while True:
        following = staged(_stars(now), "edges")
        discard(now)
        now, before = following, total
        total = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if total == before or not total[0]:
            break
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
