"""Connected components of a link table, by alternating large-star and small-star rounds.

Each round is two aggregations and two joins over the links that are left;
rounds grow with the logarithm of the longest chain.  Each round's links are
written to the shared folder, so lineage stays short.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duoweave.llm import work


def _star(links: DataFrame, both: bool) -> DataFrame:
    """Links (a > b) after one star step: every neighbour of a node is linked to the least of them."""
    if both:
        near = links.union(links.select("b", "a"))
    else:
        near = links
    least = near.groupBy("a").agg(F.min("b").alias("least")).withColumn("least", F.least("a", "least"))
    moved = near.join(least, "a")
    if both:
        return moved.filter(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("least").alias("b")).distinct()
    hung = moved.filter(F.col("b") != F.col("least")).select(F.col("b").alias("a"), F.col("least").alias("b"))
    return hung.union(least.select("a", F.col("least").alias("b"))).distinct()


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) of every node with a link to another; component is the least node reachable.

    Links may come in any direction and repeatedly; links of a node to itself
    and links with a null end are none.
    """
    spark = links.sparkSession
    x, y = F.col(a), F.col(b)
    now, path = work.save(links.filter(x != y).select(F.greatest(x, y).alias("a"), F.least(x, y).alias("b")).distinct(),
                          "links")
    state = None
    while True:
        seen = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(seen) == state or not seen[0]:
            return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
                now.select("b", "b").distinct())
        state = tuple(seen)
        nxt, new = work.save(_star(_star(now, True), False), "links")
        work.drop(spark, path)
        now, path = nxt, new
