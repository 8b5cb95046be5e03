"""Connected components of a graph of links, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from freshet.session import released, stored


def _star(links: DataFrame, large: bool) -> DataFrame:
    """Hang each node's larger (or not larger) neighbours on its least one."""
    if large:
        links = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = links.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    joined = links.join(least, "u")
    if large:
        hung = joined.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        hung = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            least.select("u", F.col("m").alias("v"))
        )
    return hung.filter("u > v").distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every node in ``links`` (a, b); the component is the smallest node reachable.

    Each round is written to the shared folder; the number of rounds grows with the logarithm of the longest path.
    """
    larger = links.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    state, now = None, stored(larger, "links")
    while True:
        marks = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if marks == state:
            break
        state = marks
        before, now = now, stored(_star(_star(now, large=True), large=False), "links")
        released(before)
    roots = now.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("component"))
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
