"""Connected components of links that no single machine can hold."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywork.plans import remove, stored


def _both_ways(links: DataFrame) -> DataFrame:
    return links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _with_least(pairs: DataFrame) -> DataFrame:
    """Pairs (a, b) with the smallest of a and all its b as ``m``."""
    least = pairs.groupBy("a").agg(F.min("b").alias("m"))
    return pairs.join(least, "a").withColumn("m", F.least("a", "m"))


def _star(links: DataFrame, *, large: bool) -> DataFrame:
    """Link every neighbour on one side of a node to the smallest node around it."""
    pairs = _with_least(_both_ways(links) if large else links)
    if large:
        moved = pairs.filter(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:  # links run from the larger to the smaller node here
        ends = F.explode(F.array("a", "b"))
        moved = pairs.select(ends.alias("a"), F.col("m").alias("b"))
    return moved.filter(F.col("a") != F.col("b")).distinct()


def smallest_reachable(links: DataFrame) -> DataFrame:
    """(node, root) for every node of the undirected ``links`` (a, b); root: its component's smallest.

    Alternates large-star and small-star steps. Each step leaves one link per node at most in the
    end, and a step's result is written to the shared folder, so lost executors cost one step; the
    result of the step before is deleted. Only a count and a checksum reach the driver. Nodes are
    bigints; links with a NULL end and links of a node to itself are ignored, repeated links count
    once; no links give no rows.
    """
    ends = links.filter(F.col("a") != F.col("b"))
    now, folder = stored(
        ends.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links"
    )
    before = None
    while True:
        state = now.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
        ).first()
        if state == before or not state[0]:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
                now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
            )
        before = state
        done = folder
        now, folder = stored(_star(_star(now, large=True), large=False), "links")
        remove(links.sparkSession, done)
