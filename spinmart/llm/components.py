"""Connected components of a graph given by its links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spinmart.operators.staging import stage


def _star(links: DataFrame, large: bool) -> DataFrame:
    """Each node links its larger (or its not larger) neighbours to its smallest neighbour."""
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))) if large else links.select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    near = both.join(least, "a")
    if large:
        moved = near.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        moved = near.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
            least.select("a", F.col("m").alias("b")))
    return moved.where("a <> b").distinct()


def connect(links: DataFrame) -> DataFrame:
    """``node`` and ``label``, the smallest node of its component, for every node of ``links`` (columns ``a``, ``b``).

    Each round is written to the shared folder, which cuts the lineage. Links of a node to itself and NULLs
    are ignored; no links give no rows. Rounds grow with the logarithm of the longest path.
    """
    links = stage(links.where("a <> b").distinct(), "links")
    state = None
    while True:
        links = stage(_star(_star(links, large=True), large=False), "links")
        now = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
    return links.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("label")).unionByName(
        links.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct())
