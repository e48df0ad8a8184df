"""Connected components of a link table, by alternating large-star and small-star steps.

Every step is an aggregation (combined before the shuffle) and a join on slim rows; the links are
written after each step, so a lost executor costs one step at most. The number of rounds grows with
the logarithm of the longest chain.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.llm.common import cut_lineage


def _star(links: DataFrame, large: bool) -> DataFrame:
    """Point neighbours at the least id around: larger ones (large) or smaller ones and self.

    Links are distinct and go from larger to smaller ids, also those returned. Their plan holds them two to four
    times, so they are to be written before.
    """
    around = links
    if large:
        around = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = around.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    joined = around.join(least, "a")
    if large:
        moved = joined.where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), "m")
    else:
        moved = joined.select(F.explode(F.array("b", "a")).alias("a"), "m")
    return moved.where("a != m").select("a", F.col("m").alias("b")).distinct()


def components(links: DataFrame) -> DataFrame:
    """id and component (the least id reachable) of every id with a link; links have a and b."""
    links = links.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    links = cut_lineage(links.distinct(), "links")
    seen = None
    while True:
        now = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if seen == now:
            return links.select(F.col("a").alias("id"), F.col("b").alias("component")).union(
                links.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct()
            )
        seen = now
        # One plan for both steps would hold the links a dozen times.
        for large in (True, False):
            links = cut_lineage(_star(links, large), "links")
