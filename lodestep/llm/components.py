"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestep.session import stored


def components(links: DataFrame) -> DataFrame:
    """``a, b`` (longs) -> ``id, component``: the smallest id reachable, for every id in a link with another.

    Alternates two steps until nothing changes: each id's larger neighbours are linked to its smallest one, then
    its smaller neighbours are. Both keep components and number of links, and halve distances, so the
    rounds grow with the logarithm of the longest path. A hub's links are grouped by partial minima and joined,
    never gathered; a skewed join is split. Self-links are ignored.
    """
    edges = stored(links.where("a <> b").select(
        F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    before = None
    while True:
        both = edges.union(edges.select(F.col("v"), F.col("u")))
        smallest = both.groupBy(F.col("u").alias("id")).agg(F.least(F.min("v"), F.first("u")).alias("low"))
        large = both.where("v > u").join(smallest, F.col("u") == F.col("id")).select(
            F.col("v").alias("u"), F.col("low").alias("v")).where("u <> v").distinct()
        lows = large.groupBy(F.col("u").alias("id")).agg(F.min("v").alias("low"))
        small = large.join(lows, F.col("u") == F.col("id")).select(
            F.col("v").alias("u"), F.col("low").alias("v")).where("u <> v").union(
            lows.select(F.col("id").alias("u"), F.col("low").alias("v"))).distinct()
        edges = stored(small, "edges")
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    stars = edges.select(F.col("u").alias("id"), F.col("v").alias("component"))
    return stars.union(stars.select(F.col("component").alias("id"), "component").distinct())
