"""Gaps between what employers ask for and what is taught, ranked."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestep.functions.depth import depth_of_rank, depth_rank, literal_map

TREND_SCORES = {"rising": 1.0, "steady": 0.5, "fading": 0.0}


def taught_depths(supply: DataFrame) -> DataFrame:
    """``skill_id, taught_depth``: deepest per id, as several supply skills may share one."""
    return (supply.groupBy("skill_id").agg(F.max(depth_rank(F.col("depth"))).alias("_rank"))
            .select("skill_id", depth_of_rank(F.col("_rank")).alias("taught_depth")))


def joined_gaps(demand: DataFrame, supply: DataFrame, trends: DataFrame | None = None,
                untaught_rank: int = -1) -> DataFrame:
    """Demand rows with ``taught_depth``, ``depth_gap`` and, given ``trends``, the trend fields.

    Demand leads, so skills nobody teaches stay, with the rank ``untaught_rank``.
    """
    rows = demand.join(taught_depths(supply), "skill_id", "left")
    if trends is not None:
        rows = rows.join(trends, "skill_id", "left")
    gap = depth_rank(F.col("demand_depth")) - depth_rank(F.col("taught_depth"), missing=untaught_rank)
    return rows.withColumn("depth_gap", gap)


def _scaled(column: str, limits: Column) -> Column:
    """Min-max scaling; a constant column scales to 0."""
    low, high = limits[f"low_{column}"], limits[f"high_{column}"]
    return F.coalesce((F.col(column) - low) / F.nullif(high - low, F.lit(0.0)), F.lit(0.0))


def ranked_gaps(gaps: DataFrame, gap_weight: float = 0.5, employer_weight: float = 0.3,
                trend_weight: float = 0.2, trend_scores: dict[str, float] = TREND_SCORES) -> DataFrame:
    """Add ``priority_score``, the weighted gap, employers and trend, and sort by it.

    The limits for scaling come from one scalar subquery.
    """
    limits = gaps.agg(F.struct(*[
        bound(column).cast("double").alias(f"{name}_{column}")
        for column in ("depth_gap", "distinct_employers") for name, bound in (("low", F.min), ("high", F.max))
    ])).scalar()
    trend = F.coalesce(F.element_at(literal_map(trend_scores), F.col("trend")), F.lit(0.0))
    score = (gap_weight * _scaled("depth_gap", limits) + employer_weight * _scaled("distinct_employers", limits)
             + trend_weight * trend)
    return gaps.withColumn("priority_score", score).orderBy(F.desc("priority_score"), "skill_id")
