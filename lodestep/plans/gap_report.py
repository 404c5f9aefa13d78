"""From demand records, supply records and a usage series to ranked gaps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestep.operators import gap, trend


def gap_report(demand: DataFrame, supply: DataFrame, series: DataFrame, target_year: int = 2030,
               threshold: float = 0.0, t_value: float = 2.447, **weights) -> DataFrame:
    """Ranked gaps; ``series`` holds ``skill_id, year, usage``."""
    fitted = trend.fitted_trends(series, target_year, threshold, t_value).select(
        "skill_id", "trend", F.col("estimate").alias("trend_2030_estimate"),
        F.array("low", "high").alias("trend_confidence_band"))
    wanted = demand.select("skill_id", "skill_name", "distinct_employers", "demand_depth")
    return gap.ranked_gaps(gap.joined_gaps(wanted, supply, fitted), **weights)
