"""Checks of results against labels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def top_n_accuracy(hits: DataFrame, labels: DataFrame, ns: tuple[int, ...] = (1, 3)) -> DataFrame:
    """One row ``n_items, top_<n>...``; ``hits`` holds ``item_id, place, skill_id``.

    An item without any hit counts as missed.
    """
    right = hits.join(labels, "item_id").filter(F.col("skill_id") == F.col("expected_skill_id"))
    first = right.groupBy("item_id").agg(F.min("place").alias("place"))
    placed = labels.join(first, "item_id", "left")
    return placed.agg(F.count("*").alias("n_items"), *[
        F.avg(F.coalesce(F.col("place") <= n, F.lit(False)).cast("double")).alias(f"top_{n}") for n in ns
    ])


def agreement_rate(predicted: DataFrame) -> DataFrame:
    """One row ``n_items, agreement`` from ``predicted, expected``."""
    same = F.coalesce(F.col("predicted") == F.col("expected"), F.lit(False))
    return predicted.agg(F.count("*").alias("n_items"), F.avg(same.cast("double")).alias("agreement"))


def confusion(predicted: DataFrame, classes: list[str]) -> DataFrame:
    """Rows by expected class, one count column per predicted class."""
    return predicted.groupBy("expected").agg(*[
        F.count_if(F.col("predicted") == name).alias(name) for name in classes
    ])


def pass_rate(results: DataFrame, by: list[str]) -> DataFrame:
    """``n_challenges, pass_rate`` of ``verified`` flags per group."""
    return results.groupBy(*by).agg(F.count("*").alias("n_challenges"),
                                    F.avg(F.col("verified").cast("double")).alias("pass_rate"))


def measured_gaps(inferred: DataFrame, attempts: DataFrame) -> DataFrame:
    """Inferred gap beside the measured failure rate of attempts, per skill."""
    measured = attempts.groupBy("skill_id").agg(F.count("*").alias("attempts"),
                                                (1 - F.avg(F.col("passed").cast("double"))).alias("measured_gap"))
    return inferred.join(measured, "skill_id").select("skill_id", "depth_gap", "attempts", "measured_gap")
