"""Rows in one order over all tasks: ranges of the order, and what must pass from one range to the next.

A range holds about as many rows as any other, however the keys are spread, so a key that holds a third of all rows lies in many
ranges. Only one small row per key and range ever meets the others of its key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestep.session import stored


def in_ranges(rows: DataFrame, *order: str, name: str = "_range", values: dict[str, Column] | None = None) -> DataFrame:
    """``rows`` dealt out by ranges of ``order`` with the number of their range; numbers ascend with the order.

    The numbers are stored, so a task that runs again changes nothing. Equal rows share a range. To find the ranges Spark
    runs the plan of ``rows`` once more; costly columns belong into ``values``, which are added one after the other to dealt rows.
    """
    width = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.repartitionByRange(width, *order).withColumn(name, F.spark_partition_id())
    for column, value in (values or {}).items():
        dealt = dealt.withColumn(column, value)
    return stored(dealt, "ranges", "zstd")


def numbered(rows: DataFrame, key: str, *order: str, name: str = "place") -> DataFrame:
    """Add the number of each row among those of its key, from 1, in ``order``."""
    ranged = in_ranges(rows, key, *order)
    sizes = ranged.groupBy(key, "_range").agg(F.count("*").alias("_n"))
    before = Window.partitionBy(key).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(F.col(key).alias("_key"), F.col("_range").alias("_at"),
                          F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    inside = F.row_number().over(Window.partitionBy(key, "_range").orderBy(*order))
    placed = ranged.withColumn("_inside", inside).join(
        starts, F.col(key).eqNullSafe(F.col("_key")) & (F.col("_range") == F.col("_at")))
    return placed.withColumn(name, F.col("_before") + F.col("_inside")).drop("_range", "_inside", "_key", "_at", "_before")
