"""Carrying the last known value forward through the rows of a document.

The rows lie in ranges of the whole order, so a document of any size, and one page of any size, is spread over many tasks.
Each range hands its last values on to the later ranges of the document; the scan itself stays inside a range.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestep.operators.ordered import in_ranges


def carry_forward(rows: DataFrame, doc: str, order: list[str], values: dict[str, Column],
                  first: dict[str, Column] | None = None) -> DataFrame:
    """Add each of ``values`` under its name: the last non-null one up to and with the row, in any ``order``.

    ``first`` are columns to add before, that ``values`` may use.
    """
    marked = in_ranges(rows, doc, *order, values={**(first or {}), **{f"_v_{name}": value for name, value in values.items()}})
    place = F.struct(*order)
    ends = marked.groupBy(doc, "_range").agg(*[
        F.max_by(f"_v_{name}", F.when(F.col(f"_v_{name}").isNotNull(), place)).alias(f"_end_{name}")
        for name in values
    ])
    before = Window.partitionBy(doc).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    # What a range is handed stands before its rows, so they are dealt out and sorted once, and join nothing.
    handed = ends.select(doc, "_range", F.lit(True).alias("_handed"), *[
        F.last(f"_end_{name}", ignorenulls=True).over(before).alias(f"_v_{name}") for name in values
    ])
    inside = Window.partitionBy(doc, "_range").orderBy(F.col("_handed").desc(), *order).rowsBetween(Window.unboundedPreceding, 0)
    carried = marked.withColumn("_handed", F.lit(False)).unionByName(handed, allowMissingColumns=True).withColumns({
        name: F.last(f"_v_{name}", ignorenulls=True).over(inside) for name in values
    })
    return carried.filter("not _handed").drop("_range", "_handed", *[f"_v_{name}" for name in values])
