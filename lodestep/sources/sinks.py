"""Writers for result records, and row counts of stages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from lodestep.session import stored

def write_records(records: DataFrame, path: str, form: str = "json") -> None:
    """One record per line, written by all tasks; folders are made as needed."""
    records.write.mode("overwrite").format(form).save(path)


def write_record_array(records: DataFrame, path: str, order: list[str | Column]) -> None:
    """One JSON array over the text files of ``path``: read in name order, one after the other, they are the array.

    Rows are sorted by ranges and turned to text where they lie, so any number of records can be written. The numbering is
    stored before the first row is looked up, so a task that runs again changes nothing.
    """
    lines = records.orderBy(*order).select(
        F.to_json(F.struct(*[f"`{name}`" for name in records.columns]), {"ignoreNullFields": "false"}).alias("line"),
        F.monotonically_increasing_id().alias("at"))
    lines = stored(lines, "records")
    first = lines.agg(F.min("at")).first()[0]
    comma = F.when(F.col("at") == F.lit(first), "").otherwise(",")
    ends = records.sparkSession.createDataFrame([("[", -1), ("]", (1 << 63) - 1)], "value string, at long")
    lines.select(F.concat(comma, "line").alias("value"), "at").union(ends).orderBy("at").select("value").write.mode(
        "overwrite").text(path)


def observed(rows: DataFrame, stage: str, *extra: Column) -> tuple[DataFrame, Observation]:
    """``rows`` unchanged, plus counts that are there once an action has run; no extra pass.

    Extra measures must not be exact distinct counts, which cannot be observed in passing.
    """
    seen = Observation(stage)
    return rows.observe(seen, F.count(F.lit(1)).alias("rows"), *extra), seen


def counts_by(rows: DataFrame, column: str = "source") -> DataFrame:
    return rows.groupBy(column).agg(F.count("*").alias("n_rows"))
