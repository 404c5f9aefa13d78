"""Monthly posting snapshots that build up a demand series.

On a stream, the employers of each (month, skill) and the postings of each of them are kept as state, so a new posting costs two look-ups,
made by Spark's own tasks, and says what it changes: one posting more and, if it is the employer's first, one employer more. Micro-batches file
these changes; their sums are the exact counts. No month is ever counted again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.readwriter import DataStreamWriter

#: The state of the streams below lives in this store; a session must name it before such a stream starts.
STATE_STORE = ("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
_CHANGES = "period date, skill_idx string, employers long, postings long"


def snapshot_counts(pairs: DataFrame, period: str = "month") -> DataFrame:
    """``period, skill_idx, employers, postings`` of ``posted_at, skill_idx, employer, posting``.

    Counted in two steps, so neither a hot skill nor a hot employer fills one task.
    """
    when = F.date_trunc(period, "posted_at").cast("date").alias("period")
    return (
        pairs.groupBy(when, "skill_idx", "employer").agg(F.count("*").alias("postings"))
        .groupBy("period", "skill_idx").agg(F.count("*").alias("employers"), F.sum("postings").alias("postings"))
    )


def snapshot_changes(stream: DataFrame, period: str = "month") -> DataFrame:
    """Changes ``period, skill_idx, employers, postings`` that a stream of ``posted_at, skill_idx, employer, posting`` brings.

    A row says one posting more or, where it is an employer's first of a skill and period, one employer more. Repeated postings
    change nothing, in whichever micro-batch they come. A hot skill is spread over its employers, a hot employer over its postings.
    Ids are carried as text, null as empty.
    """
    text = {name: F.coalesce(F.col(name).cast("string"), F.lit("")) for name in ("skill_idx", "employer", "posting")}
    dated = stream.withColumns(text).select(
        F.date_trunc(period, "posted_at").cast("date").alias("period"), "skill_idx", "employer", "posting")

    def first_seen(*key: str, employers: int, postings: int) -> DataFrame:
        return dated.dropDuplicates(["period", "skill_idx", *key]).select(
            "period", "skill_idx", F.lit(employers).cast("long").alias("employers"), F.lit(postings).cast("long").alias("postings"))

    return first_seen("employer", employers=1, postings=0).unionByName(first_seen("employer", "posting", employers=0, postings=1))


def file_snapshots(stream: DataFrame, store: str, checkpoint: str, period: str = "month") -> DataStreamWriter:
    """Writer that files the changes of a stream under ``store``, one folder per micro-batch; a batch that runs again overwrites its own."""
    def file_batch(batch: DataFrame, batch_id: int) -> None:
        summed = batch.groupBy("period", "skill_idx").agg(F.sum("employers").alias("employers"), F.sum("postings").alias("postings"))
        (summed.withColumn("batch", F.lit(batch_id)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("batch").parquet(store))

    return snapshot_changes(stream, period).writeStream.outputMode("append").foreachBatch(file_batch).option("checkpointLocation", checkpoint)


def stored_counts(spark: SparkSession, store: str) -> DataFrame:
    """``period, skill_idx, employers, postings`` of all changes filed so far; ``skill_idx`` as text."""
    changes = spark.read.schema(_CHANGES + ", batch long").parquet(store)
    return changes.groupBy("period", "skill_idx").agg(F.sum("employers").alias("employers"), F.sum("postings").alias("postings"))


def live_counts(stream: DataFrame, delay: str = "10 minutes", width: str = "30 days") -> DataFrame:
    """Approximate employers per skill and time window on a stream."""
    return (
        stream.withWatermark("posted_at", delay).groupBy(F.window("posted_at", width), "skill_idx")
        .agg(F.approx_count_distinct("employer").alias("employers"), F.count("*").alias("postings"))
    )
