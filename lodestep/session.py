"""Session construction and lineage cutting."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

# Only settings the operators rely on. Broadcasting stays with Catalyst, which checks sizes.
SESSION_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(master: str = "local[*]", app: str = "lodestep", **conf: str) -> SparkSession:
    """A session with the settings above; keyword names use ``__`` for dots."""
    builder = SparkSession.builder.master(master).appName(app)
    for key, value in SESSION_CONF.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def checkpoint_folder(spark: SparkSession) -> str:
    """The shared folder the cluster names; where none is named, one beside the warehouse, if executors can reach that."""
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        folder = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/lodestep-checkpoints"
        if folder.startswith("file:") and not context.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share; the warehouse lies on one machine")
    context.setCheckpointDir(folder)
    return folder


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` reliably, so that loops over it survive lost executors."""
    checkpoint_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def new_folder(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that nothing else uses."""
    return f"{checkpoint_folder(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def stored(df: DataFrame, label: str = "table", compression: str = "snappy") -> DataFrame:
    """``df`` written as Parquet to the shared folder and read again.

    Like :func:`cut_lineage`, but Catalyst knows the size of what it reads, so it decides by measure
    whether to broadcast it. The files stay for the life of the shared folder.
    """
    folder = new_folder(df.sparkSession, label)
    df.write.option("compression", compression).parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)
