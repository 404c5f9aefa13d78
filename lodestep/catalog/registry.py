"""Named queries over the parquet tables, each with the SQL it must agree with where there is one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


class Tables:
    """The parquet tables of a folder, read on demand, and inputs derived from them in SQL."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def __getattr__(self, name: str) -> DataFrame:
        if name not in TABLES:
            raise AttributeError(name)
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def spread(self, rows: DataFrame) -> DataFrame:
        """``rows`` over all cores, for work that costs time: a small file is a single split."""
        cores = self.spark.sparkContext.defaultParallelism
        return rows.repartition(cores) if rows.rdd.getNumPartitions() < cores else rows

    def derived(self, sql: str) -> DataFrame:
        used = {name: getattr(self, name) for name in TABLES if "{" + name + "}" in sql}
        if "lineitem" in used:
            used["lineitem"] = self.spread(used["lineitem"])
        return self.spark.sql(sql, **used)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    """Register a function of :class:`Tables` and, if given, its SQL."""
    def register(function: Callable[[Tables], DataFrame]):
        QUERIES[name] = lambda spark, folder: function(Tables(spark, folder))
        if oracle is not None:
            ORACLES[name] = oracle.strip()
        return function
    return register
