"""Extracted syllabus text and table rows. Decoding documents happens before this library."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

PAGES = "doc string, page_no int, text string"
TABLE_ROWS = "doc string, page_no int, table_no int, row_no int, cells array<string>"


def read_pages(spark: SparkSession, path: str, form: str = "parquet") -> DataFrame:
    return spark.read.format(form).schema(PAGES).load(path)


def read_table_rows(spark: SparkSession, path: str, form: str = "parquet") -> DataFrame:
    return spark.read.format(form).schema(TABLE_ROWS).load(path)
