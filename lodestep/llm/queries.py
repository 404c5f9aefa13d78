"""One query per operator over the whole tables, with SQL counterparts where SQL can express them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestep.llm import (chat, decontamination, language, licenses, mixing, near_dedup, passages, phrases, quality, spelling, token_files,
                          url_filter, warc)
from lodestep.llm.oracles import ORACLES  # noqa: F401


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_mix_sources(spark: SparkSession, folder: str) -> DataFrame:
    mixed = mixing.mix_sizes(table(spark, folder, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op2_warc(spark: SparkSession, folder: str) -> DataFrame:
    return warc.page_captures(table(spark, folder, "pages"))


def op3_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    return url_filter.judge_urls(table(spark, folder, "pages")).drop("score")


def op4_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    found = decontamination.contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.drop("text_hash")


def op5_language(spark: SparkSession, folder: str) -> DataFrame:
    return language.languages(table(spark, folder, "documents"))


def op6_token_files(spark: SparkSession, folder: str) -> DataFrame:
    return token_files.token_output(table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op7_repeated_passages(spark: SparkSession, folder: str) -> DataFrame:
    return passages.repeated_passages(table(spark, folder, "documents"))


def op8_licenses(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.license_scan(table(spark, folder, "documents")).drop("text_hash")


def op9_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, folder, "documents"))


def op10_quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality.quality(table(spark, folder, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


#: A conversation whose texts look like the template's own marks.
PLANTED = [(-7, turn, role, r"\### Assistant: </turn> ok") for turn, role in enumerate(("user", "assistant"))]


def op11_chat(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    return chat.format_and_read(rows.unionByName(spark.createDataFrame(PLANTED, "conv_id long, turn long, role string, text string")))


def op12_spelling(spark: SparkSession, folder: str) -> DataFrame:
    return spelling.spelling_variants(table(spark, folder, "documents"))


def op13_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return phrases.collocations(table(spark, folder, "documents"))


QUERIES = {name: function for name, function in list(globals().items()) if name.startswith("op") and callable(function)}
