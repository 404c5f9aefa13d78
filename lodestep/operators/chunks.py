"""Topic rows of syllabus documents, from lesson tables or, failing those, from text lines.

Chunks hold ``doc, page_no, part_no, row_no, raw, bt, unit, hours, kind``; the number columns
give their order inside a document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestep.functions import fixed_values as fixed
from lodestep.functions.syllabus import (
    cleaned_cells, contact_hours, course_verdict, detected_header, line_fields,
)
from lodestep.functions.text import ignore_case, lines_of, matches, strip
from lodestep.operators.carry import carry_forward
from lodestep.session import stored

_CHUNK = ["doc", "page_no", "part_no", "row_no", "raw", "bt", "unit", "hours", "kind"]


def document_lengths(pages: DataFrame, min_text: int = fixed.MIN_PAGE_TEXT) -> DataFrame:
    """``doc, n_pages, text_length, unreadable``."""
    return pages.groupBy("doc").agg(
        F.count("*").alias("n_pages"),
        F.sum(F.length(strip(F.col("text")))).alias("text_length"),
    ).withColumn("unreadable", F.col("text_length") < min_text)


def vetted_courses(pages: DataFrame, first_page: int = 1, **rules) -> DataFrame:
    """``doc, ok, reason`` from each document's first page and file name."""
    verdict = course_verdict(F.col("text"), F.col("doc"), **rules)
    return pages.filter(F.col("page_no") == first_page).select("doc", verdict.alias("_v")).select("doc", "_v.*")


def core_courses(pages: DataFrame, **rules) -> DataFrame:
    """Documents that passed vetting."""
    return vetted_courses(pages, **rules).filter("ok").select("doc")


def table_chunks(rows: DataFrame, topic_pattern: str = fixed.HEADER_TOPIC,
                 hours_pattern: str = fixed.HEADER_HOURS, min_length: int = 3) -> DataFrame:
    """Topics of table rows ``doc, page_no, table_no, row_no, cells``.

    The last header, on whatever page or table, rules the rows after it that have its width.
    """
    cells = F.col("cells")
    ruled = carry_forward(rows.filter(F.size("cells") > 0), "doc", ["page_no", "table_no", "row_no"], {"h": F.col("_header")}, {
        "cells": cleaned_cells(cells), "_header": detected_header(cells, topic_pattern, hours_pattern)})

    def cell(role: str) -> Column:
        return F.get(cells, F.col(f"h.{role}"))

    return (
        ruled.filter(F.col("_header").isNull() & (F.size(cells) == F.col("h.ncols")))
        .filter(F.length(cell("topic")) >= min_length)
        .select(
            "doc", "page_no", F.col("table_no").alias("part_no"), "row_no",
            cell("topic").alias("raw"),
            F.coalesce(cell("bt"), F.lit("")).alias("bt"),
            F.nullif(cell("unit"), F.lit("")).alias("unit"),
            contact_hours(cell("hours"), F.col("h.kind")).alias("hours"),
            F.col("h.kind").alias("kind"),
        )
    )


def _holds(line: Column, marks: list[str]) -> Column:
    hit = F.lit(False)
    for mark in marks:
        hit = hit | line.contains(mark)
    return hit


def line_chunks(pages: DataFrame, on: list[str] = fixed.SECTION_ON, off: list[str] = fixed.SECTION_OFF,
                unit_pattern: str = fixed.UNIT_LINE, skip_pattern: str = fixed.SKIP_LINE,
                min_length: int = 5) -> DataFrame:
    """Topics of the lines of ``doc, page_no, text`` between an on-mark and an off-mark.

    The section and the unit carry over pages. Mark lines give no topic and no unit; a unit line
    counts outside sections as well.
    """
    lines = pages.select("doc", "page_no", F.posexplode(lines_of(F.col("text"))).alias("row_no", "line"))
    line = F.col("line")
    opens, closes = _holds(line, on), _holds(line, off)
    unit = F.when(~opens & ~closes & matches(line, unit_pattern),
                  F.regexp_extract(line, ignore_case(unit_pattern), 1))
    state = F.when(opens, F.lit(True)).when(closes, F.lit(False))
    ruled = carry_forward(lines, "doc", ["page_no", "row_no"], {"inside": state, "unit": unit})
    return (
        ruled.filter(F.col("inside") & ~opens & ~closes & (F.length(line) >= min_length)
                     & ~matches(line, skip_pattern))
        .withColumn("_f", line_fields(line)).filter(F.col("_f.raw") != "")
        .select("doc", "page_no", F.lit(0).alias("part_no"), "row_no", "_f.raw", "_f.bt", "unit",
                "_f.hours", F.lit("theory").alias("kind"))
    )


def cascaded_chunks(docs: DataFrame, tables: DataFrame, lines: DataFrame, external: DataFrame | None = None,
                    min_topics: int = fixed.MIN_TOPICS) -> DataFrame:
    """For each document: table rows if there are enough, else lines, else external chunks.

    A document without external chunks keeps its few lines. ``origin`` names the source used.
    """
    def counted(chunks: DataFrame, name: str) -> DataFrame:
        return chunks.groupBy("doc").agg(F.count("*").alias(name))

    counts = docs.join(counted(tables, "_t"), "doc", "left").join(counted(lines, "_l"), "doc", "left")
    if external is None:
        counts = counts.withColumn("_e", F.lit(0))
    else:
        counts = counts.join(counted(external, "_e"), "doc", "left")
    # Of a known size, so where documents are few the chunks stay where they are.
    choice = stored(counts.select("doc", F.when(F.col("_t") >= min_topics, "table").when(F.col("_l") >= min_topics, "line")
                                  .when(F.col("_e") > 0, "external").otherwise("line").alias("origin")), "choice")

    def branch(chunks: DataFrame, name: str) -> DataFrame:
        return chunks.select(*_CHUNK).join(choice.filter(F.col("origin") == name), "doc")

    chosen = branch(tables, "table").unionByName(branch(lines, "line"))
    if external is not None:
        chosen = chosen.unionByName(branch(external, "external"))
    return chosen
