"""Evidence rows rolled up per skill.

A skill may own a third of all evidence, so everything here is a partial aggregate, a bounded top list or a list in numbered
parts; only a record's own list of sources is as long as the skill has sources.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lodestep.functions import fixed_values as fixed
from lodestep.functions.depth import depth_of_rank, depth_rank
from lodestep.operators.ordered import numbered
from lodestep.session import stored

SOURCES_PER_PART = 10_000


def skill_sources(evidence: DataFrame) -> DataFrame:
    """``skill_id, source, ord``: each source of a skill once, with its first mention."""
    return evidence.groupBy("skill_id", "source").agg(F.min("ord").alias("ord"))


def source_parts(evidence: DataFrame, part_size: int = SOURCES_PER_PART) -> DataFrame:
    """``skill_id, part_no, sources``: all sources of a skill in order of first mention, in lists of ``part_size``, numbered from 0.

    A skill that all sources name has many parts; its sources are numbered over ranges, no task holds them all.
    """
    placed = numbered(skill_sources(evidence), "skill_id", "ord", "source")
    part = F.floor((F.col("place") - 1) / part_size).cast("int")
    listed = F.array_sort(F.collect_list(F.struct("place", "source")))
    return placed.groupBy("skill_id", part.alias("part_no")).agg(F.transform(listed, lambda x: x["source"]).alias("sources"))


def first_fragments(evidence: DataFrame, limit: int = fixed.MAX_EVIDENCE) -> DataFrame:
    """``skill_id, evidence``: the first distinct fragments of a skill, at most ``limit``."""
    once = evidence.groupBy("skill_id", "fragment").agg(F.min("ord").alias("ord"))
    place = F.row_number().over(Window.partitionBy("skill_id").orderBy("ord", "fragment"))
    listed = F.array_sort(F.collect_list(F.struct("_place", "fragment")))
    return (
        once.withColumn("_place", place).filter(F.col("_place") <= limit)
        .groupBy("skill_id").agg(F.transform(listed, lambda x: x["fragment"]).alias("evidence"))
    )


def skill_summary(evidence: DataFrame) -> DataFrame:
    """Deepest depth, the most confident row (earliest on ties) and total hours per skill."""
    shown = F.struct("skill_name", "category", "confidence", "match_type",
                     F.col("fragment").alias("original_topic"), "verb", "unit", "source")
    best = F.min_by(shown, F.struct(-F.col("confidence"), F.col("ord")))
    hours = F.coalesce(F.sum(F.nullif(F.col("hours"), F.lit(0))), F.min_by("hours", "ord"))
    return (
        evidence.groupBy("skill_id")
        .agg(F.max(depth_rank(F.col("depth"))).alias("_rank"), best.alias("_best"), hours.cast("int").alias("hours"))
        .select("skill_id", "_best.skill_name", "_best.category", depth_of_rank(F.col("_rank")).alias("depth"),
                "_best.confidence", "_best.match_type", "_best.original_topic", "_best.verb", "_best.unit",
                "hours", "_best.source")
    )


def supply_records(evidence: DataFrame, part_size: int | None = None) -> DataFrame:
    """Output records of the supply side, by category and name.

    ``sources`` is the whole list of a skill, put together from its numbered parts, so only the record itself holds all of it;
    ``n_parts`` is 1 then. With a ``part_size`` it is the first part of the list, ``n_parts`` tells how many there are, and
    :func:`source_parts` has them all. ``n_sources`` is exact.
    """
    parts = stored(source_parts(evidence, part_size or SOURCES_PER_PART), "source-parts", "zstd")
    counts = parts.groupBy("skill_id").agg(F.sum(F.size("sources")).alias("n_sources"), F.count("*").alias("n_parts"))
    if part_size is None:
        in_order = F.array_sort(F.collect_list(F.struct("part_no", "sources")))
        lists = parts.groupBy("skill_id").agg(F.flatten(F.transform(in_order, lambda x: x["sources"])).alias("sources"))
        counts = counts.withColumn("n_parts", F.lit(1).cast("long"))
    else:
        lists = parts.filter("part_no = 0").select("skill_id", "sources")
    return (
        skill_summary(evidence)
        .join(counts, "skill_id").join(lists, "skill_id").join(first_fragments(evidence), "skill_id")
        .orderBy("category", "skill_name")
    )


def category_counts(records: DataFrame) -> DataFrame:
    return records.groupBy("category").agg(F.count("*").alias("n_skills"))
