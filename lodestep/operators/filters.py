"""Row filters over postings, dictionaries and skill strings. None of them shuffles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestep.functions import fixed_values as fixed
from lodestep.functions.text import employer_key, ignore_case, matches, norm, strip


def named_employers(postings: DataFrame, employer: str = "employer",
                    placeholder: str = fixed.PLACEHOLDER_EMPLOYER) -> DataFrame:
    """Drop blank and placeholder employers; add ``employer_key``, which is never empty."""
    name = F.col(employer)
    return (
        postings.filter(~matches(name, placeholder) & (strip(name) != ""))
        .withColumn("employer_key", employer_key(name))
        .filter(F.col("employer_key") != "")
    )


def is_entry_level(exp_min: Column, exp_text: Column,
                   max_years: float = fixed.ENTRY_LEVEL_MAX_YEARS,
                   pattern: str = fixed.ENTRY_LEVEL_TEXT) -> Column:
    """The number decides where there is one, the text otherwise."""
    return F.when(exp_min.isNotNull(), exp_min <= max_years).otherwise(matches(exp_text, pattern))


def entry_level(postings: DataFrame, exp_min: str = "exp_min", exp_text: str = "exp_text",
                max_years: float = fixed.ENTRY_LEVEL_MAX_YEARS,
                pattern: str = fixed.ENTRY_LEVEL_TEXT) -> DataFrame:
    return postings.filter(is_entry_level(F.col(exp_min), F.col(exp_text), max_years, pattern))


def is_coding_title(title: Column, include: str = fixed.TITLE_INCLUDE,
                    exclude: str = fixed.TITLE_EXCLUDE, senior: str = fixed.TITLE_SENIOR) -> Column:
    return matches(title, include) & ~matches(title, exclude) & ~matches(title, senior)


def coding_titles(postings: DataFrame, title: str = "title", include: str = fixed.TITLE_INCLUDE,
                  exclude: str = fixed.TITLE_EXCLUDE, senior: str = fixed.TITLE_SENIOR) -> DataFrame:
    return postings.filter(is_coding_title(F.col(title), include, exclude, senior))


def title_flags(title: Column, builder: str = fixed.TITLE_BUILDER,
                junior: str = fixed.TITLE_JUNIOR) -> list[Column]:
    return [matches(title, builder).alias("core_builder"), matches(title, junior).alias("junior_role")]


def keyword_entries(dictionary: DataFrame, label: str = "label", alternatives: str | None = "alt_labels",
                    keywords: str = fixed.DIGITAL_KEYWORDS) -> DataFrame:
    """Dictionary rows whose label or alternative labels hold a keyword."""
    blob = F.col(label)
    if alternatives is not None and alternatives in dictionary.columns:
        blob = F.concat(blob, F.lit(" "), F.coalesce(F.col(alternatives), F.lit("")))
    return dictionary.filter(blob.rlike(ignore_case(keywords)))


def is_specific_skill(raw: Column, vague: list[str] = fixed.VAGUE_SKILLS, min_length: int = 2) -> Column:
    """Whether a skill string says enough to be mapped."""
    bare = norm(raw)
    return (F.length(bare) >= min_length) & ~bare.isin(vague)
