"""The skill dictionary: surface forms, lookups and two-hop linking.

A dictionary is a table ``skill_idx, uri, label, alt_labels``; ``skill_idx`` carries the source
order that "first row wins" rules need. No side is broadcast by hint: Catalyst does so when the
measured size allows it and shuffles by key otherwise.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestep.functions import fixed_values as fixed
from lodestep.functions.text import dictionary_id, norm, strip_paren
from lodestep.operators.filters import is_specific_skill


def listed_entries(dictionary: DataFrame, subset: DataFrame, uri: str = "uri",
                   subset_uri: str = "uri") -> DataFrame:
    """Dictionary rows whose uri the subset list holds."""
    wanted = subset.select(F.col(subset_uri).alias("_wanted"))
    return dictionary.join(wanted, dictionary[uri] == wanted["_wanted"], "left_semi")


def surface_forms(dictionary: DataFrame) -> DataFrame:
    """``form, skill_idx``: every normalised form once, owned by the first row that has it."""
    own = F.array(norm(F.col("label")), strip_paren(F.col("label")))
    alternatives = F.transform(F.split("alt_labels", "\n"), norm)
    forms = F.when(F.col("alt_labels").isNull(), own).otherwise(F.concat(own, alternatives))
    return (
        dictionary.select("skill_idx", F.explode(F.array_distinct(forms)).alias("form"))
        .groupBy("form").agg(F.min("skill_idx").alias("skill_idx"))
    )


def alias_table(spark, aliases: dict[str, str] = fixed.SKILL_ALIASES) -> DataFrame:
    return spark.createDataFrame(list(aliases.items()), "alias string, target string")


def with_aliases(forms: DataFrame, aliases: DataFrame) -> DataFrame:
    """Point each alias at the entry of its target; an alias replaces a form of the same text.

    ``aliases`` holds ``alias, target``. An alias whose target is no form is left out.
    """
    wanted = (
        aliases.select(norm(F.col("alias")).alias("alias"), norm(F.col("target")).alias("form"))
        .join(forms, "form")
        .groupBy(F.col("alias").alias("form")).agg(F.max("skill_idx").alias("skill_idx"))
    )
    return forms.join(wanted, "form", "left_anti").unionByName(wanted)


def distinct_skills(postings_skills: DataFrame, raw: str = "raw") -> DataFrame:
    return postings_skills.select(raw).distinct()


def exact_matches(skills: DataFrame, forms: DataFrame, vague: list[str] = fixed.VAGUE_SKILLS,
                  raw: str = "raw") -> DataFrame:
    """Rows of ``skills`` whose string equals a form after normalising, with ``skill_idx, how``.

    Rows need not be distinct: the test is one hash lookup, so folding them first would only
    add a shuffle.
    """
    return (
        skills.filter(is_specific_skill(F.col(raw), vague))
        .withColumn("form", norm(F.col(raw)))
        .join(forms, "form").drop("form")
        .withColumn("how", F.lit("exact"))
    )


def unmatched_skills(skills: DataFrame, mapping: DataFrame, vague: list[str] = fixed.VAGUE_SKILLS,
                     raw: str = "raw") -> DataFrame:
    """Specific skill strings that ``mapping`` lacks; the input of the nearest-label search."""
    return (skills.filter(is_specific_skill(F.col(raw), vague))
            .join(mapping.select(raw), raw, "left_anti"))


def linked_labels(dictionary: DataFrame, order: str = "skill_idx") -> DataFrame:
    """``label_key, dictionary_id, dictionary_name``: one row per label whatever its case.

    Of rows with the same label the first counts; of labels that differ in case only, the last.
    """
    first = dictionary.groupBy("label").agg(
        F.min(order).alias(order), F.min_by("uri", order).alias("uri"))
    uri = F.coalesce(F.nullif(F.col("uri"), F.lit("")), F.col("label"))
    return (
        first.groupBy(F.lower("label").alias("label_key"))
        .agg(F.max_by(F.struct(dictionary_id(uri).alias("id"), F.col("label").alias("name")), order).alias("_last"))
        .select("label_key", F.col("_last.id").alias("dictionary_id"), F.col("_last.name").alias("dictionary_name"))
    )


def link_to_dictionary(skills: DataFrame, targets: DataFrame, links: DataFrame,
                       name: str = "skill_name") -> DataFrame:
    """Add ``dictionary_id`` and ``dictionary_name`` by skill name -> target label -> entry.

    ``targets`` holds ``name, target``. Without an entry the id comes from the skill name itself.
    """
    keys = targets.select(F.col("name").alias(name), F.lower("target").alias("label_key"))
    joined = skills.join(keys, name, "left").join(links, "label_key", "left").drop("label_key")
    return joined.withColumns({
        "dictionary_id": F.coalesce("dictionary_id", dictionary_id(F.col(name))),
        "dictionary_name": F.coalesce("dictionary_name", F.col(name)),
    })

