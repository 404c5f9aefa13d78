"""From raw postings to demand records."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestep.functions import fixed_values as fixed
from lodestep.functions.text import fingerprint
from lodestep.operators import demand, dictionary, filters, nearest
from lodestep.operators.near_duplicates import keep_first
from lodestep.session import cut_lineage, stored


def printed_postings(postings: DataFrame) -> DataFrame:
    """Postings of named employers with their fingerprint ``_print``, written once, as the removal of near-duplicates reads them several times."""
    printed = fingerprint(F.col("title"), F.col("skills"), F.col("description"))
    return stored(filters.named_employers(postings).withColumn("_print", printed), "postings")


def unique_printed(printed: DataFrame, threshold: float = fixed.NEAR_DUPLICATE_RATIO, blocking: str = "exact") -> DataFrame:
    return keep_first(printed, "employer_key", "posting", "_print", threshold, blocking).drop("_print")


def unique_postings(postings: DataFrame, threshold: float = fixed.NEAR_DUPLICATE_RATIO,
                    blocking: str = "exact") -> DataFrame:
    """Postings of named employers without near-duplicates inside an employer.

    This comes before the experience and title filters: a posting they would drop still counts as
    the first copy.
    """
    return unique_printed(printed_postings(postings), threshold, blocking)


def stage_counts(postings: DataFrame, threshold: float = fixed.NEAR_DUPLICATE_RATIO, blocking: str = "exact") -> DataFrame:
    """``stage_no, stage, n_rows``: how many postings each stage before the skills leaves.

    Named and unique postings are written once, so the stages after them read what is left.
    """
    printed = printed_postings(postings)
    unique = stored(unique_printed(printed, threshold, blocking), "unique")
    stages = [("read", postings), ("named employers", printed), ("unique", unique),
              ("entry level", filters.entry_level(unique)), ("coding titles", filters.coding_titles(filters.entry_level(unique)))]
    counted = [rows.agg(F.count("*").alias("n_rows")).select(F.lit(no).alias("stage_no"), F.lit(name).alias("stage"), "n_rows")
               for no, (name, rows) in enumerate(stages, 1)]
    return reduce(DataFrame.unionByName, counted)


def mapped_skills(raw_skills: DataFrame, entries: DataFrame, aliases: DataFrame | None = None,
                  skill_vectors: DataFrame | None = None, entry_vectors: DataFrame | None = None,
                  threshold: float = fixed.NEAREST_LABEL_MIN,
                  margin: float = fixed.NEAREST_LABEL_MARGIN) -> DataFrame:
    """``raw_skills`` with ``skill_idx, how``: exact form or alias first, then vectors.

    Vectors are optional; ``skill_vectors`` holds ``raw, vector``, ``entry_vectors`` ``entry_id, vector``.
    Only distinct strings without an exact match are searched by vector.
    """
    forms = dictionary.surface_forms(entries)
    if aliases is not None:
        forms = dictionary.with_aliases(forms, aliases)
    exact = dictionary.exact_matches(raw_skills, forms)
    if skill_vectors is None or entry_vectors is None:
        return exact
    skills = dictionary.distinct_skills(raw_skills)
    rest = dictionary.unmatched_skills(skills, dictionary.exact_matches(skills, forms))
    # Numbers, not hashes, stand for the strings: no two share one. They are written once, as both joins must see the same.
    numbered = cut_lineage(rest.join(skill_vectors, "raw").withColumn("query_id", F.monotonically_increasing_id()))
    found = nearest.accepted(nearest.nearest_entries(numbered, entry_vectors), threshold, margin)
    mapping = numbered.join(found, "query_id").select(
        "raw", F.col("entry_id").alias("skill_idx"), F.lit("embed").alias("how"))
    return exact.unionByName(raw_skills.join(mapping, "raw"))


def posting_skill_table(postings: DataFrame, entries: DataFrame, aliases: DataFrame | None = None,
                        **vectors) -> DataFrame:
    """Posting-skill pairs of postings that are unique already; applies the row filters."""
    wanted = filters.coding_titles(filters.entry_level(postings))
    named = wanted.withColumn("employer", F.col("employer_key"))
    raw = demand.listed_skills(named, "skills", ("employer", "title"))
    return demand.posting_skills(mapped_skills(raw, entries, aliases, **vectors))


def demand_report(postings: DataFrame, entries: DataFrame, aliases: DataFrame | None = None,
                  forced_k: int | None = None, trends: DataFrame | None = None, blocking: str = "exact",
                  keyword_ranges: dict[str, tuple[float, float]] | None = None, **vectors) -> DataFrame:
    """Demand records. Without vectors only exact forms and aliases map.

    The counts per skill and employer are written once: both the threshold and the records need them.
    """
    pairs = posting_skill_table(unique_postings(postings, blocking=blocking), entries, aliases, **vectors)
    base = cut_lineage(demand.employer_skill_counts(pairs))
    return demand.demand_records(demand.verified_skills(base, forced_k), entries, trends, keyword_ranges=keyword_ranges)
