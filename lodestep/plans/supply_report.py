"""From extracted syllabus text to supply records."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestep.functions import fixed_values as fixed
from lodestep.functions.taxonomy import TAXONOMY, Entry, kept_entries
from lodestep.operators import chunks, dictionary, rollup, tagging
from lodestep.session import stored


def syllabus_chunks(pages: DataFrame, table_rows: DataFrame, external: DataFrame | None = None) -> DataFrame:
    """Chunks of core courses with ``source`` and ``chunk_ord``.

    Both kinds of chunks are written once, as the cascade counts them before it picks.
    """
    core = chunks.core_courses(pages)
    tables = stored(chunks.table_chunks(table_rows.join(core, "doc", "left_semi")), "tables", "zstd")
    lines = stored(chunks.line_chunks(pages.join(core, "doc", "left_semi")), "lines", "zstd")
    return placed(chunks.cascaded_chunks(core, tables, lines, external))


def placed(chosen: DataFrame) -> DataFrame:
    return chosen.withColumns({
        "source": F.col("doc"), "chunk_ord": F.struct("doc", "page_no", "part_no", "row_no")})


def topic_evidence(topics: DataFrame, vectors: DataFrame | None = None, entry_vectors: DataFrame | None = None,
                   taxonomy: list[Entry] = TAXONOMY, threshold: float = fixed.SEMANTIC_MIN) -> DataFrame:
    """Evidence with verb and depth; without vectors only patterns tag."""
    tagged = tagging.tagged_chunks(topics, taxonomy)
    evidence = tagging.alias_evidence(tagged, taxonomy)
    if vectors is not None and entry_vectors is not None:
        rest = tagging.unmatched_fragments(tagged)
        evidence = evidence.unionByName(
            tagging.semantic_evidence(rest, vectors, entry_vectors, taxonomy, threshold))
    return tagging.with_depth(evidence)


def linked_supply(records: DataFrame, entries: DataFrame, taxonomy: list[Entry] = TAXONOMY) -> DataFrame:
    """Supply records under dictionary ids; several skills may share one id afterwards."""
    targets = tagging.taxonomy_table(records.sparkSession, taxonomy).select(
        F.col("skill_name").alias("name"), "target")
    linked = dictionary.link_to_dictionary(records, targets, dictionary.linked_labels(entries))
    return (
        linked.withColumn("skill_id", F.col("dictionary_id"))
        .withColumnsRenamed({"dictionary_id": "esco_id", "dictionary_name": "esco_name"})
        .orderBy("category", "skill_name")
    )


def supply_report(pages: DataFrame, table_rows: DataFrame, entries: DataFrame | None = None,
                  external: DataFrame | None = None, vectors: DataFrame | None = None,
                  entry_vectors: DataFrame | None = None, taxonomy: list[Entry] = TAXONOMY) -> DataFrame:
    """Supply records; without a dictionary they keep their taxonomy ids.

    Evidence is written once, as the rollup reads it several times and tagging is the costly part.
    """
    taxonomy = kept_entries(taxonomy)
    topics = syllabus_chunks(pages, table_rows, external)
    evidence = stored(topic_evidence(topics, vectors, entry_vectors, taxonomy), "evidence", "zstd")
    records = rollup.supply_records(evidence)
    return records if entries is None else linked_supply(records, entries, taxonomy)
