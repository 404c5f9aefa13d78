"""Tagging topics with taxonomy entries, by alias first and by vector for the rest.

A taxonomy is a table of any size. Its aliases are an index of word runs, with their plurals: a text is cut into all runs of as
many words as the longest alias has, and the runs are joined with the index by equality. Aliases that are patterns
are rules on what the index finds. Equal texts are cut and looked up once.

Tagged chunks carry ``chunk_ord``, any orderable column that says which chunk came first.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestep.functions import fixed_values as fixed
from lodestep.functions.depth import depth_of_verb, leading_verb
from lodestep.functions.syllabus import split_topics
from lodestep.functions.taxonomy import RAW_MARK, TAXONOMY, WORD, Entry, alias_grams, alias_pattern, folded
from lodestep.functions.text import slug
from lodestep.operators.nearest import best_entry
from lodestep.session import cut_lineage, stored

Taxonomy = list[Entry] | DataFrame


def taxonomy_table(spark: SparkSession, taxonomy: Taxonomy = TAXONOMY) -> DataFrame:
    """``skill_no, skill_id, skill_name, category, target, aliases, sem_text`` of a taxonomy.

    ``sem_text`` describes an entry to an embedding model: its name and the first 200 characters of its plain aliases. A table
    needs all columns but ``skill_id`` and ``sem_text``, which follow from the others.
    """
    if isinstance(taxonomy, DataFrame):
        rows = taxonomy
    else:
        rows = spark.createDataFrame([(i, e.name, e.category, e.label, e.aliases) for i, e in enumerate(taxonomy)],
                                     "skill_no int, skill_name string, category string, target string, aliases array<string>")
    plain = F.filter("aliases", lambda alias: ~alias.startswith(RAW_MARK))
    return rows.select(
        "skill_no", F.concat(F.lit(fixed.TAXONOMY_ID_PREFIX), slug(F.col("skill_name"))).alias("skill_id"), "skill_name", "category",
        "target", "aliases", F.concat_ws(": ", "skill_name", F.substring(F.array_join(plain, ", "), 1, 200)).alias("sem_text"))


def alias_index(table: DataFrame) -> DataFrame:
    """``skill_no, gram, n_words, rule`` of a taxonomy table.

    ``rule`` is the pattern that a text with the run must match too, null where the run is enough. An alias of which no
    run can be told has a null ``gram``: its rule is tried on all texts.
    """
    aliases = table.select("skill_no", F.explode("aliases").alias("alias"))

    def lines(batches):
        for batch in batches:
            found = []
            for skill_no, alias in zip(batch["skill_no"], batch["alias"]):
                runs = alias_grams(alias)
                rule = alias_pattern(alias) if runs is None or alias.startswith(RAW_MARK) else None
                found += [(skill_no, run, len(re.findall(f"{WORD}+", run or "")), rule) for run in runs or [None]]
            yield batch.iloc[:0].reindex(columns=["skill_no", "gram", "n_words", "rule"]) if not found else type(batch)(
                found, columns=["skill_no", "gram", "n_words", "rule"])

    return aliases.mapInPandas(lines, "skill_no int, gram string, n_words int, rule string").distinct()


def word_runs(text: Column, longest: int) -> Column:
    """All runs of up to ``longest`` words of a text, with what stands between the words."""
    def runs(n: int) -> Column:
        more = f"(?:[^\\w+#]++{WORD}++){{{n - 1}}}"
        return F.regexp_extract_all(text, F.lit(f"(?U)(?=({WORD}++{more})){WORD}++"), F.lit(1))

    return F.coalesce(F.array_distinct(F.concat(*(runs(n) for n in range(1, longest + 1)))), F.array().cast("array<string>"))


def named_entries(texts: DataFrame, table: DataFrame) -> DataFrame:
    """``key, unit_no, skill_no`` of ``texts`` (``key, unit_no, low``): which entries each folded text names, once each."""
    index = stored(alias_index(table), "aliases")   # of a known size, so a small one meets the runs where they are cut
    longest = index.agg(F.coalesce(F.max("n_words"), F.lit(0))).first()[0]
    found = None
    if longest:
        runs = texts.select("key", "unit_no", F.explode(word_runs(F.col("low"), longest)).alias("gram"))
        met = runs.join(index, "gram").select("key", "unit_no", "skill_no", "rule").distinct()
        found = met.filter("rule IS NULL").select("key", "unit_no", "skill_no")
        if not index.filter("gram IS NOT NULL AND rule IS NOT NULL").isEmpty():
            ruled = met.filter("rule IS NOT NULL").join(texts, ["key", "unit_no"]).filter(F.expr("low rlike rule"))
            found = found.unionByName(ruled.select("key", "unit_no", "skill_no"))
    for row in index.filter("gram IS NULL").collect():
        tried = texts.filter(F.col("low").rlike(row["rule"])).select("key", "unit_no", F.lit(row["skill_no"]).alias("skill_no"))
        found = tried if found is None else found.unionByName(tried)
    empty = texts.select("key", "unit_no", F.lit(0).alias("skill_no")).limit(0)
    return empty if found is None else found.distinct()


def tagged_chunks(chunks: DataFrame, taxonomy: Taxonomy = TAXONOMY, text: str = "raw") -> DataFrame:
    """Add ``fragments`` and ``hits``, the entries a text names with the first fragment that does (else the whole text).

    Texts are told apart by their 128-bit digest, so each distinct one is cut and looked up once, however many chunks share it.
    """
    table = taxonomy_table(chunks.sparkSession, taxonomy)
    keyed = chunks.withColumn("_key", F.md5(text))
    distinct = keyed.select(F.col("_key").alias("key"), F.col(text).alias("whole")).dropDuplicates(["key"]).filter("whole IS NOT NULL")
    units = stored(distinct.select("key", F.posexplode(F.concat(F.array("whole"), split_topics(F.col("whole")))).alias("unit_no", "unit")), "units")
    named = named_entries(units.select("key", "unit_no", folded(F.col("unit")).alias("low")), table)
    places = named.groupBy("key", "skill_no").agg(
        F.min(F.when(F.col("unit_no") > 0, F.col("unit_no"))).alias("own"), F.min("unit_no").alias("first")).filter("first = 0")
    shown = places.withColumn("unit_no", F.coalesce("own", "first")).join(units, ["key", "unit_no"])
    hits = shown.groupBy(F.col("key").alias("_key")).agg(F.array_sort(F.collect_list(F.struct("skill_no", F.col("unit").alias("fragment")))).alias("hits"))
    none = F.array().cast("array<struct<skill_no:int,fragment:string>>")
    return keyed.join(hits, "_key", "left").drop("_key").withColumns(
        {"fragments": split_topics(F.col(text)), "hits": F.coalesce("hits", none)})


def alias_evidence(tagged: DataFrame, taxonomy: Taxonomy = TAXONOMY,
                   confidence: float = fixed.ALIAS_CONFIDENCE) -> DataFrame:
    """One evidence row per chunk and entry named; ``ord`` puts them in reading order."""
    table = taxonomy_table(tagged.sparkSession, taxonomy).select("skill_no", "skill_id", "skill_name", "category")
    found = tagged.select("bt", "kind", "unit", "hours", "source", "chunk_ord", F.explode("hits").alias("_hit")).withColumn(
        "skill_no", F.col("_hit.skill_no")).join(table, "skill_no")
    return found.select(
        "skill_id", "skill_name", "category",
        F.lit(confidence).alias("confidence"), F.lit("alias").alias("match_type"),
        F.col("_hit.fragment").alias("fragment"), "bt", "kind", "unit", "hours", "source",
        F.struct(F.lit(0).alias("phase"), F.col("chunk_ord"), F.col("skill_no").alias("sub")).alias("ord"),
    )


def unmatched_fragments(tagged: DataFrame, min_length: int = 6) -> DataFrame:
    """Fragments of chunks that name no entry, if long enough for the vector search."""
    rest = F.when(F.size("hits") == 0, F.col("fragments"))
    return (
        tagged.select("bt", "kind", "unit", "hours", "source", "chunk_ord",
                      F.posexplode_outer(rest).alias("fragment_no", "fragment"))
        .filter(F.length("fragment") >= min_length)
    )


def semantic_evidence(fragments: DataFrame, vectors: DataFrame, entry_vectors: DataFrame,
                      taxonomy: Taxonomy = TAXONOMY, threshold: float = fixed.SEMANTIC_MIN) -> DataFrame:
    """Evidence for fragments by their nearest entry.

    ``vectors`` holds ``fragment, vector`` (each text once) and ``entry_vectors`` ``entry_id, vector``,
    where ``entry_id`` is the entry's ``skill_no``. Distinct texts are searched once.
    """
    wanted = vectors.join(fragments.select("fragment").distinct(), "fragment", "left_semi")
    numbered = cut_lineage(wanted.withColumn("query_id", F.monotonically_increasing_id()))
    found = best_entry(numbered, entry_vectors, threshold).join(numbered.select("query_id", "fragment"), "query_id")
    table = taxonomy_table(fragments.sparkSession, taxonomy).select("skill_no", "skill_id", "skill_name", "category")
    return (
        fragments.join(found, "fragment").join(table, F.col("entry_id").cast("int") == F.col("skill_no"))
        .select(
            "skill_id", "skill_name", "category",
            F.round("similarity", 4).alias("confidence"), F.lit("semantic").alias("match_type"),
            "fragment", "bt", "kind", "unit", "hours", "source",
            F.struct(F.lit(1).alias("phase"), F.col("chunk_ord"), F.col("fragment_no").alias("sub")).alias("ord"),
        )
    )


def with_depth(evidence: DataFrame) -> DataFrame:
    """Add the ``verb`` and ``depth`` of each evidence row."""
    found = evidence.withColumn("_verb", leading_verb(F.col("fragment")))
    inferred = depth_of_verb(F.col("_verb"), F.col("bt"), F.col("kind"))
    return found.withColumn("_d", inferred).withColumns(
        {"verb": F.col("_d.verb"), "depth": F.col("_d.depth")}).drop("_d", "_verb")
