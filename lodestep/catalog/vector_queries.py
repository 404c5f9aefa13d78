"""Queries that map by vector what no form or alias names, on both sides.

No model runs here, so vectors are derived from the table ``embeddings``: a text has one vector and half of another, both picked by
its digest; entry ``i`` has vector ``i``. Entries beyond the table have none and are never found.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestep.catalog import demand_queries as demand_side
from lodestep.catalog import inputs
from lodestep.catalog import supply_queries as supply_side
from lodestep.catalog.inputs import sql_names, sql_norm
from lodestep.catalog.registry import Tables, query
from lodestep.functions import fixed_values as fixed
from lodestep.functions.taxonomy import TAXONOMY
from lodestep.operators import demand, dictionary
from lodestep.plans import demand_report, supply_report
from lodestep.session import cut_lineage

#: Taxonomy entry ``i`` has the vector of so many times ``i``.
ENTRY_STEP = 5


def text_vectors(tables: Tables, texts: DataFrame, text: str) -> DataFrame:
    """``text, vector`` of each row of ``texts`` (distinct ones)."""
    held = tables.embeddings.count()

    def pick(start: int) -> Column:
        return F.conv(F.substring(F.md5(text), start, 8), 16, 10).cast("long") % held

    parts = [tables.embeddings.select(F.col("vec_id").alias(f"pick_{i}"), F.col("embedding").cast("array<double>").alias(f"part_{i}")) for i in (1, 2)]
    picked = texts.select(text, pick(1).alias("pick_1"), pick(9).alias("pick_2"))
    return picked.join(parts[0], "pick_1").join(parts[1], "pick_2").select(
        text, F.zip_with("part_1", "part_2", lambda x, y: x + 0.5 * y).alias("vector"))


def _sql_vectors(source: str, text: str) -> str:
    picks = [f"CAST('0x' || substr(md5({text}), {start}, 8) AS bigint) % (SELECT count(*) FROM embeddings)" for start in (1, 9)]
    return f"""
SELECT {text}, list_transform(list_zip(CAST(a.embedding AS double[]), CAST(b.embedding AS double[])), lambda p: p[1] + 0.5 * p[2]) AS vector
FROM (SELECT {text}, {picks[0]} AS pick_1, {picks[1]} AS pick_2 FROM {source}) JOIN embeddings a ON a.vec_id = pick_1 JOIN embeddings b ON b.vec_id = pick_2"""


def _sql_nearest(vectors: str, text: str, entries: str, threshold: float, margin: float) -> str:
    return f"""
SELECT {text}, max(entry_id) FILTER (WHERE place = 1) AS entry_id, max(sim) FILTER (WHERE place = 1) AS similarity FROM (
  SELECT {text}, entry_id, sim, row_number() OVER (PARTITION BY {text} ORDER BY sim DESC, entry_id) AS place FROM (
    SELECT {text}, entry_id, round(list_cosine_similarity(v.vector, e.vector), 12) AS sim FROM {vectors} v, {entries} e))
GROUP BY {text} HAVING similarity >= {threshold} AND similarity - coalesce(max(sim) FILTER (WHERE place = 2), -1) >= {margin}"""


def embedded_pairs(tables: Tables) -> DataFrame:
    """Posting-skill pairs against a restricted dictionary, by form, alias and vector."""
    listed = dictionary.listed_entries(demand_side.entries(tables), tables.derived(demand_side._LISTED))
    named = demand_side.filters.named_employers(demand_side.postings(tables))
    raw = demand.listed_skills(named, "skills").select("raw").distinct()
    vectors = tables.embeddings.select(F.col("vec_id").alias("entry_id"), F.col("embedding").alias("vector"))
    return demand_report.posting_skill_table(
        named, listed, dictionary.alias_table(tables.spark), skill_vectors=text_vectors(tables, raw, "raw"),
        entry_vectors=vectors.join(listed.select(F.col("skill_idx").alias("entry_id")), "entry_id", "left_semi"))


_WANTED = inputs.CTE_PAIRS.partition("raws AS")[0]
_SPECIFIC = f"length({sql_norm('raw')}) >= 2 AND {sql_norm('raw')} NOT IN ({sql_names(fixed.VAGUE_SKILLS)})"
_LISTED_DICTIONARY = f"dictionary AS (SELECT * FROM ({inputs.plain(inputs.DICTIONARY)}) WHERE uri IN ({inputs.plain(demand_side._LISTED)}))"
WITH_EMBEDDED = f"""WITH {inputs.CTE_POSTINGS}, {_LISTED_DICTIONARY}, {inputs.CTE_FORMS}, {_WANTED}
raws AS (SELECT posting, employer, title, trim(part) AS raw, pos FROM (SELECT posting, employer, title, unnest(string_split(skills, ',')) AS part,
  unnest(generate_series(1, len(string_split(skills, ',')))) AS pos FROM wanted)),
texts AS (SELECT DISTINCT raw FROM raws WHERE {_SPECIFIC}),
by_form AS MATERIALIZED (SELECT raw, skill_idx FROM texts JOIN forms ON {sql_norm("raw")} = form),
rest AS (SELECT raw FROM texts WHERE raw NOT IN (SELECT raw FROM by_form)),
rest_vectors AS MATERIALIZED ({_sql_vectors("rest", "raw")}),
entry_vectors AS MATERIALIZED (SELECT vec_id AS entry_id, CAST(embedding AS double[]) AS vector FROM embeddings WHERE vec_id IN (SELECT skill_idx FROM dictionary)),
by_vector AS MATERIALIZED ({_sql_nearest("rest_vectors", "raw", "entry_vectors", fixed.NEAREST_LABEL_MIN, fixed.NEAREST_LABEL_MARGIN)}),
mapping AS (SELECT raw, skill_idx, 'exact' AS how FROM by_form UNION ALL SELECT raw, entry_id, 'embed' FROM by_vector),
found AS (SELECT posting, any_value(employer) AS employer, any_value(title) AS title, skill_idx, arg_min(how, pos) AS how
  FROM raws JOIN mapping USING (raw) GROUP BY posting, skill_idx),
pairs AS MATERIALIZED (SELECT * FROM found QUALIFY count(*) OVER (PARTITION BY posting) >= 2)"""


@query("embedded_skill_pairs", f"{WITH_EMBEDDED} SELECT posting, employer, title, skill_idx, how FROM pairs")
def embedded_skill_pairs(tables: Tables) -> DataFrame:
    return embedded_pairs(tables).select("posting", "employer", "title", "skill_idx", "how")


@query("embedded_demand_counts", f"""{WITH_EMBEDDED}, {inputs.CTE_COUNTS}
SELECT skill_idx, employers, postings, round(core_builder_share, 6) AS core_builder_share, round(junior_share, 6) AS junior_share, k FROM verified""")
def embedded_demand_counts(tables: Tables) -> DataFrame:
    """Distinct employers per skill above the threshold, strings mapped by vector included."""
    base = cut_lineage(demand.employer_skill_counts(embedded_pairs(tables)))
    return demand.verified_skills(base).select(
        "skill_idx", "employers", "postings", F.round("core_builder_share", 6).alias("core_builder_share"),
        F.round("junior_share", 6).alias("junior_share"), "k")


_ENTRIES = ", ".join(f"({i}, '{entry.name}', '{entry.category}')" for i, entry in enumerate(TAXONOMY))
_VERBS = sql_names([verb for verbs in fixed.DEPTH_VERBS.values() for verb in verbs])
CTE_SEMANTIC = f"""
pieces_left AS MATERIALIZED (SELECT text_n, raw, fragment_no, fragment FROM (
  SELECT text_n, whole AS raw, unnest(parts) AS fragment, unnest(generate_series(0, len(parts) - 1)) AS fragment_no FROM topics
  WHERE text_n NOT IN (SELECT text_n FROM hits)) WHERE length(fragment) >= 6),
fragments_left AS (SELECT DISTINCT fragment FROM pieces_left),
fragment_vectors AS MATERIALIZED ({_sql_vectors("fragments_left", "fragment")}),
taxonomy AS (SELECT skill_no, 'cs_' || trim(regexp_replace(lower(name), '[^a-z0-9]+', '_', 'g'), '_') AS skill_id, category FROM (VALUES {_ENTRIES}) AS t(skill_no, name, category)),
taxonomy_vectors AS MATERIALIZED (SELECT skill_no AS entry_id, CAST(embedding AS double[]) AS vector FROM embeddings JOIN taxonomy ON vec_id = {ENTRY_STEP} * skill_no),
meant AS MATERIALIZED ({_sql_nearest("fragment_vectors", "fragment", "taxonomy_vectors", fixed.SEMANTIC_MIN, 0)}),
meanings AS MATERIALIZED (SELECT source, chunk_no, tie, bt, kind, fragment_no, fragment, skill_id, category, round(similarity, 4) AS confidence,
  list_filter(flatten(list_transform(regexp_extract_all(lower(fragment), '[a-z]+')[1:3],
    lambda w: [w, w[1:greatest(len(w) - 1, 0)], w[1:greatest(len(w) - 2, 0)], w[1:greatest(len(w) - 3, 0)]])), lambda s: s IN ({_VERBS}))[1] AS own_verb
  FROM meant JOIN pieces_left USING (fragment) JOIN topic_rows USING (raw) JOIN taxonomy ON entry_id = skill_no),
semantic AS (SELECT *, CASE {" ".join(f"WHEN own_verb IN ({sql_names(verbs)}) THEN '{depth}'" for depth, verbs in fixed.DEPTH_VERBS.items())}
  WHEN bt <> '' THEN CASE WHEN CAST(bt[-1] AS int) <= 2 THEN 'know' WHEN CAST(bt[-1] AS int) = 3 THEN 'apply' ELSE 'build' END
  WHEN kind = 'practical' THEN 'apply' ELSE 'know' END AS depth FROM meanings)"""


@query("semantic_evidence", f"""WITH {supply_side.CTE_EVIDENCE}, {CTE_SEMANTIC}
SELECT source, chunk_no, tie, skill_id, category, fragment, 'alias' AS match_type, CAST({fixed.ALIAS_CONFIDENCE} AS double) AS confidence, verb, depth FROM evidence
UNION ALL SELECT source, chunk_no, tie, skill_id, category, fragment, 'semantic', confidence,
  coalesce(own_verb, CASE depth WHEN 'know' THEN 'understand' WHEN 'apply' THEN 'implement' ELSE 'design' END), depth FROM semantic""")
def semantic_evidence(tables: Tables) -> DataFrame:
    """Evidence of the whole taxonomy: by alias, and by vector for the fragments of topics that name no entry."""
    topics = cut_lineage(supply_side.topics(tables))
    fragments = topics.select("raw").distinct().select(F.explode(supply_side.split_topics(F.col("raw"))).alias("fragment")).distinct()
    entries = tables.embeddings.where((F.col("vec_id") % ENTRY_STEP == 0) & (F.col("vec_id") < ENTRY_STEP * len(TAXONOMY))).select(
        (F.col("vec_id") / ENTRY_STEP).cast("long").alias("entry_id"), F.col("embedding").alias("vector"))
    found = supply_report.topic_evidence(topics, text_vectors(tables, fragments, "fragment"), entries)
    return found.select("source", F.col("ord.chunk_ord.chunk_no").alias("chunk_no"), F.col("ord.chunk_ord.tie").alias("tie"),
                        "skill_id", "category", "fragment", "match_type", F.col("confidence").cast("double").alias("confidence"), "verb", "depth")
