"""Queries of the teaching side."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestep.catalog import inputs
from lodestep.catalog.inputs import sql_names, sql_strip
from lodestep.catalog.registry import Tables, query
from lodestep.functions import fixed_values as fixed
from lodestep.functions.depth import inferred_depth
from lodestep.functions.syllabus import split_topics
from lodestep.functions.taxonomy import RAW_MARK, TAXONOMY, Entry, kept_entries
from lodestep.operators import chunks, rollup, tagging
from lodestep.plans import supply_report as plan
from lodestep.session import stored

# Marks that occur in the conversations.
ON, OFF = ["the ", "eau"], ["of", "que "]
UNIT = r"^(?:is|la|der)\s+([a-z]+)"
SKIP = r"^(and |by |die )"


def pages(tables: Tables) -> DataFrame:
    """Conversations as documents: a conversation is a document, a turn a page."""
    return tables.conversations.select(
        F.concat(F.lit("s"), F.col("conv_id")).alias("doc"), F.col("turn").cast("int").alias("page_no"), "text")


def lines(tables: Tables) -> DataFrame:
    return chunks.line_chunks(pages(tables), ON, OFF, UNIT, SKIP)


def table_rows(tables: Tables) -> DataFrame:
    return tables.derived(inputs.TABLE_ROWS)


_CONTAINS_ON = " OR ".join(f"contains(line, '{mark}')" for mark in ON)
_CONTAINS_OFF = " OR ".join(f"contains(line, '{mark}')" for mark in OFF)
CTE_LINES = f"""
raw_lines AS (SELECT 's' || CAST(conv_id AS varchar) AS doc, CAST(turn AS int) AS page_no,
    unnest(generate_series(0, len(string_split(text, chr(10))) - 1)) AS row_no, unnest(string_split(text, chr(10))) AS whole
  FROM conversations),
marked AS (SELECT doc, page_no, CAST(row_no AS int) AS row_no, {sql_strip("whole")} AS line FROM raw_lines),
states AS (SELECT *, CASE WHEN {_CONTAINS_ON} THEN true WHEN {_CONTAINS_OFF} THEN false END AS mark,
  CASE WHEN NOT ({_CONTAINS_ON} OR {_CONTAINS_OFF}) AND regexp_matches(line, '(?i){UNIT}')
    THEN regexp_extract(line, '(?i){UNIT}', 1) END AS own_unit FROM marked),
ruled AS (SELECT *, last_value(mark IGNORE NULLS) OVER w AS inside, last_value(own_unit IGNORE NULLS) OVER w AS unit FROM states
  WINDOW w AS (PARTITION BY doc ORDER BY page_no, row_no ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
bodies AS (SELECT *, {sql_strip("regexp_replace(regexp_replace(regexp_replace(line, '^[0-9]+\\s+[0-9]+\\s+', ''), 'CO[0-9]+\\s*-\\s*BT[1-6].*$', ''), '\\b[TR]-[A-Za-z0-9\\s:,]+', '', 'g')")} AS raw
  FROM ruled WHERE inside AND mark IS NULL AND length(line) >= 5 AND NOT regexp_matches(line, '(?i){SKIP}')),
line_chunks AS (SELECT doc, page_no, row_no, raw, regexp_extract(line, 'CO[0-9]+\\s*-\\s*BT[1-6]', 0) AS bt, unit,
  try_cast(regexp_extract(line, '(?i)([0-9]+)\\s*(?:hrs?|hours?)\\b', 1) AS int) AS hours FROM bodies WHERE raw <> '')"""


@query("section_lines", f"WITH {CTE_LINES} SELECT doc, page_no, row_no, raw, bt, unit, hours FROM line_chunks")
def section_lines(tables: Tables) -> DataFrame:
    return lines(tables).select("doc", "page_no", "row_no", "raw", "bt", "unit", "hours")


CTE_TABLES = f"""
table_rows AS ({inputs.plain(inputs._TABLE_ROWS)}),
clean AS (SELECT doc, page_no, table_no, row_no,
  list_transform(cells, lambda c: trim(regexp_replace(coalesce(c, ''), '\\s+', ' ', 'g'))) AS cells FROM table_rows),
roles AS (SELECT *, list_transform(cells, lambda c: regexp_matches(c, '(?i){fixed.HEADER_TOPIC}')) AS topics,
  list_transform(cells, lambda c: CASE WHEN starts_with(lower(c), 'unit') THEN 'unit' WHEN contains(lower(c), 'bt') AND contains(lower(c), 'co') THEN 'bt'
    WHEN regexp_matches(lower(c), '{fixed.HEADER_HOURS}') THEN 'hours' ELSE '' END) AS roles FROM clean),
headed AS (SELECT *, CASE WHEN list_contains(topics, true) THEN {{
    'topic': list_position(topics, true), 'ncols': len(cells),
    'kind': CASE WHEN contains(lower(cells[list_position(topics, true)]), 'experiment') THEN 'practical' ELSE 'theory' END,
    'unit': nullif(list_position(roles, 'unit'), 0),
    'bt': CASE WHEN list_contains(roles, 'bt') THEN len(cells) + 1 - list_position(list_reverse(roles), 'bt') END,
    'hours': CASE WHEN list_contains(roles, 'hours') THEN len(cells) + 1 - list_position(list_reverse(roles), 'hours') END}} END AS own FROM roles),
carried AS (SELECT *, last_value(own IGNORE NULLS) OVER (PARTITION BY doc ORDER BY page_no, table_no, row_no
  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS h FROM headed),
table_chunks AS (SELECT doc, page_no, table_no, row_no, cells[h.topic] AS raw,
  CASE WHEN h.bt IS NULL THEN '' ELSE cells[h.bt] END AS bt, CASE WHEN h.unit IS NOT NULL THEN nullif(cells[h.unit], '') END AS unit,
  coalesce(CASE WHEN h.hours IS NOT NULL THEN nullif(try_cast(regexp_extract(cells[h.hours], '[0-9]+') AS int), 0) END,
    CASE WHEN h.kind = 'practical' THEN 2 ELSE 1 END) AS hours, h.kind AS kind
  FROM carried WHERE own IS NULL AND len(cells) = h.ncols AND length(cells[h.topic]) >= 3)"""


@query("table_topics", f"WITH {CTE_TABLES} SELECT * FROM table_chunks")
def table_topics(tables: Tables) -> DataFrame:
    return chunks.table_chunks(table_rows(tables)).withColumnRenamed("part_no", "table_no")


#: Table topics that make a document's tables enough; about half of the documents have as many.
ENOUGH = 235
CTE_CHOICE = f"""
t AS (SELECT doc, count(*) AS n FROM table_chunks GROUP BY doc), l AS (SELECT doc, count(*) AS n FROM line_chunks GROUP BY doc),
docs AS (SELECT DISTINCT doc FROM (SELECT doc FROM marked UNION ALL SELECT doc FROM table_rows))"""


def _cascaded(tables: Tables, external: DataFrame | None = None) -> DataFrame:
    rows = table_rows(tables)
    docs = pages(tables).select("doc").unionByName(rows.select("doc")).distinct()
    chosen = chunks.cascaded_chunks(docs, stored(chunks.table_chunks(rows), "tables", "zstd"), stored(lines(tables), "lines", "zstd"), external, ENOUGH)
    return chosen.select("doc", "origin", "page_no", "row_no", "raw")


@query("chunk_cascade", f"""
WITH {CTE_LINES}, {CTE_TABLES}, {CTE_CHOICE},
choice AS (SELECT docs.doc, CASE WHEN t.n >= {ENOUGH} THEN 'table' ELSE 'line' END AS origin FROM docs LEFT JOIN t ON t.doc = docs.doc)
SELECT c.doc, origin, page_no, row_no, raw FROM choice c JOIN table_chunks f ON c.doc = f.doc WHERE origin = 'table'
UNION ALL SELECT c.doc, origin, page_no, row_no, raw FROM choice c JOIN line_chunks f ON c.doc = f.doc WHERE origin = 'line'""")
def chunk_cascade(tables: Tables) -> DataFrame:
    return _cascaded(tables)


@query("chunk_cascade_external", f"""
WITH {CTE_LINES}, {CTE_TABLES}, {CTE_CHOICE},
topics AS ({inputs.plain(inputs.TOPICS)}),
e AS (SELECT source AS doc, 1 AS page_no, CAST(chunk_no AS int) AS row_no, raw FROM topics),
choice AS (SELECT docs.doc, CASE WHEN t.n >= {ENOUGH} THEN 'table' WHEN l.n >= {ENOUGH} THEN 'line'
  WHEN docs.doc IN (SELECT doc FROM e) THEN 'external' ELSE 'line' END AS origin
  FROM docs LEFT JOIN t ON t.doc = docs.doc LEFT JOIN l ON l.doc = docs.doc)
SELECT c.doc, origin, page_no, row_no, raw FROM choice c JOIN table_chunks f ON c.doc = f.doc WHERE origin = 'table'
UNION ALL SELECT c.doc, origin, page_no, row_no, raw FROM choice c JOIN line_chunks f ON c.doc = f.doc WHERE origin = 'line'
UNION ALL SELECT c.doc, origin, page_no, row_no, raw FROM choice c JOIN e ON c.doc = e.doc WHERE origin = 'external'""")
def chunk_cascade_external(tables: Tables) -> DataFrame:
    """The cascade with the topics of another extraction where tables and lines are too few."""
    external = tables.derived(inputs.TOPICS).select(
        F.col("source").alias("doc"), F.lit(1).alias("page_no"), F.lit(0).alias("part_no"), F.col("chunk_no").cast("int").alias("row_no"),
        "raw", "bt", "unit", F.col("hours").cast("int").alias("hours"), F.lit("theory").alias("kind"))
    return _cascaded(tables, external)


@query("document_lengths", f"""
SELECT 's' || CAST(conv_id AS varchar) AS doc, count(*) AS n_pages, CAST(sum(length({sql_strip("text")})) AS bigint) AS text_length,
  sum(length({sql_strip("text")})) < 200 AS unreadable FROM conversations GROUP BY conv_id""")
def document_lengths(tables: Tables) -> DataFrame:
    return chunks.document_lengths(pages(tables))


_BANNED = " OR ".join(f"contains(lower(name), '{word}')" for word in fixed.BANNED_COURSE_WORDS)


@query("course_vetting", f"""
WITH courses AS ({inputs.plain(inputs.COURSES)}),
parsed AS (SELECT doc, text, coalesce(nullif(regexp_extract(doc, '{fixed.COURSE_CODE}', 1), ''), nullif(regexp_extract(text, '{fixed.COURSE_CODE}', 1), '')) AS prefix,
  trim(regexp_replace(regexp_extract(text, '(?is){fixed.COURSE_NAME}', 1), '\\s+', ' ', 'g')) AS name FROM courses),
judged AS (SELECT doc, CASE WHEN {sql_strip("text")} = '' THEN 'Empty PDF'
  WHEN contains(text, 'Mandatory Non-Graded') OR contains(text, '(MNG)') THEN 'Mandatory Non-Graded (MNG)'
  WHEN prefix NOT IN ({sql_names(fixed.COURSE_PREFIXES)}) THEN 'Non-coding subject prefix ''' || prefix || ''''
  WHEN {_BANNED} THEN 'Non-core course title: ''' || name || '''' ELSE 'Core course: ''' || name || '''' END AS reason FROM parsed)
SELECT doc, starts_with(reason, 'Core') AS ok, reason FROM judged""")
def course_vetting(tables: Tables) -> DataFrame:
    return chunks.vetted_courses(tables.derived(inputs.COURSES))


def _cte_parts(source: str, key: str, text: str) -> str:
    """SQL of topic splitting; bracket depth never falls below zero."""
    cleaned = f"trim(regexp_replace({sql_strip('part')}, '(?i)^(unit\\s*[-:]?\\s*[\\p{{L}}\\p{{N}}_]+|experiment\\s*[0-9]*)\\s*[:\\-]?\\s*', ''), ' -:,.' || chr(9))"
    return f"""
pieces AS (SELECT {key}, {text} AS whole, unnest(found) AS piece, unnest(generate_series(1, len(found))) AS n FROM (
  SELECT {key}, {text}, regexp_extract_all({text}, '[(\\[]|[)\\]]|[^()\\[\\]]+') AS found FROM {source})),
sums AS (SELECT *, sum(CASE WHEN piece IN ('(', '[') THEN 1 WHEN piece IN (')', ']') THEN -1 ELSE 0 END) OVER (PARTITION BY {key} ORDER BY n) AS s FROM pieces),
depths AS (SELECT *, s - least(0, min(s) OVER (PARTITION BY {key} ORDER BY n)) AS depth FROM sums),
joined AS (SELECT {key}, any_value(whole) AS whole, string_agg(CASE WHEN depth = 0 AND piece NOT IN (')', ']')
  THEN regexp_replace(piece, '[,;•]', chr(31), 'g') ELSE piece END, '' ORDER BY n) AS marked FROM depths GROUP BY {key}),
cut AS (SELECT {key}, whole, string_split(marked, chr(31)) AS parts FROM joined),
cleaned AS (SELECT {key}, whole, list_filter(list_transform(parts, lambda part: {cleaned}), lambda p: length(p) >= 3) AS parts FROM cut),
topics AS (SELECT {key}, whole, CASE WHEN len(parts) > 0 THEN parts ELSE [whole] END AS parts FROM cleaned)"""


@query("split_topics", f"""
WITH {_cte_parts("documents", "doc_id", "text")}
SELECT doc_id, CAST(unnest(generate_series(0, len(parts) - 1)) AS int) AS part_no, unnest(parts) AS part FROM topics""")
def split_topics_query(tables: Tables) -> DataFrame:
    return tables.spread(tables.documents).select("doc_id", F.posexplode(split_topics(F.col("text"))).alias("part_no", "part"))


# Words that occur in the documents.
WORDS = [
    Entry("en", "English article", "", ["the", "an"]), Entry("en", "English phrase", "", ["of the", "in the", "and the"]),
    Entry("fr", "French article", "", ["le", "la", "un"]), Entry("fr", "French link", "", ["que", "qui", "ou"]),
    Entry("de", "German article", "", ["der", "die", "das", "ein"]), Entry("de", "German link", "", ["von", "und"]),
    Entry("es", "Spanish article", "", ["el", "los"]), Entry("es", "Spanish link", "", ["por", "con", "de la"]),
    Entry("x", "Not kept", "", ["is"]),
]


_EDGE = "[^\\p{L}\\p{N}_+#]"

# Per pattern alias: what to hide in a text first, as DuckDB's patterns have no look-around, and what must then be found.
_RULES = {
    r"re:(?<!data )(?<!information )(?<!file )(?<!database )structures?": ("((?:data|information|file|database) )structure", "\\1~", "structures?"),
    r"re:(?<!full )(?<!tech )stacks?": ("((?:full|tech) )stack", "\\1~", "stacks?"),
    r"re:(?<!memory )heaps?(?! memory)": ("(memory )heap|heaps?( memory)", "\\1~\\2", "heaps?"),
    r"re:(?<!decision )(?<!family )(?<!syntax )trees?": ("((?:decision|family|syntax) )tree", "\\1~", "trees?"),
    r"re:graphs?": ("~", "~", "graphs?"),
    r"re:binary search(?! trees?)": ("binary search( tree)", "~\\1", "binary search"),
}


def _sql_holds(text: str, entry: Entry) -> str:
    """SQL condition that ``text`` names the entry."""
    words = "|".join("".join("\\" + c if c in "+.*/" else c for c in alias) + "(?:e?s)?"
                     for alias in entry.aliases if not alias.startswith(RAW_MARK))
    tests = [f"regexp_matches({text}, '(?i)(?:^|{_EDGE})(?:{words})(?:$|{_EDGE})')".replace("prim's", "prim''s")] if words else []
    for alias in entry.aliases:
        if alias in _RULES:
            hidden, mark, found = _RULES[alias]
            tests.append(f"regexp_matches(regexp_replace(lower({text}), '{hidden}', '{mark}', 'g'), '(?:^|{_EDGE})(?:{found})(?:$|{_EDGE})')")
    return "(" + " OR ".join(tests) + ")"


def _sql_hits(taxonomy: list[Entry], columns: str) -> str:
    return " UNION ALL ".join(
        f"SELECT {columns}, {i} AS skill_no, 'cs_' || trim(regexp_replace(lower('{e.name}'), '[^a-z0-9]+', '_', 'g'), '_') AS skill_id, '{e.category}' AS category, "
        f"coalesce(list_filter(parts, lambda p: {_sql_holds('p', e)})[1], whole) AS fragment "
        f"FROM topics WHERE {_sql_holds('whole', e)}" for i, e in enumerate(taxonomy))


KEPT_WORDS = kept_entries(WORDS, ["en", "fr", "de", "es"])


@query("tagged_documents", f"""
WITH {_cte_parts("documents", "doc_id", "text")}
SELECT doc_id, skill_id, category, fragment FROM ({_sql_hits(KEPT_WORDS, "doc_id")})""")
def tagged_documents(tables: Tables) -> DataFrame:
    bodies = tables.spread(tables.documents).select("doc_id", F.col("text").alias("raw"), F.col("doc_id").alias("chunk_ord"),
                                     F.lit("").alias("bt"), F.lit("theory").alias("kind"),
                                     F.lit(None).cast("string").alias("unit"), F.lit(None).cast("int").alias("hours"), "source")
    evidence = tagging.alias_evidence(tagging.tagged_chunks(bodies, KEPT_WORDS), KEPT_WORDS)
    return evidence.select(F.col("ord.chunk_ord").alias("doc_id"), "skill_id", "category", "fragment")


@query("untagged_fragments", f"""
WITH {_cte_parts("documents", "doc_id", "text")}, hits AS ({_sql_hits(KEPT_WORDS, "doc_id")})
SELECT doc_id, fragment FROM (SELECT doc_id, unnest(parts) AS fragment FROM topics WHERE doc_id NOT IN (SELECT doc_id FROM hits))
WHERE length(fragment) >= 6""")
def untagged_fragments(tables: Tables) -> DataFrame:
    bodies = tables.spread(tables.documents).select(F.col("text").alias("raw"), F.col("doc_id").alias("chunk_ord"),
                                     F.lit("").alias("bt"), F.lit("theory").alias("kind"),
                                     F.lit(None).cast("string").alias("unit"), F.lit(None).cast("int").alias("hours"), "source")
    rest = tagging.unmatched_fragments(tagging.tagged_chunks(bodies, KEPT_WORDS))
    return rest.select(F.col("chunk_ord").alias("doc_id"), "fragment")


def topics(tables: Tables) -> DataFrame:
    rows = tables.derived(inputs.TOPICS)
    return rows.withColumn("chunk_ord", F.struct("source", "chunk_no", "tie")).drop("chunk_no", "tie")


CTE_EVIDENCE = f"""
topic_rows AS MATERIALIZED (SELECT *, row_number() OVER (ORDER BY source, chunk_no, tie) AS n FROM ({inputs.plain(inputs.TOPICS)})),
texts AS MATERIALIZED (SELECT raw, row_number() OVER (ORDER BY raw) AS text_n FROM (SELECT DISTINCT raw FROM topic_rows)),
{_cte_parts("texts", "text_n", "raw").replace("topics AS (", "topics AS MATERIALIZED (")},
hits AS MATERIALIZED ({_sql_hits(TAXONOMY, "text_n")}),
located AS MATERIALIZED (SELECT hits.*, source, chunk_no, tie, bt, unit, hours, kind, n, n AS row_n FROM hits JOIN texts USING (text_n) JOIN topic_rows USING (raw)),
stems AS MATERIALIZED (SELECT row_n, skill_no, list_filter(flatten(list_transform(regexp_extract_all(lower(fragment), '[a-z]+')[1:3],
  lambda w: [w, w[1:greatest(len(w) - 1, 0)], w[1:greatest(len(w) - 2, 0)], w[1:greatest(len(w) - 3, 0)]])),
  lambda s: s IN ({sql_names([v for verbs in fixed.DEPTH_VERBS.values() for v in verbs])}))[1] AS verb FROM located),
judged AS (SELECT located.*, stems.verb AS own_verb, CASE
    {" ".join(f"WHEN stems.verb IN ({sql_names(verbs)}) THEN '{depth}'" for depth, verbs in fixed.DEPTH_VERBS.items())}
    WHEN bt <> '' THEN CASE WHEN CAST(bt[-1] AS int) <= 2 THEN 'know' WHEN CAST(bt[-1] AS int) = 3 THEN 'apply' ELSE 'build' END
    WHEN kind = 'practical' THEN 'apply' ELSE 'know' END AS depth FROM located JOIN stems USING (row_n, skill_no)),
evidence AS MATERIALIZED (SELECT *, coalesce(own_verb, CASE depth WHEN 'know' THEN 'understand' WHEN 'apply' THEN 'implement' ELSE 'design' END) AS verb,
  n * 100 + skill_no AS ord, CASE depth WHEN 'know' THEN 0 WHEN 'apply' THEN 1 ELSE 2 END AS rank FROM judged)"""


@query("topic_evidence", f"""WITH {CTE_EVIDENCE}
SELECT source, chunk_no, tie, skill_id, category, fragment, verb, depth FROM evidence""")
def topic_evidence(tables: Tables) -> DataFrame:
    evidence = plan.topic_evidence(topics(tables))
    return evidence.select("source", F.col("ord.chunk_ord.chunk_no").alias("chunk_no"),
                           F.col("ord.chunk_ord.tie").alias("tie"), "skill_id", "category", "fragment", "verb", "depth")


@query("depth_inference", f"""
WITH rows AS (SELECT conv_id, turn, text, CASE turn % 3 WHEN 0 THEN '' ELSE 'CO' || CAST(turn AS varchar) || ' - bt ' || CAST(conv_id % 6 + 1 AS varchar) || ', BT2' END AS bt,
  {" ".join(["CASE role"] + [f"WHEN '{role}' THEN '{verb} '" for role, verb in (("user", "Implementing"), ("system", "On the Planning of"))] + ["ELSE '' END"])} || text AS fragment, role FROM conversations),
stems AS (SELECT *, list_filter(flatten(list_transform(regexp_extract_all(lower(fragment), '[a-z]+')[1:3],
  lambda w: [w, w[1:greatest(len(w) - 1, 0)], w[1:greatest(len(w) - 2, 0)], w[1:greatest(len(w) - 3, 0)]])),
  lambda s: s IN ({sql_names([v for verbs in fixed.DEPTH_VERBS.values() for v in verbs])}))[1] AS own FROM rows),
depths AS (SELECT *, CASE {" ".join(f"WHEN own IN ({sql_names(verbs)}) THEN '{depth}'" for depth, verbs in fixed.DEPTH_VERBS.items())}
  WHEN bt <> '' THEN CASE WHEN conv_id % 6 + 1 <= 2 THEN 'know' WHEN conv_id % 6 + 1 = 3 THEN 'apply' ELSE 'build' END
  WHEN role = 'assistant' THEN 'apply' ELSE 'know' END AS depth FROM stems)
SELECT conv_id, turn, coalesce(own, CASE depth WHEN 'know' THEN 'understand' WHEN 'apply' THEN 'implement' ELSE 'design' END) AS verb, depth FROM depths""")
def depth_inference(tables: Tables) -> DataFrame:
    turn, conv = F.col("turn"), F.col("conv_id")
    level = F.when(turn % 3 == 0, "").otherwise(F.concat(F.lit("CO"), turn, F.lit(" - bt "), conv % 6 + 1, F.lit(", BT2")))
    opening = F.when(F.col("role") == "user", "Implementing ").when(F.col("role") == "system", "On the Planning of ").otherwise("")
    kind = F.when(F.col("role") == "assistant", "practical").otherwise("theory")
    found = inferred_depth(F.concat(opening, F.col("text")), level, kind)
    return tables.conversations.select("conv_id", "turn", found.alias("d")).select("conv_id", "turn", "d.verb", "d.depth")


CTE_ROLLUP = f"""
{CTE_EVIDENCE},
fragments AS (SELECT skill_id, string_agg(fragment, ' / ' ORDER BY ord) AS evidence FROM (
  SELECT skill_id, fragment, min(ord) AS ord FROM evidence GROUP BY skill_id, fragment QUALIFY row_number() OVER (PARTITION BY skill_id ORDER BY min(ord)) <= 5) GROUP BY skill_id),
listed AS (SELECT skill_id, count(*) AS n_sources, string_agg(source, ',' ORDER BY ord) AS sources FROM (
  SELECT skill_id, source, min(ord) AS ord FROM evidence GROUP BY skill_id, source) GROUP BY skill_id),
summary AS (SELECT skill_id, any_value(category) AS category, CASE max(rank) WHEN 0 THEN 'know' WHEN 1 THEN 'apply' ELSE 'build' END AS depth,
  arg_min(fragment, ord) AS original_topic, arg_min(verb, ord) AS verb, arg_min({{'u': unit}}, ord).u AS unit, arg_min(source, ord) AS source,
  CAST(coalesce(sum(nullif(hours, 0)), arg_min({{'h': hours}}, ord).h) AS int) AS hours FROM evidence GROUP BY skill_id)"""


@query("syllabus_rollup", f"""WITH {CTE_ROLLUP}
SELECT s.*, n_sources, sources, evidence FROM summary s JOIN listed USING (skill_id) JOIN fragments USING (skill_id)""")
def syllabus_rollup(tables: Tables) -> DataFrame:
    evidence = stored(plan.topic_evidence(topics(tables)), "evidence", "zstd")
    records = rollup.supply_records(evidence)
    return records.select(
        "skill_id", "category", "depth", "original_topic", "verb", "unit", "hours", "source", "n_sources",
        F.array_join("sources", ",").alias("sources"), F.array_join("evidence", " / ").alias("evidence"))


@query("category_counts", f"WITH {CTE_EVIDENCE} SELECT category, count(DISTINCT skill_id) AS n_skills FROM evidence GROUP BY category")
def category_counts(tables: Tables) -> DataFrame:
    return rollup.category_counts(rollup.skill_summary(plan.topic_evidence(topics(tables))))


@query("supply_report")
def supply_report(tables: Tables) -> DataFrame:
    """The whole teaching side with the full taxonomy, on lesson tables made of the topic rows and the conversations as further pages."""
    rows = tables.derived(inputs.TOPICS)
    lessons = rows.select(
        F.concat("source", F.lit(".pdf")).alias("doc"), F.lit(1).alias("page_no"),
        F.col("chunk_no").cast("int").alias("table_no"), F.col("tie").cast("int").alias("row_no"),
        F.array("unit", "raw", "bt", F.col("hours").cast("string")).alias("cells"))
    heads = rows.select("source").distinct().select(
        F.concat("source", F.lit(".pdf")).alias("doc"), F.lit(1).alias("page_no"), F.lit(-1).alias("table_no"),
        F.lit(0).alias("row_no"), F.array(*map(F.lit, ["Unit", "Topics", "CO-BT", "Hours"])).alias("cells"))
    # A title page for every document, then a conversation's turns as its lecture plan; what has no table gives its lines.
    turns = pages(tables).select(F.concat("doc", F.lit(".pdf")).alias("doc"), (F.col("page_no") + 2).alias("page_no"),
                                 F.concat(F.lit(fixed.SECTION_ON[0] + "\n"), "text").alias("text"))
    titles = heads.select("doc").union(turns.select("doc")).distinct().select(
        "doc", F.lit(1).alias("page_no"), F.lit("Course Name Programming Course Code 23CSH-101").alias("text"))
    return plan.supply_report(titles.unionByName(turns), heads.unionByName(lessons), tables.derived(inputs.DICTIONARY))
