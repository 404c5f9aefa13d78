"""Domain inputs derived from the tables, in SQL that both engines read.

Orders become postings, parts the skill dictionary, line items lesson tables and topics. Every row
of the tables counts and texts stay whole.
"""

from __future__ import annotations

from lodestep.functions import fixed_values as fixed

SKILL = """CASE p_size WHEN 1 THEN 'R' WHEN 2 THEN 'Data' WHEN 3 THEN 'ML' WHEN 4 THEN 'js' WHEN 5 THEN 'K8s'
    WHEN 6 THEN 'Data  Structures' WHEN 7 THEN 'PYTHON' ELSE p_name || ' ' || p_brand END"""

_POSTINGS = f"""
SELECT o_orderkey AS posting,
  CASE c_mktsegment
    WHEN 'AUTOMOBILE' THEN c_name || ' Pvt. Ltd.'
    WHEN 'BUILDING' THEN upper(c_name) || ' & Sons  LLC'
    WHEN 'FURNITURE' THEN CASE WHEN c_nationkey < 3 THEN 'Confidential' WHEN c_nationkey < 5 THEN 'Pvt Ltd'
                          ELSE c_name || ' (India) Private Limited' END
    WHEN 'MACHINERY' THEN CASE WHEN c_nationkey < 3 THEN 'Leading client of ' || c_name WHEN c_nationkey = 3 THEN '  '
                          ELSE c_name END
    ELSE c_name || ' Inc.' END AS employer,
  CASE o_orderpriority WHEN '1-URGENT' THEN 'Senior ' WHEN '2-HIGH' THEN 'Junior ' WHEN '3-MEDIUM' THEN 'Graduate '
    ELSE '' END ||
  CASE o_orderstatus WHEN 'F' THEN 'Software Engineer' WHEN 'O' THEN 'Python Developer'
    ELSE CASE c_mktsegment WHEN 'BUILDING' THEN 'HR Software Executive' WHEN 'MACHINERY' THEN 'Maintenance Technician'
         ELSE 'Data Analyst' END END AS title,
  coalesce(skills, '') AS skills,
  'Join the ' || lower(c_mktsegment) || ' team; priority ' || o_orderpriority || '.' AS description,
  CASE WHEN c_acctbal < 0 THEN '3 yrs' WHEN c_acctbal < 2000 THEN NULL
    ELSE CAST(floor(c_acctbal / 4000) AS varchar(9)) END AS exp_min_text,
  CASE o_orderpriority WHEN '1-URGENT' THEN '0 - 2 years' WHEN '2-HIGH' THEN 'Fresher' WHEN '3-MEDIUM' THEN 'Entry-level'
    WHEN '4-NOT SPECIFIED' THEN '5 to 8 years' ELSE 'mid senior' END AS exp_text,
  o_orderdate AS posted_at
FROM {{orders}}
JOIN {{customer}} ON o_custkey = c_custkey
LEFT JOIN (SELECT l_orderkey, @LIST(skill)@ AS skills
           FROM (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, {SKILL} AS skill
                 FROM {{lineitem}} JOIN {{part}} ON l_partkey = p_partkey) AS items
           GROUP BY l_orderkey) AS lists ON o_orderkey = l_orderkey
"""

DICTIONARY = """
SELECT p_partkey AS skill_idx, 'http://example.org/skill/' || CAST(p_partkey AS varchar(20)) AS uri,
  CASE p_size WHEN 3 THEN 'machine learning' WHEN 4 THEN 'JavaScript' WHEN 6 THEN 'algorithms'
    WHEN 7 THEN 'Python (computer programming)' ELSE p_name || ' ' || p_brand || ' (' || lower(p_type) || ')' END AS label,
  CASE WHEN p_size % 3 = 0 THEN NULL ELSE p_name || ' ' || p_type || chr(10) || p_brand || ' ' || p_name END AS alt_labels
FROM {part}
"""

# Lesson tables: some line items are header rows, some are too narrow.
_TABLE_ROWS = """
SELECT 's' || CAST(l_suppkey AS varchar(20)) AS doc, CAST(l_orderkey AS int) AS page_no, l_linenumber AS table_no,
  CAST(l_partkey AS int) AS row_no,
  CASE WHEN l_returnflag = 'R' AND l_quantity > 40 THEN @ARRAY@('Unit', 'Topics', 'CO-BT', 'Contact Hours', 'Hours')
    WHEN l_returnflag = 'A' AND l_quantity > 45 THEN @ARRAY@('Sr', 'Experiment  Name', 'l')
    WHEN l_quantity < 3 THEN @ARRAY@('x', 'y')
    WHEN l_linenumber <= 3 THEN @ARRAY@(CAST(l_linenumber AS varchar(9)), ' ' || p_name || chr(10) || lower(p_type), CAST(l_quantity % 5 AS varchar(9)) || ' hrs')
    ELSE @ARRAY@(CASE WHEN l_tax < 0.04 THEN '' ELSE 'U' || CAST(l_linenumber AS varchar(9)) END,
                 CASE WHEN l_discount < 0.02 THEN 'ab' ELSE p_name END,
                 'CO1 - BT' || CAST(l_linenumber % 6 + 1 AS varchar(9)), NULL, CAST(CAST(l_quantity AS int) % 4 AS varchar(9)))
  END AS cells
FROM {lineitem} JOIN {part} ON l_partkey = p_partkey
"""

# Topic rows with course vocabulary.
TOPICS = """
SELECT 's' || CAST(l_suppkey AS varchar(20)) AS source, l_orderkey * 10 + l_linenumber AS chunk_no, l_partkey AS tie,
  CASE p_size % 12
    WHEN 0 THEN 'Implement inheritance, virtual functions (overloading, overriding); templates'
    WHEN 1 THEN 'Designing SQL queries; joins [inner, outer], normal forms'
    WHEN 2 THEN 'Introduction to DBMS, relational algebra'
    WHEN 3 THEN 'Git basics; GitHub, version control'
    WHEN 4 THEN 'Unit 2: shell scripting and bash'
    WHEN 5 THEN 'Write stored procedures, triggers; MongoDB'
    WHEN 6 THEN 'Objects, classes and constructors'
    WHEN 7 THEN 'Experiment 3: Develop an ER diagram; BCNF'
    WHEN 8 THEN 'Transactions, serializability'
    WHEN 9 THEN 'Stacks [full stack, tech stacks]; data structures, file structure'
    WHEN 10 THEN 'Binary search tree; binary search, decision trees, heap memory'
    ELSE 'Study of ' || p_name END || ', ' || p_name || ' ' || lower(p_type) AS raw,
  CASE WHEN l_tax < 0.03 THEN '' ELSE 'CO1-BT' || CAST(l_linenumber % 6 + 1 AS varchar(9)) END AS bt,
  CASE WHEN l_discount < 0.03 THEN NULL ELSE 'U' || CAST(l_linenumber AS varchar(9)) END AS unit,
  CASE WHEN l_quantity < 10 THEN NULL ELSE CAST(l_quantity AS int) % 4 END AS hours,
  CASE WHEN l_linestatus = 'F' THEN 'practical' ELSE 'theory' END AS kind
FROM {lineitem} JOIN {part} ON l_partkey = p_partkey
"""

COURSES = """
SELECT CASE WHEN p_size % 5 = 0 THEN 'notes-' ELSE '23' || CASE p_type WHEN 'ECONOMY' THEN 'CSH' WHEN 'LARGE' THEN 'CST'
    WHEN 'MEDIUM' THEN 'MEP' WHEN 'PROMO' THEN 'ECT' ELSE 'CSP' END || '-' END ||
    lpad(CAST(p_partkey % 1000 AS varchar(9)), 3, '0') || '.' || CAST(p_partkey AS varchar(20)) || '.pdf' AS doc,
  1 AS page_no,
  CASE WHEN p_size < 3 THEN ' ' || chr(10) WHEN p_size < 5 THEN 'Syllabus (MNG) ' || p_name
    ELSE 'University' || chr(10) || 'course name | ' || CASE WHEN p_size < 10 THEN 'Professional  Ethics' WHEN p_size < 15
      THEN 'Engineering' || chr(10) || 'Drawing' ELSE 'Programming with ' || p_name END ||
      ' Course Code 23' || CASE WHEN p_size > 40 THEN 'MEP' ELSE 'CSH' END || '-101' END AS text
FROM {part}
"""

# Usage of skills by year, from the line items of each year's orders.
SERIES = """
SELECT p_brand AS skill_id, year(o_orderdate) AS year, CAST(count(*) AS double) / max(total) AS usage
FROM {lineitem} JOIN {part} ON l_partkey = p_partkey JOIN {orders} ON l_orderkey = o_orderkey
JOIN (SELECT year(o_orderdate) AS y, count(*) AS total FROM {orders} GROUP BY year(o_orderdate)) AS totals
  ON year(o_orderdate) = y
GROUP BY p_brand, year(o_orderdate)
"""

_SPARK = {"@LIST(skill)@": "listagg(skill, ', ') WITHIN GROUP (ORDER BY l_linenumber, l_partkey, l_suppkey)",
          "@ARRAY@": "array"}
_DUCK = {"@LIST(skill)@": "string_agg(skill, ', ' ORDER BY l_linenumber, l_partkey, l_suppkey)",
         "@ARRAY@": "list_value"}


def _with(sql: str, words: dict[str, str]) -> str:
    for mark, word in words.items():
        sql = sql.replace(mark, word)
    return sql


POSTINGS = _with(_POSTINGS, _SPARK)
TABLE_ROWS = _with(_TABLE_ROWS, _SPARK)


def plain(sql: str) -> str:
    """The SQL with the tables under their own names, for an engine that knows them as views."""
    return _with(sql, _DUCK).replace("{", "").replace("}", "")


def sql_norm(text: str) -> str:
    return f"trim(regexp_replace(lower({text}), '\\s+', ' ', 'g'), ' .;:-')"


def sql_strip(text: str) -> str:
    return f"trim({text}, ' ' || chr(9) || chr(10) || chr(13))"


def sql_quoted(pattern: str) -> str:
    return pattern.replace("'", "''")


def sql_names(words: list[str]) -> str:
    return ", ".join(f"'{sql_quoted(word)}'" for word in words)


def sql_employer_key(text: str) -> str:
    plain_text = f"regexp_replace(lower({text}), '[^\\x00-\\x7F]', '_', 'g')"
    bare = f"regexp_replace({plain_text}, '{fixed.EMPLOYER_SUFFIX}', '', 'g')"
    return f"trim(regexp_replace(regexp_replace({bare}, '[^a-z0-9& ]+', ' ', 'g'), '\\s+', ' ', 'g'))"


def sql_kept_first(rows: str, threshold: int = 90) -> str:
    """CTEs from ``rows`` (a table of ``key, ord, body``) to ``kept_first(ord)``: keep-first removal of near-duplicates.

    The longest common subsequence of what two texts do not share at their ends is folded over the second one's characters;
    the list holds, per length, the earliest end of a common subsequence. Levenshtein's distance never exceeds the one asked
    for, so it sorts out most pairs. The scan of a key carries the list of rows kept.
    """
    return f"""
earliest AS MATERIALIZED (SELECT key, body, min(ord) AS ord FROM {rows} GROUP BY key, body),
numbered AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY key ORDER BY ord) AS n FROM earliest),
close AS MATERIALIZED (SELECT a.key, a.n AS a_n, b.n AS b_n, a.body AS x, b.body AS y FROM numbered a JOIN numbered b ON a.key = b.key AND a.n < b.n
  WHERE 200 * least(length(a.body), length(b.body)) >= {threshold} * (length(a.body) + length(b.body))
    AND 100 * levenshtein(a.body, b.body) <= {100 - threshold} * (length(a.body) + length(b.body))),
heads AS (SELECT *, coalesce(list_min(list_filter(generate_series(1, least(length(x), length(y))), lambda i: x[i] <> y[i])) - 1, least(length(x), length(y))) AS head FROM close),
tails AS (SELECT *, x[head + 1:] AS x1, y[head + 1:] AS y1 FROM heads),
middles AS (SELECT *, coalesce(list_min(list_filter(generate_series(1, least(length(x1), length(y1))), lambda i: x1[-i] <> y1[-i])) - 1, least(length(x1), length(y1))) AS tail FROM tails),
cores AS MATERIALIZED (SELECT key, a_n, b_n, head + tail AS shared, length(x) + length(y) AS total, x1[:length(x1) - tail] AS u, y1[:length(y1) - tail] AS v FROM middles),
lcs AS MATERIALIZED (SELECT key, a_n, b_n, total, shared + coalesce(len(list_filter(list_reduce(
    list_transform(string_split(v, ''), lambda c: list_filter(generate_series(1, length(u)), lambda i: u[i] = c)),
    lambda ends, places: list_transform(generate_series(1, length(u)), lambda k: least(ends[k], coalesce(list_min(list_filter(places,
      lambda p: p > CASE WHEN k = 1 THEN 0 ELSE ends[k - 1] END)), length(u) + 1))),
    list_transform(generate_series(1, length(u)), lambda k: length(u) + 1)), lambda e: e <= length(u))), 0) AS common FROM cores),
rivals AS MATERIALIZED (SELECT key, b_n AS n, list(a_n) AS earlier FROM lcs WHERE 200 * common >= {threshold} * total GROUP BY key, b_n),
scan AS (SELECT key, CAST(0 AS bigint) AS n, CAST([] AS bigint[]) AS kept FROM (SELECT DISTINCT key FROM rivals)
  UNION ALL SELECT s.key, r.n, CASE WHEN list_has_any(s.kept, coalesce(e.earlier, [])) THEN s.kept ELSE list_append(s.kept, r.n) END
  FROM scan s JOIN numbered r ON r.key = s.key AND r.n = s.n + 1 LEFT JOIN rivals e ON e.key = r.key AND e.n = r.n),
last_lists AS (SELECT key, arg_max(kept, n) AS kept FROM scan GROUP BY key),
kept_first AS MATERIALIZED (SELECT ord FROM numbered r LEFT JOIN last_lists l ON l.key = r.key WHERE l.key IS NULL OR list_contains(l.kept, r.n))"""


_ALIASES = ", ".join(f"('{alias}', '{target}')" for alias, target in fixed.SKILL_ALIASES.items())

CTE_POSTINGS = f"postings AS ({plain(_POSTINGS)})"
CTE_DICTIONARY = f"dictionary AS ({plain(DICTIONARY)})"
CTE_FORMS = f"""
all_forms AS (
  SELECT skill_idx, {sql_norm("label")} AS form FROM dictionary
  UNION ALL SELECT skill_idx, {sql_norm("regexp_replace(label, '[(][^)]*[)]', '', 'g')")} FROM dictionary
  UNION ALL SELECT skill_idx, {sql_norm("alt")} FROM (SELECT skill_idx, unnest(string_split(alt_labels, chr(10))) AS alt FROM dictionary)),
first_forms AS (SELECT form, min(skill_idx) AS skill_idx FROM all_forms GROUP BY form),
aliases AS (SELECT alias AS form, skill_idx FROM (VALUES {_ALIASES}) AS a(alias, target) JOIN first_forms ON form = lower(target)),
forms AS (SELECT * FROM aliases UNION ALL SELECT * FROM first_forms WHERE form NOT IN (SELECT form FROM aliases))"""
CTE_PAIRS = f"""
wanted AS (
  SELECT posting, {sql_employer_key("employer")} AS employer, title, skills FROM postings
  WHERE NOT regexp_matches(employer, '(?i){fixed.PLACEHOLDER_EMPLOYER}') AND trim(employer) <> ''
    AND {sql_employer_key("employer")} <> ''
    AND CASE WHEN try_cast(exp_min_text AS double) IS NOT NULL THEN try_cast(exp_min_text AS double) <= 1
        ELSE regexp_matches(exp_text, '(?i){fixed.ENTRY_LEVEL_TEXT}') END
    AND regexp_matches(title, '(?i){fixed.TITLE_INCLUDE}') AND NOT regexp_matches(title, '(?i){fixed.TITLE_EXCLUDE}')
    AND NOT regexp_matches(title, '(?i){fixed.TITLE_SENIOR}')),
raws AS (SELECT posting, employer, title, trim(unnest(string_split(skills, ','))) AS raw FROM wanted),
mapped AS (SELECT DISTINCT posting, employer, title, skill_idx, 'exact' AS how FROM raws JOIN forms ON {sql_norm("raw")} = form
  WHERE length({sql_norm("raw")}) >= 2 AND {sql_norm("raw")} NOT IN ({sql_names(fixed.VAGUE_SKILLS)})),
pairs AS (SELECT * FROM mapped QUALIFY count(*) OVER (PARTITION BY posting) >= 2)"""
CTE_COUNTS = f"""
counts AS (SELECT skill_idx, count(DISTINCT employer) AS employers, count(DISTINCT posting) AS postings,
  avg(CAST(regexp_matches(title, '(?i){fixed.TITLE_BUILDER}') AS int)) AS core_builder_share,
  avg(CAST(regexp_matches(title, '(?i){fixed.TITLE_JUNIOR}') AS int)) AS junior_share FROM pairs GROUP BY skill_idx),
threshold AS (SELECT CAST(greatest(3, ceil(0.005 * count(DISTINCT employer))) AS int) AS k FROM pairs),
verified AS (SELECT counts.*, k FROM counts, threshold WHERE employers >= k)"""
WITH_PAIRS = f"WITH {CTE_POSTINGS}, {CTE_DICTIONARY}, {CTE_FORMS}, {CTE_PAIRS}"
WITH_COUNTS = f"{WITH_PAIRS}, {CTE_COUNTS}"
