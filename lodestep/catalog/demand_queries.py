"""Queries of the demand side."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestep.catalog import inputs
from lodestep.catalog.inputs import WITH_COUNTS, WITH_PAIRS, sql_names, sql_norm, sql_quoted, sql_strip
from lodestep.catalog.registry import Tables, query
from lodestep.functions import fixed_values as fixed
from lodestep.functions import text
from lodestep.operators import demand, dictionary, filters
from lodestep.operators.near_duplicates import keep_first
from lodestep.plans import demand_report as plan
from lodestep.session import cut_lineage
from lodestep.sources.csv_files import blank_texts, harmonised
from lodestep.sources.sinks import counts_by


def postings(tables: Tables) -> DataFrame:
    rows = tables.derived(inputs.POSTINGS)
    return rows.withColumn("exp_min", text.to_number(F.col("exp_min_text"))).drop("exp_min_text")


def entries(tables: Tables) -> DataFrame:
    return tables.derived(inputs.DICTIONARY)


def pairs(tables: Tables) -> DataFrame:
    named = filters.named_employers(postings(tables))
    return plan.posting_skill_table(named, entries(tables), dictionary.alias_table(tables.spark))


def base_counts(tables: Tables) -> DataFrame:
    return cut_lineage(demand.employer_skill_counts(pairs(tables)))


@query("normalise_text", f"""
SELECT doc_id, {sql_norm("text")} AS norm_text,
  {sql_norm("regexp_replace(text, '[(][^)' || chr(10) || ']*[)]', '', 'g')")} AS without_paren,
  {inputs.sql_employer_key("text")} AS employer_key,
  trim(regexp_replace(lower(text), '[^a-z0-9]+', '_', 'g'), '_') AS slug
FROM documents""")
def normalise_text(tables: Tables) -> DataFrame:
    body = F.col("text")
    return tables.spread(tables.documents).select(
        "doc_id", text.norm(body).alias("norm_text"), text.strip_paren(body).alias("without_paren"),
        text.employer_key(body).alias("employer_key"), text.slug(body).alias("slug"))


@query("stable_ids", "SELECT page_id, 'esco_' || substr(sha1(url), 1, 16) AS skill_id FROM pages")
def stable_ids(tables: Tables) -> DataFrame:
    return tables.pages.select("page_id", text.dictionary_id(F.col("url")).alias("skill_id"))


@query("harmonised_union", """
SELECT c_name AS name, CAST(c_nationkey AS varchar) AS nation, c_acctbal AS balance, c_mktsegment AS segment, 'customer' AS source FROM customer
UNION ALL SELECT s_name, CAST(s_nationkey AS varchar), s_acctbal, '', 'supplier' FROM supplier""")
def harmonised_union(tables: Tables) -> DataFrame:
    candidates = {"name": ["c_name", "s_name"], "nation": ["c_nationkey", "s_nationkey"],
                  "balance": ["c_acctbal", "s_acctbal"], "segment": ["c_mktsegment"]}
    parts = [harmonised(rows, candidates).withColumn("source", F.lit(name))
             for name, rows in (("customer", tables.customer), ("supplier", tables.supplier))]
    merged = parts[0].unionByName(parts[1])
    return blank_texts(merged.withColumn("balance", text.to_number(F.col("balance"))), ["name", "nation", "segment"])


@query("numeric_coerce", """
SELECT p_partkey, pos, try_cast(trim(value) AS double) AS number FROM (
  SELECT p_partkey, unnest([p_brand, CAST(p_retailprice AS varchar), ' ' || CAST(p_size AS varchar) || ' ', CAST(p_size AS varchar) || ' yrs', '-.5e1', 'nan', NULL]) AS value,
    unnest([0, 1, 2, 3, 4, 5, 6]) AS pos FROM part) WHERE pos <> 5
UNION ALL SELECT p_partkey, 5, NULL FROM part""")
def numeric_coerce(tables: Tables) -> DataFrame:
    size = F.col("p_size").cast("string")
    values = F.array(F.col("p_brand"), F.col("p_retailprice").cast("string"), F.concat(F.lit(" "), size, F.lit(" ")),
                     F.concat(size, F.lit(" yrs")), F.lit("-.5e1"), F.lit("nan"), F.lit(None).cast("string"))
    return tables.part.select("p_partkey", F.posexplode(values).alias("pos", "value")).select(
        "p_partkey", "pos", text.to_number(F.col("value")).alias("number"))


@query("named_employers", f"""
WITH {inputs.CTE_POSTINGS}
SELECT posting, {inputs.sql_employer_key("employer")} AS employer_key FROM postings
WHERE NOT regexp_matches(employer, '(?i){fixed.PLACEHOLDER_EMPLOYER}') AND trim(employer) <> ''
  AND {inputs.sql_employer_key("employer")} <> ''""")
def named_employers(tables: Tables) -> DataFrame:
    return filters.named_employers(postings(tables)).select("posting", "employer_key")


@query("entry_level", f"""
WITH {inputs.CTE_POSTINGS}
SELECT posting, try_cast(exp_min_text AS double) AS exp_min, exp_text FROM postings
WHERE CASE WHEN try_cast(exp_min_text AS double) IS NOT NULL THEN try_cast(exp_min_text AS double) <= 1
  ELSE regexp_matches(exp_text, '(?i){fixed.ENTRY_LEVEL_TEXT}') END""")
def entry_level(tables: Tables) -> DataFrame:
    return filters.entry_level(postings(tables)).select("posting", "exp_min", "exp_text")


@query("coding_titles", f"""
WITH {inputs.CTE_POSTINGS}
SELECT posting, title, regexp_matches(title, '(?i){fixed.TITLE_BUILDER}') AS core_builder,
  regexp_matches(title, '(?i){fixed.TITLE_JUNIOR}') AS junior_role FROM postings
WHERE regexp_matches(title, '(?i){fixed.TITLE_INCLUDE}') AND NOT regexp_matches(title, '(?i){fixed.TITLE_EXCLUDE}')
  AND NOT regexp_matches(title, '(?i){fixed.TITLE_SENIOR}')""")
def coding_titles(tables: Tables) -> DataFrame:
    return filters.coding_titles(postings(tables)).select("posting", "title", *filters.title_flags(F.col("title")))


@query("keyword_entries", f"""
WITH {inputs.CTE_DICTIONARY}
SELECT skill_idx, label FROM dictionary
WHERE regexp_matches(label || ' ' || coalesce(alt_labels, ''), '(?i){sql_quoted(fixed.DIGITAL_KEYWORDS)}')""")
def keyword_entries(tables: Tables) -> DataFrame:
    return filters.keyword_entries(entries(tables)).select("skill_idx", "label")


@query("dictionary_forms", f"WITH {inputs.CTE_DICTIONARY}, {inputs.CTE_FORMS} SELECT form, skill_idx FROM forms")
def dictionary_forms(tables: Tables) -> DataFrame:
    return dictionary.with_aliases(dictionary.surface_forms(entries(tables)), dictionary.alias_table(tables.spark))


_RETURNED = "SELECT 'http://example.org/skill/' || CAST(l_partkey AS varchar(20)) AS uri FROM {lineitem} WHERE l_returnflag = 'R'"


@query("listed_entries", f"""
WITH {inputs.CTE_DICTIONARY}
SELECT skill_idx, uri FROM dictionary WHERE uri IN ({inputs.plain(_RETURNED)})""")
def listed_entries(tables: Tables) -> DataFrame:
    return dictionary.listed_entries(entries(tables), tables.derived(_RETURNED)).select("skill_idx", "uri")


_TARGETS = """
SELECT p_type || ' ' || p_brand AS name, CASE WHEN min(p_size) % 2 = 0 THEN 'no such label'
  ELSE upper(min(p_name || ' ' || p_brand || ' (' || lower(p_type) || ')')) END AS target
FROM {part} GROUP BY p_type, p_brand"""


@query("dictionary_links", f"""
WITH {inputs.CTE_DICTIONARY}, targets AS ({inputs.plain(_TARGETS)}),
firsts AS (SELECT label, min(skill_idx) AS skill_idx, arg_min(uri, skill_idx) AS uri FROM dictionary GROUP BY label),
links AS (SELECT lower(label) AS label_key, 'esco_' || substr(sha1(arg_max(uri, skill_idx)), 1, 16) AS id,
  arg_max(label, skill_idx) AS label FROM firsts GROUP BY lower(label))
SELECT name AS skill_name, coalesce(id, 'esco_' || substr(sha1(name), 1, 16)) AS dictionary_id, coalesce(label, name) AS dictionary_name
FROM targets LEFT JOIN links ON lower(target) = label_key""")
def dictionary_links(tables: Tables) -> DataFrame:
    targets = tables.derived(_TARGETS)
    linked = dictionary.link_to_dictionary(targets.select(F.col("name").alias("skill_name")), targets,
                                           dictionary.linked_labels(entries(tables)))
    return linked.select("skill_name", "dictionary_id", "dictionary_name")


@query("unmatched_skills", f"""
WITH doc_skills AS (SELECT DISTINCT raw FROM (SELECT {sql_strip("unnest(string_split(text, ','))")} AS raw FROM documents) WHERE raw <> ''),
known AS (SELECT DISTINCT {sql_norm("unnest(string_split(text, ','))")} AS form FROM benchmark)
SELECT raw FROM doc_skills WHERE length({sql_norm("raw")}) >= 2 AND {sql_norm("raw")} NOT IN ({sql_names(fixed.VAGUE_SKILLS)})
  AND {sql_norm("raw")} NOT IN (SELECT form FROM known)""")
def unmatched_skills(tables: Tables) -> DataFrame:
    raw = tables.spread(tables.documents).select(F.explode(text.split_list(F.col("text"))).alias("raw"))
    known = tables.benchmark.select(F.explode(F.transform(text.split_list(F.col("text")), text.norm)).alias("form"))
    forms = known.distinct().withColumn("skill_idx", F.xxhash64("form"))
    skills = dictionary.distinct_skills(raw)
    return dictionary.unmatched_skills(skills, dictionary.exact_matches(skills, forms))


@query("posting_skill_pairs", f"{WITH_PAIRS} SELECT posting, employer, title, skill_idx, how FROM pairs")
def posting_skill_pairs(tables: Tables) -> DataFrame:
    return pairs(tables).select("posting", "employer", "title", "skill_idx", "how")


@query("demand_counts", f"""{WITH_COUNTS}
SELECT skill_idx, employers, postings, round(core_builder_share, 6) AS core_builder_share,
  round(junior_share, 6) AS junior_share, k FROM verified ORDER BY employers DESC, skill_idx""")
def demand_counts(tables: Tables) -> DataFrame:
    """Flagship: distinct employers per skill above the automatic threshold."""
    return demand.verified_skills(base_counts(tables)).select(
        "skill_idx", "employers", "postings", F.round("core_builder_share", 6).alias("core_builder_share"),
        F.round("junior_share", 6).alias("junior_share"), "k").orderBy(F.desc("employers"), "skill_idx")


@query("sketched_counts", f"""{WITH_PAIRS},
exact AS (SELECT skill_idx, count(DISTINCT employer) AS employers, count(DISTINCT posting) AS postings FROM pairs GROUP BY skill_idx)
SELECT skill_idx, employers, postings, true AS within_bound FROM exact""")
def sketched_counts(tables: Tables) -> DataFrame:
    """Exact counts beside those of monthly sketches merged over all months; the estimates must be within five standard errors."""
    found = cut_lineage(pairs(tables).join(tables.orders.select(
        F.col("o_orderkey").alias("posting"), F.date_trunc("month", "o_orderdate").alias("month")), "posting"))
    estimates = demand.merged_sketch_counts(demand.employer_sketches(found, "month"))
    exact = demand.skill_counts(demand.employer_skill_counts(found)).select("skill_idx", "employers", "postings")

    def near(name: str):
        return F.abs(F.col(f"e.{name}") - F.col(f"x.{name}")) <= F.greatest(F.lit(1.0), 5 * 0.8 / 64 * F.col(f"x.{name}"))
    return exact.alias("x").join(estimates.alias("e"), "skill_idx").select(
        "skill_idx", "x.employers", "x.postings", (near("employers") & near("postings")).alias("within_bound"))


@query("employer_distribution", f"""{WITH_COUNTS}
SELECT count(*) AS n, round(avg(employers), 6) AS mean, round(stddev_samp(employers), 6) AS std, min(employers) AS min,
  round(quantile_cont(employers, 0.5), 6) AS p50, round(quantile_cont(employers, 0.75), 6) AS p75,
  round(quantile_cont(employers, 0.9), 6) AS p90, round(quantile_cont(employers, 0.95), 6) AS p95, max(employers) AS max
FROM counts""")
def employer_distribution(tables: Tables) -> DataFrame:
    shape = demand.count_distribution(demand.skill_counts(base_counts(tables)))
    rounded = ("mean", "std", "p50", "p75", "p90", "p95")
    return shape.select(*[F.round(c, 6).alias(c) if c in rounded else c for c in shape.columns])


@query("survival_ladder", f"""{WITH_COUNTS}
SELECT CAST(step AS int) AS k, count(*) FILTER (WHERE employers >= step) AS survivors
FROM counts, (SELECT unnest([{", ".join(map(str, fixed.SURVIVAL_STEPS))}]) AS step) AS steps GROUP BY step""")
def survival_ladder(tables: Tables) -> DataFrame:
    return demand.survival_ladder(demand.skill_counts(base_counts(tables)))


def _sql_any(words: list[str]) -> str:
    return "(" + " OR ".join(f"contains(lower(label), '{word}')" for word in words) + ")"


SQL_RECORDS = f"""
labelled AS (SELECT verified.*, uri, label, CASE WHEN {_sql_any(fixed.RISING_LABELS)} THEN 'rising'
    WHEN {_sql_any(fixed.FADING_LABELS)} THEN 'fading' WHEN p_size % 2 = 0 THEN 'steady' END AS trend,
  CASE WHEN p_size % 2 = 0 THEN {fixed.STEADY_MULTIPLIER}::double ELSE {fixed.RISING_MULTIPLIER} ::double END AS multiplier
  FROM verified JOIN dictionary USING (skill_idx) JOIN part ON p_partkey = skill_idx),
estimated AS (SELECT *, CASE WHEN trend IS NOT NULL THEN CAST(round_even(employers * multiplier, 0) AS int) END AS est FROM labelled)
SELECT 'esco_' || substr(sha1(uri), 1, 16) AS skill_id, label AS skill_name, uri AS esco_uri,
  CAST(employers AS int) AS distinct_employers, CAST(postings AS int) AS postings,
  CASE WHEN {_sql_any(fixed.APPLY_LABELS)} THEN 'apply' WHEN {_sql_any(fixed.BUILD_LABELS)} THEN 'build'
    WHEN junior_share >= 0.35 THEN 'apply' WHEN core_builder_share >= 0.25 THEN 'build' ELSE 'apply' END AS demand_depth,
  trend, est AS trend_2030_estimate, CAST(round_even(est * CAST(0.85 AS double), 0) AS int) AS band_low,
  CAST(round_even(est * CAST(1.15 AS double), 0) AS int) AS band_high
FROM estimated"""


def part_trends(tables: Tables) -> DataFrame:
    """``skill_idx, trend, multiplier`` by the parts' size."""
    even = F.col("p_size") % 2 == 0
    return tables.part.select(
        F.col("p_partkey").alias("skill_idx"), F.when(even, "steady").alias("trend"),
        F.when(even, fixed.STEADY_MULTIPLIER).otherwise(fixed.RISING_MULTIPLIER).alias("multiplier"))


def with_band(records: DataFrame) -> DataFrame:
    return records.withColumns({"band_low": F.col("trend_confidence_band")[0],
                                "band_high": F.col("trend_confidence_band")[1]}).drop("trend_confidence_band")


@query("demand_records", f"{WITH_COUNTS}, {SQL_RECORDS}")
def demand_records(tables: Tables) -> DataFrame:
    return with_band(demand.demand_records(demand.verified_skills(base_counts(tables)), entries(tables), part_trends(tables)))


_DRAWN = "CAST('0x' || substr(md5(uri), 1, 6) AS bigint) / CAST(16777216 AS double)"
_RANGES = " ".join(f"WHEN trend = '{name}' THEN CAST({low} AS double) + {_DRAWN} * CAST({high - low} AS double)"
                   for name, (low, high) in fixed.KEYWORD_MULTIPLIERS.items())


@query("keyword_trends", f"""{WITH_COUNTS},
labelled AS (SELECT skill_idx, label, uri, employers, CASE WHEN {_sql_any(fixed.RISING_LABELS)} THEN 'rising'
  WHEN {_sql_any(fixed.FADING_LABELS)} THEN 'fading' END AS trend FROM verified JOIN dictionary USING (skill_idx)),
estimated AS (SELECT *, CAST(round_even(employers * CASE {_RANGES} END, 0) AS int) AS est FROM labelled)
SELECT 'esco_' || substr(sha1(uri), 1, 16) AS skill_id, trend, est AS trend_2030_estimate,
  CAST(round_even(est * CAST(0.85 AS double), 0) AS int) AS band_low, CAST(round_even(est * CAST(1.15 AS double), 0) AS int) AS band_high FROM estimated""")
def keyword_trends(tables: Tables) -> DataFrame:
    """Trends that labels decide, without a table of fitted ones."""
    records = demand.demand_records(demand.verified_skills(base_counts(tables)), entries(tables), keyword_ranges=fixed.KEYWORD_MULTIPLIERS)
    return with_band(records).select("skill_id", "trend", "trend_2030_estimate", "band_low", "band_high")


@query("source_counts", "SELECT source, count(*) AS n_rows FROM documents GROUP BY source")
def source_counts(tables: Tables) -> DataFrame:
    return counts_by(tables.documents, "source")


@query("posting_fingerprints", f"""
WITH {inputs.CTE_POSTINGS}
SELECT {sql_norm("title")} || ' | ' || array_to_string(list_sort(list_transform(string_split(skills, ','), lambda s: {sql_norm("s")})), ',')
  || ' | ' || {sql_norm("description")} AS fingerprint, count(*) AS n, min(posting) AS first_posting
FROM postings GROUP BY 1""")
def posting_fingerprints(tables: Tables) -> DataFrame:
    printed = text.fingerprint(F.col("title"), F.col("skills"), F.col("description"))
    return postings(tables).groupBy(printed.alias("fingerprint")).agg(
        F.count("*").alias("n"), F.min("posting").alias("first_posting"))


SQL_PRINT = f"""{sql_norm("title")} || ' | ' || array_to_string(list_sort(list_transform(string_split(skills, ','), lambda s: {sql_norm("s")})), ',')
  || ' | ' || {sql_norm("description")}"""
SQL_NAMED = f"""NOT regexp_matches(employer, '(?i){fixed.PLACEHOLDER_EMPLOYER}') AND trim(employer) <> ''
  AND {inputs.sql_employer_key("employer")} <> ''"""
CTE_UNIQUE = f"""
printed AS MATERIALIZED (SELECT posting AS ord, {inputs.sql_employer_key("employer")} AS key, {SQL_PRINT} AS body FROM postings WHERE {SQL_NAMED}),
{inputs.sql_kept_first("printed")}"""


@query("near_duplicate_postings", f"""
WITH RECURSIVE {inputs.CTE_POSTINGS}, {CTE_UNIQUE}
SELECT ord AS posting, key AS employer_key FROM printed WHERE ord IN (SELECT ord FROM kept_first)""")
def near_duplicate_postings(tables: Tables) -> DataFrame:
    return plan.unique_postings(postings(tables)).select("posting", "employer_key")


_LISTED = "SELECT 'http://example.org/skill/' || CAST(l_partkey AS varchar(20)) AS uri FROM {lineitem} WHERE l_returnflag = 'R' AND l_quantity > 45"
_WITH_UNIQUE = inputs.WITH_COUNTS.replace("WITH ", "WITH RECURSIVE ", 1).replace(
    inputs.CTE_PAIRS, f"""{CTE_UNIQUE},
{inputs.CTE_PAIRS.replace("FROM postings", "FROM postings SEMI JOIN kept_first ON posting = ord")}""")
_IN_ORDER = _WITH_UNIQUE.replace(
    inputs.CTE_DICTIONARY, f"dictionary AS (SELECT * FROM ({inputs.plain(inputs.DICTIONARY)}) WHERE uri IN ({inputs.plain(_LISTED)}))")


@query("unique_demand_counts", f"""{_IN_ORDER}
SELECT skill_idx, employers, postings, round(core_builder_share, 6) AS core_builder_share, round(junior_share, 6) AS junior_share, k FROM verified""")
def unique_demand_counts(tables: Tables) -> DataFrame:
    """The demand side in its real order: named employers, near-duplicates removed, row filters, a restricted dictionary, counts."""
    listed = dictionary.listed_entries(entries(tables), tables.derived(_LISTED))
    unique = plan.unique_postings(postings(tables))
    found = plan.posting_skill_table(unique, listed, dictionary.alias_table(tables.spark))
    return demand.verified_skills(cut_lineage(demand.employer_skill_counts(found))).select(
        "skill_idx", "employers", "postings", F.round("core_builder_share", 6).alias("core_builder_share"),
        F.round("junior_share", 6).alias("junior_share"), "k")


_SQL_ENTRY = f"""CASE WHEN try_cast(exp_min_text AS double) IS NOT NULL THEN try_cast(exp_min_text AS double) <= 1
  ELSE coalesce(regexp_matches(exp_text, '(?i){fixed.ENTRY_LEVEL_TEXT}'), false) END"""
_SQL_CODING = f"""regexp_matches(title, '(?i){fixed.TITLE_INCLUDE}') AND NOT regexp_matches(title, '(?i){fixed.TITLE_EXCLUDE}')
  AND NOT regexp_matches(title, '(?i){fixed.TITLE_SENIOR}')"""


@query("stage_counts", f"""
WITH RECURSIVE {inputs.CTE_POSTINGS}, {CTE_UNIQUE}, left_over AS (SELECT * FROM postings SEMI JOIN kept_first ON posting = ord)
SELECT 1 AS stage_no, 'read' AS stage, count(*) AS n_rows FROM postings
UNION ALL SELECT 2, 'named employers', count(*) FROM printed UNION ALL SELECT 3, 'unique', count(*) FROM left_over
UNION ALL SELECT 4, 'entry level', count(*) FROM left_over WHERE {_SQL_ENTRY}
UNION ALL SELECT 5, 'coding titles', count(*) FROM left_over WHERE {_SQL_ENTRY} AND {_SQL_CODING}""")
def stage_counts(tables: Tables) -> DataFrame:
    return plan.stage_counts(postings(tables))


@query("near_duplicate_documents")
def near_duplicate_documents(tables: Tables) -> DataFrame:
    bodies = tables.spread(tables.documents).withColumn("body", text.norm(F.col("text")))
    return keep_first(bodies, "source", "doc_id", "body").select("doc_id", "source")


@query("near_duplicate_documents_minhash")
def near_duplicate_documents_minhash(tables: Tables) -> DataFrame:
    bodies = tables.spread(tables.documents).withColumn("body", text.norm(F.col("text")))
    return keep_first(bodies, "source", "doc_id", "body", blocking="minhash").select("doc_id", "source")


@query("demand_report", f"{_WITH_UNIQUE}, {SQL_RECORDS}")
def demand_report(tables: Tables) -> DataFrame:
    """The whole demand side, near-duplicate removal included."""
    return with_band(plan.demand_report(postings(tables), entries(tables), dictionary.alias_table(tables.spark), trends=part_trends(tables)))
