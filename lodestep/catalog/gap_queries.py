"""Queries of trends, gaps, checks and snapshots."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestep.catalog import inputs
from lodestep.catalog.demand_queries import base_counts, entries, pairs, postings
from lodestep.catalog.inputs import WITH_COUNTS
from lodestep.catalog.registry import Tables, query
from lodestep.catalog.supply_queries import CTE_EVIDENCE, topics
from lodestep.functions.depth import depth_of_rank
from lodestep.operators import demand, gap, trend, validation
from lodestep.plans import gap_report as plan
from lodestep.plans.supply_report import topic_evidence
from lodestep.session import new_folder
from lodestep.streaming import snapshots as streamed
from lodestep.streaming.snapshots import snapshot_counts

CTE_SERIES = f"series AS ({inputs.plain(inputs.SERIES)})"
_LIMIT = 0.002


def series(tables: Tables) -> DataFrame:
    return tables.derived(inputs.SERIES)


def _sql_direction(slope: str) -> str:
    return f"CASE WHEN {slope} > {_LIMIT} THEN 'rising' WHEN {slope} < -{_LIMIT} THEN 'fading' ELSE 'steady' END"


def _rounded(frame: DataFrame, *names: str) -> DataFrame:
    return frame.withColumns({name: F.round(name, 6) for name in names})


@query("usage_series", f"""
WITH {inputs.CTE_POSTINGS},
named AS (SELECT year(posted_at) AS year, unnest(list_distinct(list_filter(list_transform(string_split(skills, ','), lambda s: trim(s)), lambda s: s <> ''))) AS skill_id
  FROM postings WHERE exp_text = 'Fresher'),
totals AS (SELECT year(posted_at) AS year, count(*) AS n FROM postings WHERE exp_text = 'Fresher' GROUP BY 1)
SELECT skill_id, year, count(*) AS users, round(count(*) / max(n), 6) AS usage FROM named JOIN totals USING (year) GROUP BY skill_id, year""")
def usage_series(tables: Tables) -> DataFrame:
    responses = postings(tables).select(F.year("posted_at").cast("long").alias("year"), F.col("exp_text").alias("country"),
                                        F.col("skills").alias("technologies"))
    return _rounded(trend.usage_series(responses, country="Fresher", delimiter=","), "usage")


def _sql_fits(y: str, t_value: float) -> str:
    return f"""
fits AS (SELECT skill_id, count(*) AS n, regr_slope({y}, year) AS slope, regr_intercept({y}, year) AS intercept,
  avg(year) AS m, regr_sxx({y}, year) AS sxx, regr_syy({y}, year) AS syy, regr_sxy({y}, year) AS sxy FROM series GROUP BY skill_id),
spreads AS (SELECT *, intercept + slope * 2030 AS est, CASE WHEN n >= 3 THEN sqrt(greatest(syy - sxy * sxy / sxx, 0) / (n - 2))
  * sqrt(1 + 1.0 / n + (2030 - m) * (2030 - m) / sxx) * {t_value} END AS half FROM fits)"""


def _sql_fit(y: str, back: str) -> str:
    return f"""{_sql_fits(y, 2.571)}
SELECT skill_id, n, round(slope, 6) AS slope, round(intercept, 4) AS intercept, {_sql_direction("slope")} AS trend,
  round({back}(est), 6) AS estimate, round({back}(est - half), 6) AS low, round({back}(est + half), 6) AS high FROM spreads"""


def _fit(tables: Tables, log: bool) -> DataFrame:
    fitted = trend.fitted_trends(series(tables), threshold=_LIMIT, t_value=2.571, log=log)
    return _rounded(fitted, "slope", "estimate", "low", "high").withColumn("intercept", F.round("intercept", 4))


@query("fitted_trends", f"WITH {CTE_SERIES}, {_sql_fit('usage', '')}")
def fitted_trends(tables: Tables) -> DataFrame:
    return _fit(tables, log=False)


@query("fitted_trends_log", f"WITH {CTE_SERIES}, {_sql_fit('ln(usage)', 'exp')}")
def fitted_trends_log(tables: Tables) -> DataFrame:
    return _fit(tables, log=True)


@query("trend_backtest", f"""
WITH {CTE_SERIES},
slopes AS (SELECT skill_id, regr_slope(usage, year) FILTER (WHERE year <= 1998) AS p, regr_slope(usage, year) FILTER (WHERE year > 1998) AS a FROM series GROUP BY skill_id)
SELECT skill_id, {_sql_direction("p")} AS predicted, {_sql_direction("a")} AS actual, {_sql_direction("p")} = {_sql_direction("a")} AS hit FROM slopes""")
def trend_backtest(tables: Tables) -> DataFrame:
    return trend.backtest(series(tables), last_train_year=1998, threshold=_LIMIT)


@query("directional_accuracy", f"""
WITH {CTE_SERIES},
slopes AS (SELECT skill_id, regr_slope(usage, year) FILTER (WHERE year <= 1998) AS p, regr_slope(usage, year) FILTER (WHERE year > 1998) AS a FROM series GROUP BY skill_id)
SELECT count(*) AS n_skills, round(avg(CAST({_sql_direction("p")} = {_sql_direction("a")} AS int)), 6) AS accuracy FROM slopes""")
def directional_accuracy(tables: Tables) -> DataFrame:
    tested = trend.backtest(series(tables), last_train_year=1998, threshold=_LIMIT)
    return _rounded(trend.directional_accuracy(tested), "accuracy")


@query("trend_bootstrap", f"""
WITH {CTE_SERIES},
draws AS (SELECT *, CAST('0x' || substr(md5(concat_ws(':', skill_id, year, draw, 42)), 1, {trend.DRAW_DIGITS}) AS bigint) / CAST({16 ** trend.DRAW_DIGITS} AS double) AS u
  FROM series, (SELECT unnest(generate_series(1, 200)) AS draw) AS numbers),
weighted AS (SELECT skill_id, draw, year - 2030 AS x, usage AS y, len(list_filter({trend.poisson_limits()}::double[], lambda least: u >= least)) AS w FROM draws),
sums AS (SELECT skill_id, draw, sum(w) AS n, sum(w * x) AS sx, sum(w * y) AS sy, sum(w * x * x) AS sxx, sum(w * x * y) AS sxy FROM weighted GROUP BY skill_id, draw),
refits AS (SELECT skill_id, (sy * sxx - sx * sxy) / nullif(CAST(n * sxx - sx * sx AS double), 0) AS v FROM sums)
SELECT skill_id, round(quantile_cont(v, 0.025), 6) AS low, round(quantile_cont(v, 0.975), 6) AS high FROM refits GROUP BY skill_id""")
def trend_bootstrap(tables: Tables) -> DataFrame:
    return _rounded(trend.bootstrap_range(series(tables)), "low", "high")


_TAUGHT = """
SELECT CAST(l_partkey AS bigint) AS skill_idx, CAST(l_quantity AS int) % 3 AS rank FROM {lineitem} WHERE l_returnflag = 'A'"""


def _gap_inputs(tables: Tables) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Demand, supply (several rows per skill) and brand trends, all keyed by part."""
    counted = demand.verified_skills(base_counts(tables)).join(entries(tables), "skill_idx")
    wanted = counted.select(F.col("skill_idx").alias("skill_id"), F.col("employers").alias("distinct_employers"),
                            demand.demand_depth(F.col("label"), F.col("core_builder_share"), F.col("junior_share")).alias("demand_depth"))
    supply = tables.derived(_TAUGHT).select(F.col("skill_idx").alias("skill_id"), depth_of_rank(F.col("rank")).alias("depth"))
    brands = trend.fitted_trends(series(tables), threshold=_LIMIT).select(F.col("skill_id").alias("p_brand"), "trend")
    trends = tables.part.join(brands, "p_brand").select(F.col("p_partkey").alias("skill_id"), "trend")
    return wanted, supply, trends


def _sql_any(words: list[str]) -> str:
    return "(" + " OR ".join(f"contains(lower(label), '{word}')" for word in words) + ")"


CTE_ASKED = f"""
taught AS (SELECT skill_idx, max(rank) AS rank FROM ({inputs.plain(_TAUGHT)}) GROUP BY skill_idx),
asked AS (SELECT skill_idx AS skill_id, label, employers AS distinct_employers, CASE WHEN {_sql_any(inputs.fixed.APPLY_LABELS)} THEN 'apply'
  WHEN {_sql_any(inputs.fixed.BUILD_LABELS)} THEN 'build' WHEN junior_share >= 0.35 THEN 'apply' WHEN core_builder_share >= 0.25 THEN 'build' ELSE 'apply' END AS demand_depth
  FROM verified JOIN dictionary USING (skill_idx))"""


def _sql_ranked(trends: str, columns: str) -> str:
    """From ``asked`` and ``taught`` and a table of brands' trends to scored gaps with ``columns``."""
    return f"""
gaps AS (SELECT w.*, CASE t.rank WHEN 0 THEN 'know' WHEN 1 THEN 'apply' WHEN 2 THEN 'build' END AS taught_depth,
  CASE demand_depth WHEN 'apply' THEN 1 ELSE 2 END - coalesce(t.rank, -1) AS depth_gap, {_sql_direction("slope")} AS trend, fit.* EXCLUDE (skill_id)
  FROM asked w LEFT JOIN taught t ON skill_idx = w.skill_id JOIN part ON p_partkey = w.skill_id JOIN {trends} AS fit ON fit.skill_id = p_brand),
scaled AS (SELECT *, min(depth_gap) OVER () AS g0, max(depth_gap) OVER () AS g1, min(distinct_employers) OVER () AS e0, max(distinct_employers) OVER () AS e1 FROM gaps)
SELECT {columns}, round(0.5 * coalesce((depth_gap - g0) / nullif(CAST(g1 - g0 AS double), 0), 0)
  + 0.3 * coalesce((distinct_employers - e0) / nullif(CAST(e1 - e0 AS double), 0), 0)
  + 0.2 * CASE trend WHEN 'rising' THEN 1 WHEN 'steady' THEN 0.5 ELSE 0 END, 6) AS priority_score FROM scaled"""


@query("ranked_gaps", f"""{WITH_COUNTS}, {CTE_SERIES}, {CTE_ASKED},
slopes AS (SELECT skill_id, regr_slope(usage, year) AS slope FROM series GROUP BY skill_id),
{_sql_ranked("slopes", "skill_id, distinct_employers, demand_depth, taught_depth, depth_gap, trend")}""")
def ranked_gaps(tables: Tables) -> DataFrame:
    wanted, supply, trends = _gap_inputs(tables)
    return _rounded(gap.ranked_gaps(gap.joined_gaps(wanted, supply, trends)), "priority_score")


@query("gap_report", f"""{WITH_COUNTS}, {CTE_SERIES}, {CTE_ASKED}, {_sql_fits("usage", 2.447)},
{_sql_ranked("spreads", """skill_id, label AS skill_name, distinct_employers, demand_depth, taught_depth, depth_gap, trend,
  round(est, 6) AS trend_2030_estimate, round(est - half, 6) AS band_low, round(est + half, 6) AS band_high""")}""")
def gap_report(tables: Tables) -> DataFrame:
    """Ranked gaps with fitted trends and their range, by brand."""
    wanted, supply, _ = _gap_inputs(tables)
    yearly = tables.part.select(F.col("p_partkey").alias("part"), "p_brand").join(
        series(tables), F.col("p_brand") == F.col("skill_id")).select(F.col("part").alias("skill_id"), "year", "usage")
    named = wanted.join(entries(tables).select(F.col("skill_idx").alias("skill_id"), F.col("label").alias("skill_name")), "skill_id")
    ranked = plan.gap_report(named, supply, yearly, threshold=_LIMIT)
    band = F.col("trend_confidence_band")
    return _rounded(ranked.withColumns({"band_low": band[0], "band_high": band[1]}).drop("trend_confidence_band"),
                    "trend_2030_estimate", "band_low", "band_high", "priority_score")


_EXPECTED = "CASE tie % 3 WHEN 0 THEN 'know' WHEN 1 THEN 'apply' ELSE 'build' END"


def _predicted(tables: Tables) -> DataFrame:
    evidence = topic_evidence(topics(tables))
    return evidence.select(F.col("depth").alias("predicted"),
                           depth_of_rank((F.col("ord.chunk_ord.tie") % 3).cast("int")).alias("expected"))


@query("depth_agreement", f"""WITH {CTE_EVIDENCE}
SELECT count(*) AS n_items, round(avg(CAST(depth = {_EXPECTED} AS int)), 6) AS agreement FROM evidence""")
def depth_agreement(tables: Tables) -> DataFrame:
    return _rounded(validation.agreement_rate(_predicted(tables)), "agreement")


@query("depth_confusion", f"""WITH {CTE_EVIDENCE}
SELECT {_EXPECTED} AS expected, count(*) FILTER (WHERE depth = 'know') AS know, count(*) FILTER (WHERE depth = 'apply') AS apply,
  count(*) FILTER (WHERE depth = 'build') AS build FROM evidence GROUP BY 1""")
def depth_confusion(tables: Tables) -> DataFrame:
    return validation.confusion(_predicted(tables), ["know", "apply", "build"])


@query("pass_rate", """
SELECT lang, source, count(*) AS n_challenges, round(avg(quality), 6) AS pass_rate
FROM labels JOIN documents USING (doc_id) GROUP BY lang, source""")
def pass_rate(tables: Tables) -> DataFrame:
    results = tables.labels.join(tables.documents.select("doc_id", "lang", "source"), "doc_id").withColumn(
        "verified", F.col("quality") == 1)
    return _rounded(validation.pass_rate(results, ["lang", "source"]), "pass_rate")


@query("measured_gaps", """
WITH inferred AS (SELECT event_type AS skill_id, count(DISTINCT user_id) % 3 AS depth_gap FROM events GROUP BY event_type)
SELECT skill_id, depth_gap, count(*) AS attempts, round(1 - avg(CAST(value > 20 AS int)), 6) AS measured_gap
FROM events JOIN inferred ON skill_id = event_type GROUP BY skill_id, depth_gap""")
def measured_gaps(tables: Tables) -> DataFrame:
    users = tables.events.select("event_type", "user_id").distinct().groupBy(F.col("event_type").alias("skill_id")).agg(
        (F.count("*") % 3).alias("depth_gap"))
    attempts = tables.events.select(F.col("event_type").alias("skill_id"), (F.col("value") > 20).alias("passed"))
    return _rounded(validation.measured_gaps(users, attempts), "measured_gap")


@query("snapshot_counts", f"""{inputs.WITH_PAIRS}
SELECT CAST(date_trunc('month', posted_at) AS date) AS period, skill_idx, count(DISTINCT employer) AS employers, count(DISTINCT posting) AS postings
FROM pairs JOIN (SELECT posting, posted_at FROM postings) USING (posting) GROUP BY 1, 2""")
def snapshots(tables: Tables) -> DataFrame:
    dated = pairs(tables).join(tables.orders.select(F.col("o_orderkey").alias("posting"), F.col("o_orderdate").alias("posted_at")), "posting")
    return snapshot_counts(dated)


@query("event_snapshots", """
SELECT CAST(date_trunc('week', ts) AS date) AS period, event_type AS skill_idx, count(DISTINCT user_id) AS employers, count(*) AS postings
FROM events GROUP BY 1, 2""")
def event_snapshots(tables: Tables) -> DataFrame:
    named = tables.events.select(F.col("ts").alias("posted_at"), F.col("event_type").alias("skill_idx"),
                                 F.col("user_id").alias("employer"), F.col("event_id").alias("posting"))
    return snapshot_counts(named, "week")


@query("streamed_snapshots", """
SELECT CAST(date_trunc('week', ts) AS date) AS period, event_type AS skill_idx, count(DISTINCT user_id) AS employers, count(*) AS postings
FROM events GROUP BY 1, 2""")
def streamed_snapshots(tables: Tables) -> DataFrame:
    """The events as a stream of files, one per core for each of four micro-batches, with the state kept between them."""
    spark = tables.spark
    at_once = spark.sparkContext.defaultParallelism
    arriving, store, progress = (new_folder(spark, name) for name in ("arriving", "snapshots", "progress"))
    tables.events.repartition(4 * at_once, "event_id").write.parquet(arriving)
    before = spark.conf.get(streamed.STATE_STORE[0], None)
    spark.conf.set(*streamed.STATE_STORE)
    try:
        rows = spark.readStream.schema(tables.events.schema).option("maxFilesPerTrigger", at_once).parquet(arriving)
        named = rows.select(F.col("ts").alias("posted_at"), F.col("event_type").alias("skill_idx"),
                            F.col("user_id").alias("employer"), F.col("event_id").alias("posting"))
        drained = streamed.file_snapshots(named, store, progress, "week").trigger(availableNow=True).start()
        drained.awaitTermination()
    finally:
        if before is None:
            spark.conf.unset(streamed.STATE_STORE[0])
        else:
            spark.conf.set(streamed.STATE_STORE[0], before)
    return streamed.stored_counts(spark, store)
