import hashlib
import os
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lodestep.functions import fixed_values as fixed
from lodestep.functions.taxonomy import Entry
from lodestep.operators import chunks, demand, dictionary, filters, gap, nearest, rollup, tagging, trend
from lodestep.operators.carry import carry_forward
from lodestep.operators.ordered import in_ranges, numbered

ENTRIES = [
    (1, "u1", "Python (computer programming)", "Python 3\nCPython"), (2, "u2", "algorithms", "data structures"),
    (3, "u3", "natural language processing", "NLP"), (4, "u4", "principles of artificial intelligence", "machine learning"),
    (5, "u5", "machine learning", None),
]


@pytest.fixture(scope="module")
def entries(spark):
    return spark.createDataFrame(ENTRIES, "skill_idx int, uri string, label string, alt_labels string")


def test_forms_and_aliases(spark, entries):
    forms = dictionary.with_aliases(dictionary.surface_forms(entries), dictionary.alias_table(spark))
    got = {r["form"]: r["skill_idx"] for r in forms.collect()}
    assert forms.count() == len(got)
    assert got["python"] == got["cpython"] == got["python (computer programming)"] == 1
    assert got["machine learning"] == got["ml"] == got["ai"] == 4   # the first row keeps the form
    assert got["dsa"] == got["data structures"] == 2
    assert "js" not in got                                          # its target is no label here


def test_links_first_label_then_last_case(spark):
    rows = [(1, "a1", "Label"), (2, "a2", "Label"), (3, "a3", "LABEL"), (4, "", "x")]
    links = dictionary.linked_labels(spark.createDataFrame(rows, "skill_idx int, uri string, label string"))
    got = {r["label_key"]: (r["dictionary_id"], r["dictionary_name"]) for r in links.collect()}
    assert got["label"] == ("esco_" + hashlib.sha1(b"a3").hexdigest()[:16], "LABEL")
    assert got["x"][0] == "esco_" + hashlib.sha1(b"x").hexdigest()[:16]


@pytest.mark.parametrize("exp_min, exp_text, kept", [
    (2.0, "fresher", False), (None, "0-2 years", True), (None, "EN", True), (0.0, "", True), (None, "mid", False),
    (None, "Entry level", True), (float("-inf"), "", True),
])
def test_entry_level(spark, exp_min, exp_text, kept):
    rows = spark.createDataFrame([(exp_min, exp_text)], "exp_min double, exp_text string")
    assert filters.entry_level(rows).count() == kept


@pytest.mark.parametrize("title, kept", [
    ("Python Developer", True), ("Senior Developer", False), ("Maintenance Technician", False),
    ("HR Software Executive", False), ("AI intern", True), ("Full-stack dev", True),
])
def test_coding_titles(spark, title, kept):
    assert filters.coding_titles(spark.createDataFrame([(title,)], "title string")).count() == kept


def test_vague_and_short_skills(values):
    assert values(filters.is_specific_skill, ["C", "R", " Data. ", "N/A", "Go", "problem  solving"]) == [
        False, False, False, False, True, False]


GOLDEN = [  # label, employers, postings, estimate, band, depth
    ("machine learning", 256, 297, 395, [336, 454], "build"), ("statistics", 242, 547, 315, [268, 362], "build"),
    ("SQL", 152, 622, 198, [168, 228], "apply"), ("data science", 106, 114, 111, [94, 128], "build"),
    ("digital marketing techniques", 11, 12, 12, [10, 14], "apply"),
    ("execute integration testing", 4, 5, 4, [3, 5], "build"),
]


def test_golden_bands_and_depths(spark):
    rows = spark.createDataFrame([(label, est) for label, _, _, est, _, _ in GOLDEN], "label string, est int")
    got = {r[0]: (r[1], r[2]) for r in rows.select(
        "label", demand.estimate_band(F.col("est")), demand.demand_depth(F.col("label"), F.lit(0.0), F.lit(0.0))).collect()}
    assert got == {label: (band, depth) for label, _, _, _, band, depth in GOLDEN}


def test_estimates_round_half_to_even(values):
    assert values(lambda v: demand.estimate(v, F.lit(0.5)), [1, 3, 5, 7], "int") == [0, 2, 2, 4]
    assert values(lambda v: demand.estimate(v, F.lit(fixed.STEADY_MULTIPLIER)), [106, 11], "int") == [111, 12]


def test_word_match_option(spark):
    rows = spark.createDataFrame([("digital marketing",), ("git",)], "label string")
    words = [r[0] for r in rows.select(demand.demand_depth(F.col("label"), F.lit(1.0), F.lit(0.0), match="word")).collect()]
    assert words == ["build", "apply"]


def test_threshold_and_ladder(spark):
    rows = [(f"p{i}", f"e{i % 7}", "Software Engineer", i % 3, "exact") for i in range(40)]
    base = demand.employer_skill_counts(spark.createDataFrame(
        rows, "posting string, employer string, title string, skill_idx int, how string"))
    assert {r["k"] for r in demand.verified_skills(base).collect()} == {3}
    assert demand.verified_skills(base, forced_k=8).count() == 0
    assert {r["k"] for r in demand.verified_skills(base, forced_k=0).collect()} == {3}
    ladder = [r["survivors"] for r in demand.survival_ladder(demand.skill_counts(base)).orderBy("k").collect()]
    assert ladder == sorted(ladder, reverse=True) and len(ladder) == len(fixed.SURVIVAL_STEPS)
    assert [r[0] for r in spark.range(1).select(demand.auto_threshold(F.lit(801))).collect()] == [5]


def test_carry_forward_in_ranges(spark):
    rng = random.Random(3)
    rows = [("hot" if rng.random() < 0.7 else "cold", page, line, rng.choice([None, None, None, page * 10 + line]))
            for page in range(40) for line in range(3)]
    frame = spark.createDataFrame(rows, "doc string, page int, line int, v int").repartition(5)
    got = {(r["doc"], r["page"], r["line"]): r["last"] for r in carry_forward(
        frame, "doc", ["page", "line"], {"last": F.col("v")}).collect()}
    last = {}
    for doc, page, line, v in rows:
        last[doc] = v if v is not None else last.get(doc)
        assert got[doc, page, line] == last[doc]


def test_one_page_is_spread_over_tasks(spark):
    """A document of one page lies in many ranges of about the same size; values, nulls and a null document pass from one to the next."""
    rows = [(None if i < 500 else "one", 1, i, i if i % 997 == 3 else None) for i in range(8_000)]
    frame = spark.createDataFrame(rows, "doc string, page int, line int, v int").repartition(8)
    sizes = [r["count"] for r in in_ranges(frame.filter("doc = 'one'"), "doc", "page", "line").groupBy("_range").count().collect()]
    assert len(sizes) == 8 and max(sizes) < 2_500
    got = {r["line"]: r["last"] for r in carry_forward(frame, "doc", ["page", "line"], {"last": F.col("v")}).collect()}
    last = {}
    for doc, _, line, v in rows:
        last[doc] = v if v is not None else last.get(doc)
        assert got[line] == last[doc]


def test_values_are_computed_once(spark):
    """Finding the ranges runs the plan of the rows once more, but not the columns to carry or those they come from."""
    calls = spark.sparkContext.accumulator(0)

    def seen(v):
        calls.add(1)
        return v

    frame = spark.range(1_000).selectExpr("'d' AS doc", "id AS line", "CASE WHEN id % 7 = 0 THEN id END AS v").repartition(4)
    counted = F.udf(seen, "long").asNondeterministic()
    got = carry_forward(frame, "doc", ["line"], {"last": F.col("w")}, {"w": counted("v")})
    assert {(r["line"], r["last"]) for r in got.collect()} == {(i, i - i % 7) for i in range(1_000)}
    assert calls.value == 1_000
    calls.value = 0
    assert carry_forward(frame, "doc", ["line"], {"last": counted("v")}).count() == 1_000
    assert calls.value == 1_000


def test_numbers_over_ranges(spark):
    rows = [("hot" if i % 5 else None, i * 7 % 9_000) for i in range(9_000)]
    frame = spark.createDataFrame(rows, "k string, o int").repartition(6)
    got = {(r["k"], r["o"]): r["place"] for r in numbered(frame, "k", "o").collect()}
    for key in ("hot", None):
        assert [got[key, o] for o in sorted(o for k, o in rows if k == key)] == list(range(1, sum(k == key for k, _ in rows) + 1))


def test_ranges_take_little_disk(spark):
    """What lies between the steps is compressed: rows that repeat long values take far less room than the values."""
    root = spark.sparkContext.getCheckpointDir().removeprefix("file:")

    def size():
        return sum(os.path.getsize(os.path.join(path, name)) for path, _, names in os.walk(root) for name in names)

    rows = spark.range(50_000).select(F.lit("d").alias("doc"), "id", F.repeat(F.sha2((F.col("id") % 50).cast("string"), 256), 4).alias("v"))
    before = size()
    assert carry_forward(rows, "doc", ["id"], {"last": F.col("v")}).filter("last = v").count() == 50_000
    assert size() - before < 2_000_000


def test_sources_of_any_length(spark):
    evidence = spark.range(25_000).select(F.lit("s").alias("skill_id"), F.concat(F.lit("doc"), F.col("id")).alias("source"),
                                          (F.lit(25_000) - F.col("id")).alias("ord"))
    parts = {r["part_no"]: r["sources"] for r in rollup.source_parts(evidence.union(evidence)).collect()}
    assert [len(parts[i]) for i in range(3)] == [10_000, 10_000, 5_000]
    assert parts[0] + parts[1] + parts[2] == [f"doc{i}" for i in reversed(range(25_000))]


def test_records_list_all_sources(spark):
    """More sources than one part holds: the record has them all, in order of first mention."""
    evidence = spark.range(23_000).select(
        F.lit("s").alias("skill_id"), F.lit("S").alias("skill_name"), F.lit("c").alias("category"), F.lit(0.95).alias("confidence"),
        F.lit("alias").alias("match_type"), F.lit("f").alias("fragment"), F.lit("use").alias("verb"), F.lit("apply").alias("depth"),
        F.lit(None).cast("string").alias("unit"), F.lit(1).alias("hours"), F.concat(F.lit("doc"), F.col("id")).alias("source"),
        (F.lit(23_000) - F.col("id")).alias("ord"))
    record = rollup.supply_records(evidence.union(evidence)).first()
    assert record["sources"] == [f"doc{i}" for i in reversed(range(23_000))] and (record["n_sources"], record["n_parts"]) == (23_000, 1)


def test_table_rows(spark):
    rows = [["Unit", "Topics", "CO-BT", "Hours"], ["I", "Linked lists", "CO1-BT2", "3"], ["I", "Queues", "CO1-BT2", "0"],
            ["x", "y"], ["I", "ab", "", ""], ["Sr", "Experiment Name", "l"], ["1", "Implement BFS", ""], [], ["2", None, "1"]]
    frame = spark.createDataFrame([("d", i // 3, 0, i, r) for i, r in enumerate([["early", "row", "of", "four"]] + rows)],
                                  "doc string, page_no int, table_no int, row_no int, cells array<string>")
    got = [(r.raw, r.bt, r.unit, r.hours, r.kind) for r in chunks.table_chunks(frame).orderBy("row_no").collect()]
    assert got == [("Linked lists", "CO1-BT2", "I", 3, "theory"), ("Queues", "CO1-BT2", "I", 1, "theory"),
                   ("Implement BFS", "", None, 2, "practical")]


def test_lesson_lines(spark):
    pages = [("d", 1, "Unit 9\nLecture Plan Preview Unit 1\nUnit - II\n1 2 Arrays and stacks CO1 - BT3 2 hrs\nMission to go"),
             ("d", 2, "Hash tables\nabc\nAssessment Model\nUnit 3\nIgnored line"), ("e", 1, "Never inside a section")]
    got = [(r.raw, r.bt, r.unit, r.hours) for r in chunks.line_chunks(
        spark.createDataFrame(pages, "doc string, page_no int, text string")).orderBy("page_no", "row_no").collect()]
    assert got == [("Unit - II", "", "II", None), ("Arrays and stacks", "CO1 - BT3", "II", 2), ("Hash tables", "", "II", None)]


def test_nearest_blocks_equal_broadcast(spark):
    rng = np.random.default_rng(1)
    matrix, queries = rng.normal(size=(37, 8)), rng.normal(size=(50, 8))
    matrix[5] = matrix[9]
    entry = spark.createDataFrame([(i, row.tolist()) for i, row in enumerate(matrix)], "entry_id long, vector array<double>")
    query = spark.createDataFrame([(i, row.tolist()) for i, row in enumerate(queries)], "query_id long, vector array<double>")
    unit = matrix / np.linalg.norm(matrix, axis=1, keepdims=True)
    scores = queries / np.linalg.norm(queries, axis=1, keepdims=True) @ unit.T
    want = {i: np.argsort(-np.round(row, 12), kind="stable")[:3].tolist() for i, row in enumerate(scores)}
    for size in (1 << 20, 8 * 8 * 10):
        got = {r["query_id"]: list(r["entries"]) for r in nearest.nearest_entries(query, entry, 3, size).collect()}
        assert got == want
    wide = nearest.accepted(nearest.nearest_entries(query, entry), 0.3, 0.0).count()
    assert nearest.accepted(nearest.nearest_entries(query, entry), 0.3, 0.1).count() <= wide
    one = nearest.accepted(nearest.nearest_entries(query, entry.filter("entry_id = 0")), -1.0, 0.5)
    assert one.count() == int((scores[:, 0] + 1 >= 0.5).sum())


def test_nearest_skips_blocks_and_keeps_every_row(spark):
    """Clustered entries: most blocks are never met; null, odd and repeated queries have their rows, the same for any block size."""
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(12, 16))
    matrix = np.repeat(centres, 40, axis=0) + rng.normal(size=(480, 16)) * 0.05
    queries = np.repeat(centres, 10, axis=0) + rng.normal(size=(120, 16)) * 0.05
    entry = spark.createDataFrame([(i, row.tolist()) for i, row in enumerate(matrix)] + [(900, None), (901, [None] * 16), (902, [0.0] * 16)],
                                  "entry_id long, vector array<double>")
    asked = [(i % 50, row.tolist()) for i, row in enumerate(queries)] + [(7, None), (8, [1.0]), (9, [0.0] * 16), (None, [1.0] * 16), (None, [None] * 16)]
    query = spark.createDataFrame(asked, "query_id long, vector array<double>").repartition(3)
    results = []
    for size in (1 << 20, 16 * 8 * 40, 16 * 8 * 7):
        found, visits = nearest.nearest_with_visits(query, entry, 4, size)
        results.append(sorted((r["query_id"] is None, r["query_id"] or 0, list(r["entries"]), [round(x, 9) for x in r["similarities"]]) for r in found.collect()))
        report = visits.first()
        assert report["visited"] <= (report["possible"] if report["n_blocks"] == 1 else report["possible"] // 2)
    assert len(results[0]) == len(asked) and results[0] == results[1] == results[2]
    assert sum(not entries for _, _, entries, _ in results[0]) == 3


EVIDENCE = "skill_id string, skill_name string, category string, confidence double, match_type string, fragment string, " \
           "verb string, depth string, unit string, hours int, source string, ord long"


def test_rollup(spark):
    rows = [("s", "S", "c", 0.95, "alias", "f1", "list", "know", None, None, "b.pdf", 1),
            ("s", "S", "c", 0.95, "alias", "f2", "design", "build", "U2", 2, "a.pdf", 2),
            ("s", "S", "c", 0.97, "semantic", "f1", "use", "apply", "U3", 0, "b.pdf", 3),
            *[("s", "S", "c", 0.6, "semantic", f"g{i}", "use", "apply", None, 1, "c.pdf", 4 + i) for i in range(6)],
            ("t", "T", "b", 0.95, "alias", "h", "use", "apply", None, 0, "a.pdf", 20)]
    records = [r.asDict() for r in rollup.supply_records(spark.createDataFrame(rows, EVIDENCE)).collect()]
    assert [r["skill_id"] for r in records] == ["t", "s"]
    s = records[1]
    assert (s["depth"], s["verb"], s["confidence"], s["match_type"], s["unit"], s["source"]) == (
        "build", "use", 0.97, "semantic", "U3", "b.pdf")
    assert s["hours"] == 8 and s["sources"] == ["b.pdf", "a.pdf", "c.pdf"] and s["n_sources"] == 3
    assert s["evidence"] == ["f1", "f2", "g0", "g1", "g2"] and records[0]["hours"] == 0
    short = rollup.supply_records(spark.createDataFrame(rows, EVIDENCE), part_size=2).collect()
    assert [(r["n_sources"], r["sources"]) for r in short] == [(1, ["a.pdf"]), (3, ["b.pdf", "a.pdf"])]


def test_trends_against_polyfit(spark):
    years = list(range(2018, 2026))
    usage = [0.1, 0.12, 0.11, 0.15, 0.16, 0.2, 0.19, 0.22]
    series = spark.createDataFrame([("a", y, u) for y, u in zip(years, usage)] + [("b", 2018, 0.5), ("b", 2019, 0.4)],
                                   "skill_id string, year int, usage double")
    slope, intercept = np.polyfit(years, usage, 1)
    rest = np.array(usage) - (slope * np.array(years) + intercept)
    mean = np.mean(years)
    half = 2.447 * np.sqrt((rest ** 2).sum() / 6) * np.sqrt(1 + 1 / 8 + (2030 - mean) ** 2 / ((np.array(years) - mean) ** 2).sum())
    got = {r["skill_id"]: r for r in trend.fitted_trends(series, threshold=0.005).collect()}
    assert got["a"]["trend"] == "rising" and got["b"]["trend"] == "fading" and got["b"]["low"] is None
    assert np.allclose([got["a"][k] for k in ("slope", "estimate", "low", "high")],
                       [slope, slope * 2030 + intercept, slope * 2030 + intercept - half, slope * 2030 + intercept + half])
    tested = trend.backtest(series, threshold=0.005)
    assert [tuple(r) for r in tested.collect()] == [("a", "rising", "rising", True)]
    draws = [tuple(r) for r in trend.bootstrap_range(series.filter("skill_id = 'a'")).collect()]
    again = [tuple(r) for r in trend.bootstrap_range(series.filter("skill_id = 'a'").repartition(3)).collect()]
    assert draws[0][1] < slope * 2030 + intercept < draws[0][2] and np.allclose(draws[0][1:], again[0][1:])


def test_keyword_trends_without_a_table(spark):
    """Labels with a keyword get a multiplier from its range, the same whatever the partitions; the others keep nulls."""
    labels = ["Python basics", "PHP", "Cloud", "welding", None]
    verified = spark.createDataFrame([(i, 1_000_000, 1, 0.0, 0.0) for i in range(5)],
                                     "skill_idx long, employers long, postings long, core_builder_share double, junior_share double")
    entries = spark.createDataFrame([(i, f"uri/{i}", label) for i, label in enumerate(labels)], "skill_idx long, uri string, label string")

    def found(rows):
        records = demand.demand_records(rows, entries, keyword_ranges={"rising": (1.35, 1.65), "fading": (0.65, 0.85)})
        return {r["esco_uri"]: (r["trend"], r["trend_2030_estimate"]) for r in records.collect()}
    got = found(verified)
    assert got == found(verified.repartition(3))
    assert [got[f"uri/{i}"][0] for i in range(5)] == ["rising", "fading", "rising", None, None]
    assert all(1_350_000 <= got[f"uri/{i}"][1] < 1_650_000 for i in (0, 2)) and 650_000 <= got["uri/1"][1] < 850_000
    assert got["uri/0"][1] != got["uri/2"][1] and got["uri/3"][1] is None and got["uri/4"][1] is None
    assert all(r["trend"] is None for r in demand.demand_records(verified, entries).collect())


def test_gaps_do_not_fan_out(spark):
    wanted = spark.createDataFrame([("a", "A", 10, "build"), ("b", "B", 4, "apply"), ("c", "C", 7, "apply")],
                                   "skill_id string, skill_name string, distinct_employers int, demand_depth string")
    supply = spark.createDataFrame([("a", "know"), ("a", "apply"), ("c", "build")], "skill_id string, depth string")
    trends = spark.createDataFrame([("a", "rising"), ("b", "steady")], "skill_id string, trend string")
    rows = gap.ranked_gaps(gap.joined_gaps(wanted, supply, trends)).collect()
    assert {r["skill_id"]: (r["taught_depth"], r["depth_gap"]) for r in rows} == {
        "a": ("apply", 1), "b": (None, 2), "c": ("build", -1)}
    assert [r["skill_id"] for r in rows] == ["a", "b", "c"] and len(rows) == 3
    assert rows[0]["priority_score"] == pytest.approx(0.5 * 2 / 3 + 0.3 + 0.2)


def test_sketches_merge_over_months_within_the_error(spark):
    """A hot skill, a rare one, and employers who return every month: merged sketches are near the exact counts, and merging order does not matter."""
    rows = spark.range(60_000).select(
        (F.col("id") % 12).alias("month"), F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("s"), F.col("id") % 5)).alias("skill_idx"),
        F.concat(F.lit("e"), F.col("id") % 7_001).alias("employer"), F.col("id").alias("posting"))
    monthly = demand.employer_sketches(rows, "month")
    merged = {r["skill_idx"]: r for r in demand.merged_sketch_counts(monthly).collect()}
    exact = {r["skill_idx"]: r for r in rows.groupBy("skill_idx").agg(
        F.countDistinct("employer").alias("employers"), F.countDistinct("posting").alias("postings")).collect()}
    assert set(merged) == set(exact)
    for skill, row in exact.items():
        for name in ("employers", "postings"):
            assert abs(merged[skill][name] - row[name]) <= 0.05 * row[name]
    assert {r["skill_idx"]: r["employers"] for r in demand.merged_sketch_counts(demand.employer_sketches(rows)).collect()} == {
        skill: row["employers"] for skill, row in merged.items()}
    by_month = {(r["month"], r["skill_idx"]): r["employers"] for r in demand.merged_sketch_counts(monthly, "month").collect()}
    assert len(by_month) == monthly.count()


def test_word_runs_of_odd_texts(spark, values):
    texts = ["a, b c", " #x\U0001d51e+y  z", "", None, "\u00e9\u0301 a a"]
    assert [sorted(found) for found in values(lambda text: tagging.word_runs(text, 2), texts)] == [
        sorted(found) for found in (["a", "b", "c", "a, b", "b c"], ["#x\U0001d51e+y", "z", "#x\U0001d51e+y  z"], [], [],
                                    ["\u00e9\u0301", "a", "\u00e9\u0301 a", "a a"])]


def test_runs_meet_a_small_index_where_they_are_cut(spark):
    """All runs of all texts were shuffled and sorted to meet a few aliases."""
    texts = spark.createDataFrame([("k", 0, "the cat of the house")], "key string, unit_no int, low string").repartition(4)
    table = tagging.taxonomy_table(spark, [Entry("c", "Cat", "", ["cat", "of the"])])
    named = tagging.named_entries(texts, table)
    plan = named._jdf.queryExecution().executedPlan().toString()
    assert [tuple(r) for r in named.collect()] == [("k", 0, 0)]
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
