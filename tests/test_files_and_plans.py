import json
from unittest.mock import Mock

import pytest
from pyspark.sql import functions as F

from lodestep.operators import dictionary
from lodestep.operators.trend import usage_series
from lodestep.plans.demand_report import demand_report, unique_postings
from lodestep.plans.supply_report import supply_report
from lodestep.session import checkpoint_folder
from lodestep.sources import csv_files, sinks, syllabus_tables
from lodestep.streaming import snapshots

FIRST = '''company_name,job_title,skills_required,job_description,experience_min_yrs
Acme Pvt. Ltd.,Python Developer,"Python, SQL",one,0
Acme,Python Developer,"SQL,Python",One.,0
Confidential,Python Developer,"Python, SQL",two,0
"Beta, ""B"" Inc",Software Engineer,"Python, ML","multi
line",0
too,long,row,x,0,9
short,Python Developer,"Python, SQL"
NA,Python Developer,"Python, SQL",x,0
'''
SECOND = '''employer,title,required_skills,description,years_experience,experience_level
Gamma,Senior Developer,"Python, SQL",x,0,
Delta,Web Developer,"C, R, Data",x,0,
Eps,ML Engineer,"NLP, natural language processing",x,,Fresher
Zeta,Java Developer,"python, sql, kubernetes",x,3 yrs,EN
'''
DICTIONARY = '''conceptUri,preferredLabel,altLabels
u1,Python (computer programming),"Python 3
CPython"
u2,SQL,
u3,natural language processing,NLP
u4,machine learning,
u5,,x
'''


@pytest.fixture
def folder(tmp_path):
    (tmp_path / "jobs").mkdir()
    (tmp_path / "jobs" / "b.csv").write_text(FIRST, encoding="utf-8")
    (tmp_path / "jobs" / "a.csv").write_text(SECOND, encoding="utf-8")
    (tmp_path / "skills.csv").write_text(DICTIONARY, encoding="utf-8")
    return tmp_path


def test_read_postings(spark, folder):
    rows = csv_files.read_postings(spark, str(folder / "jobs")).orderBy("posting").collect()
    assert [r["source"] for r in rows] == ["a.csv"] * 4 + ["b.csv"] * 6
    assert [r["employer"] for r in rows[4:]] == ["Acme Pvt. Ltd.", "Acme", "Confidential", 'Beta, "B" Inc', "short", ""]
    assert rows[7]["description"] == "multi\nline" and rows[8]["description"] == "" and rows[8]["exp_min"] is None
    assert [r["exp_min"] for r in rows[:4]] == [0.0, 0.0, None, None] and rows[2]["exp_text"] == "Fresher"
    assert len({r["posting"] for r in rows}) == 10
    with pytest.raises(FileNotFoundError):
        (folder / "empty").mkdir()
        csv_files.csv_names(spark, str(folder / "empty"))


def test_odd_file_names(spark, tmp_path):
    names = ["a%20b.csv", "plus+sign.csv", "with space.csv", "é 100%.csv"]
    for name in names:
        (tmp_path / name).write_text(SECOND, encoding="utf-8")
    rows = csv_files.read_postings(spark, str(tmp_path)).orderBy("posting").collect()
    assert [r["source"] for r in rows] == [name for name in names for _ in range(4)]


def test_survey(spark, tmp_path):
    (tmp_path / "so_2018.csv").write_text("Country,LanguageWorkedWith\nIndia,C;Python\nPeru,C\n", encoding="utf-8")
    (tmp_path / "so_2021.csv").write_text("Id,Country,LanguageHaveWorkedWith\n1,India,Python;Python\n2,India,NA\n", encoding="utf-8")
    names = {"country": ["Country"], "technologies": ["LanguageHaveWorkedWith", "LanguageWorkedWith"]}
    series = usage_series(csv_files.read_survey(spark, str(tmp_path), names), country="India")
    got = {(r["skill_id"], r["year"]): (r["users"], r["usage"]) for r in series.collect()}
    assert got == {("C", 2018): (1, 1.0), ("Python", 2018): (1, 1.0), ("Python", 2021): (1, 0.5)}


def test_demand_report(spark, folder):
    entries = csv_files.read_dictionary(spark, str(folder / "skills.csv"))
    assert [r["label"] for r in entries.orderBy("skill_idx").collect()][0] == "Python (computer programming)"
    assert entries.count() == 4
    postings = csv_files.read_postings(spark, str(folder / "jobs"))
    records = demand_report(postings, entries, dictionary.alias_table(spark), forced_k=1).collect()
    got = {r["skill_name"]: (r["distinct_employers"], r["postings"], r["demand_depth"], r["trend"]) for r in records}
    # Acme's reworded copy and the placeholder go; Gamma is senior; Delta and Eps lack two skills.
    assert got == {"Python (computer programming)": (3, 3, "build", None), "SQL": (2, 2, "apply", None),
                   "machine learning": (1, 1, "build", None)}
    assert demand_report(postings, entries, dictionary.alias_table(spark)).count() == 1


def test_vectors_map_the_rest(spark, folder):
    entries = csv_files.read_dictionary(spark, str(folder / "skills.csv"))
    postings = csv_files.read_postings(spark, str(folder / "jobs"))
    ids = [r["skill_idx"] for r in entries.orderBy("skill_idx").collect()]
    entry_vectors = spark.createDataFrame([(i, [float(i == j) for j in ids]) for i in ids], "entry_id long, vector array<double>")
    skill_vectors = spark.createDataFrame([("kubernetes", [0.1, 0.0, 0.9, 0.0])], "raw string, vector array<double>")
    names = {r["skill_name"]: r["distinct_employers"] for r in demand_report(
        postings, entries, dictionary.alias_table(spark), 1, skill_vectors=skill_vectors, entry_vectors=entry_vectors).collect()}
    assert names["natural language processing"] == 1


def test_supply_report(spark, folder, tmp_path):
    pages = [("23CSH-101.pdf", 1, "Course Name Programming Course Code 23CSH-101"), ("23MEP-101.pdf", 1, "any"),
             ("x.pdf", 1, "Course Name Data Course Code 1\nLecture Plan Preview\nUnit 4\n1 1 Implement SQL joins CO1-BT3\nGit basics\nTrees T-2")]
    cells = [["Unit", "Topics", "CO-BT", "Hours"], ["I", "Design stacks (push, pop), queues", "CO1-BT2", "3"],
             ["I", "Queues", "CO1-BT5", "0"], ["II", "Something else entirely", "", ""]]
    rows = [("23CSH-101.pdf", 1, 0, i, c) for i, c in enumerate(cells)] + [("23MEP-101.pdf", 1, 0, 0, cells[0]), ("23MEP-101.pdf", 1, 0, 1, cells[1])]
    spark.createDataFrame(pages, syllabus_tables.PAGES).write.parquet(str(tmp_path / "pages"))
    spark.createDataFrame(rows, syllabus_tables.TABLE_ROWS).write.parquet(str(tmp_path / "rows"))
    entries = spark.createDataFrame([(1, "a1", "ALGORITHMS", None), (2, "q", "SQL", None)],
                                    "skill_idx int, uri string, label string, alt_labels string")
    vectors = spark.createDataFrame([("Something else entirely", [0.0, 1.0])], "fragment string, vector array<double>")
    entry_vectors = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.1, 0.9])], "entry_id long, vector array<double>")
    report = supply_report(syllabus_tables.read_pages(spark, str(tmp_path / "pages")),
                           syllabus_tables.read_table_rows(spark, str(tmp_path / "rows")), entries,
                           vectors=vectors, entry_vectors=entry_vectors)
    got = {r["skill_name"]: r for r in report.collect()}
    assert set(got) == {"Stacks", "Queues", "SQL", "Git & version control", "Trees & tree traversal", "C++"}
    assert (got["Queues"]["depth"], got["Queues"]["hours"], got["Queues"]["evidence"]) == ("build", 4, ["queues", "Queues"])
    assert got["Stacks"]["verb"] == "design" and got["Stacks"]["original_topic"] == "Design stacks (push, pop)"
    assert got["SQL"]["depth"] == "apply" and got["SQL"]["unit"] == "4" and got["SQL"]["source"] == "x.pdf"
    assert got["Queues"]["skill_id"] == got["Stacks"]["esco_id"] and got["Stacks"]["esco_name"] == "ALGORITHMS"
    assert got["C++"]["match_type"] == "semantic" and got["C++"]["confidence"] == 0.9939
    plain = supply_report(syllabus_tables.read_pages(spark, str(tmp_path / "pages")),
                          syllabus_tables.read_table_rows(spark, str(tmp_path / "rows")))
    assert {r["skill_id"] for r in plain.collect()} >= {"cs_stacks", "cs_queues"}


def array_of(folder):
    return json.loads("".join(part.read_text(encoding="utf-8") for part in sorted(folder.glob("part-*"))))


def test_sinks(spark, tmp_path):
    rows = spark.createDataFrame([("b", 1, None), ("a", 2, "é")], "name string, n int, note string")
    sinks.write_records(rows, str(tmp_path / "deep" / "lines"))
    assert spark.read.json(str(tmp_path / "deep" / "lines")).count() == 2
    sinks.write_record_array(rows, str(tmp_path / "array"), ["name"])
    assert array_of(tmp_path / "array") == [{"name": "a", "n": 2, "note": "é"}, {"name": "b", "n": 1, "note": None}]
    sinks.write_record_array(rows.limit(0), str(tmp_path / "none"), ["name"])
    assert array_of(tmp_path / "none") == []
    sinks.write_record_array(spark.range(100_500), str(tmp_path / "many"), [F.desc("id")])
    assert [x["id"] for x in array_of(tmp_path / "many")] == list(range(100_499, -1, -1))
    same, seen = sinks.observed(rows, "stage", F.approx_count_distinct("name").alias("names"))
    assert same.count() == 2 and seen.get == {"rows": 2, "names": 2}


PAIRS = "posted_at timestamp, skill_idx int, employer string, posting long"


def test_file_stream_equals_batch(spark, tmp_path):
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    rows = spark.sql("""SELECT timestamp'2024-01-05 00:00:00' + make_interval(0, cast(id % 3 as int)) AS posted_at,
        cast(id % 4 as int) AS skill_idx, 'e' || (id % 5) AS employer, id AS posting FROM range(60)""")
    spark.conf.set(*snapshots.STATE_STORE)

    def drained(part):
        """What is counted after another file has come; every run takes up the state of the one before."""
        part.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema(PAIRS).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
        query = snapshots.file_snapshots(stream, str(tmp_path / "store"), str(tmp_path / "progress")).trigger(availableNow=True).start()
        query.awaitTermination(120)
        return {tuple(r) for r in snapshots.stored_counts(spark, str(tmp_path / "store")).collect()}

    def counted(part):
        return {(r["period"], str(r["skill_idx"]), r["employers"], r["postings"]) for r in snapshots.snapshot_counts(part).collect()}
    early = rows.filter("posting < 30")
    assert drained(early) == counted(early)
    assert drained(rows.filter("posting >= 20")) == counted(rows)   # ten postings come twice
    assert drained(rows.filter("posting % 7 = 0")) == counted(rows)
    spark.conf.unset(snapshots.STATE_STORE[0])
    stream = spark.readStream.schema(PAIRS).parquet(str(tmp_path / "in"))
    live = snapshots.live_counts(stream).writeStream.outputMode("complete").format("memory").queryName("live").trigger(
        availableNow=True).start()
    live.awaitTermination(120)
    assert spark.table("live").count() > 0


def test_stream_state_is_kept_without_python(spark):
    """One call of Python per key made the state many times slower than the rows it counts."""
    stream = spark.readStream.format("rate").load().selectExpr(
        "timestamp AS posted_at", "value % 4 AS skill_idx", "cast(value % 5 AS string) AS employer", "value AS posting")
    plan = snapshots.snapshot_changes(stream)._jdf.queryExecution().analyzed().toString()
    assert "Deduplicate" in plan and "Pandas" not in plan and "Python" not in plan


def test_postings_are_derived_once(spark):
    """The removal of near-duplicates reads postings several times; each reading derived them anew."""
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(len(batch))
            yield batch

    made = spark.createDataFrame([(i, f"Firm {i % 2}", "Coder", f"python, sql {i}", "d") for i in range(6)],
                                 "posting long, employer string, title string, skills string, description string")
    unique = unique_postings(made.mapInPandas(counted, made.schema))
    assert unique.count() == 2 and seen.value == 6   # a changed digit is no other posting


@pytest.mark.parametrize("master, named, warehouse, folder", [
    ("local[8]", None, "file:/here/warehouse", "file:/here/warehouse/lodestep-checkpoints"),
    ("spark://host:7077", "file:/shared", "file:/here/warehouse", "file:/shared"),
    ("spark://host:7077", None, "hdfs://store/warehouse/", "hdfs://store/warehouse/lodestep-checkpoints"),
    ("spark://host:7077", None, "file:/here/warehouse", None)])
def test_checkpoints_never_lie_on_one_machine_of_a_cluster(master, named, warehouse, folder):
    session = Mock()
    session.sparkContext.master, session.sparkContext.getCheckpointDir.return_value = master, None
    session.conf.get = lambda name, *default: warehouse if name == "spark.sql.warehouse.dir" else named
    if folder is None:
        with pytest.raises(ValueError):
            checkpoint_folder(session)
    else:
        assert checkpoint_folder(session) == folder
