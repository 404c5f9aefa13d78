import random
import re
import time

import pytest
from pyspark.sql import functions as F

from lodestep.functions import depth, fixed_values as fixed, syllabus, text
from lodestep.functions.taxonomy import TAXONOMY, Entry, alias_grams, alias_pattern, folded, kept_entries
from lodestep.operators.tagging import named_entries, taxonomy_table


def test_norm(values):
    got = values(text.norm, ["  Big\t\nData ;", "C++.", " - a: ", "É  X"])
    assert got == ["big data", "c++", "a", "é x"]


def test_strip_paren(values):
    assert values(text.strip_paren, ["Python (computer programming)", "a (b) c (d)", "x (y"]) == ["python", "a c", "x (y"]


def test_employer_key(values):
    got = values(text.employer_key, ["Acme Pvt. Ltd.", "Pvt Ltd", "Smith & Co", "Cologne GmbH", "Zürich Inc"])
    assert got == ["acme", "", "smith &", "cologne", "z rich"]


def test_to_number(values):
    got = values(text.to_number, ["3", "3 yrs", " 1e1 ", "1d", "nan", "", None, "-inf", ".5"])
    assert got == [3.0, None, 10.0, None, None, None, None, float("-inf"), 0.5]


def test_split_list(values):
    assert values(text.split_list, ["a, b ,,c ", " ,", ""]) == [["a", "b", "c"], [], []]


def test_fingerprint_ignores_skill_order(spark):
    rows = spark.createDataFrame([("T", "b, A", "x."), ("t ", "a,B", "X")], "t string, s string, d string")
    prints = {r[0] for r in rows.select(text.fingerprint(F.col("t"), F.col("s"), F.col("d"))).collect()}
    assert prints == {"t | a,b | x"}


def test_slug_and_id(values):
    assert values(text.slug, ["HTML & CSS", "--C++"]) == ["html_css", "c"]
    assert values(text.dictionary_id, ["x"]) == ["esco_11f6ad8ec52a2984"]


def test_split_topics(values):
    got = values(syllabus.split_topics, [
        "Arrays, stacks (push, pop); queues", "Unit 1: Recursion", "a, b", "x) one, two (p [q, r), s] t, u)), four • five",
        "Experiment 3 - Sorting, [a; b", ""])
    assert got == [["Arrays", "stacks (push, pop)", "queues"], ["Recursion"], ["a, b"],
                   ["x) one", "two (p [q, r), s] t", "u))", "four", "five"], ["Sorting", "[a; b"], [""]]


def _topics_by_hand(body):
    parts, level, start = [], 0, 0
    for place, char in enumerate(body):
        level = level + 1 if char in "([" else max(0, level - 1) if char in ")]" else level
        if char in ",;•" and not level:
            parts.append(body[start:place])
            start = place + 1
    parts.append(body[start:])
    trimmed = [re.sub(fixed.TOPIC_PREFIX, "", p.strip(), flags=re.I).strip(" -:,.\t") for p in parts]
    return [p for p in trimmed if len(p) >= 3] or [body]


def test_split_topics_against_scan(values):
    import random
    rng = random.Random(1)
    bodies = ["".join(rng.choice("ab c,;()[]•-:") for _ in range(rng.randrange(1, 60))) for _ in range(300)]
    assert values(syllabus.split_topics, bodies) == [_topics_by_hand(b) for b in bodies]


def test_header(spark):
    rows = [["Unit", "Topics", "CO-BT", "Hours"], ["Sr", "Experiment Name", "l"], ["Unit", "x"],
            ["Hours", "unit no", "Contents", "Unit 2", "Lectures"]]
    got = [r[0] for r in spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "i int, c array<string>")
           .orderBy("i").select(syllabus.detected_header(F.col("c"))).collect()]
    assert tuple(got[0]) == (1, 4, "theory", 0, 2, 3)
    assert tuple(got[1]) == (1, 3, "practical", None, None, 2)
    assert got[2] is None
    assert tuple(got[3]) == (2, 5, "theory", 1, None, 4)


@pytest.mark.parametrize("doc, page, ok, reason", [
    ("23CSH-101.pdf", "Course Name Programming Course Code 23CSH-101", True, "Core course: 'Programming'"),
    ("23MEP-101.pdf", "any", False, "Non-coding subject prefix 'MEP'"),
    ("a.pdf", "Mandatory Non-Graded", False, "Mandatory Non-Graded (MNG)"),
    ("b.pdf", "Course Name Professional\n Ethics Course Code X", False, "Non-core course title: 'Professional Ethics'"),
    ("c.pdf", " \n", False, "Empty PDF"),
])
def test_course_verdict(spark, doc, page, ok, reason):
    row = spark.createDataFrame([(doc, page)], "d string, p string").select(
        syllabus.course_verdict(F.col("p"), F.col("d")).alias("v")).first()["v"]
    assert (row.ok, row.reason) == (ok, reason)


def test_line_fields(values):
    got = values(syllabus.line_fields, ["1 2 Arrays and stacks CO1 - BT3 2 hrs", "Graphs T-1, R-2"])
    assert tuple(got[0]) == ("Arrays and stacks", "CO1 - BT3", 2)
    assert tuple(got[1]) == ("Graphs -2", "", None)   # the first reference takes the R along


def test_depth(values):
    assert values(depth.leading_verb, ["Implement queues", "Using queues", "a b Designed c", "x y z list"]) == [
        "implement", None, "design", None]
    assert values(depth.level_depth, ["CO1-BT2, BT5", "bt 3", "BT1", "", None]) == ["build", "apply", "know", None, None]


def test_inferred_depth(spark):
    rows = spark.createDataFrame([("x", "", "practical"), ("x", "BT6", "theory"), ("Lists", "BT6", "theory"), ("x", "", "theory")],
                                 "f string, b string, k string")
    got = [tuple(r[0]) for r in rows.select(depth.inferred_depth(F.col("f"), F.col("b"), F.col("k"))).collect()]
    assert got == [("implement", "apply"), ("design", "build"), ("list", "know"), ("understand", "know")]


def _named(spark, bodies, taxonomy=TAXONOMY):
    """Names of the entries that the index finds in each text."""
    rows = spark.createDataFrame([(str(i), 0, body) for i, body in enumerate(bodies)], "key string, unit_no int, raw string")
    table = taxonomy_table(spark, taxonomy)
    found = named_entries(rows.select("key", "unit_no", folded(F.col("raw")).alias("low")), table).join(table, "skill_no")
    names = {body: set() for body in bodies}
    for row in found.collect():
        names[bodies[int(row["key"])]].add(row["skill_name"])
    return names


def test_taxonomy_hits(spark):
    bodies = ["C++ classes", "data structures", "full stack", "Trees; decision trees", "heap memory", "HASHMAPS", "schemas", "", "-", "heaps",
              "binary search trees", "binary search", "I/O: input/output", "ſql", "c++s"]
    hits = _named(spark, bodies)
    assert hits["C++ classes"] == {"C++", "Object-oriented programming"}
    assert hits["data structures"] == {"Data structures (general)"}
    assert hits["full stack"] == {"Web development"}
    assert hits["Trees; decision trees"] == {"Trees & tree traversal"}
    assert hits["heap memory"] == hits[""] == hits["-"] == set()
    assert hits["HASHMAPS"] == {"Hashing"}
    assert hits["schemas"] == {"Database design & normalization"}
    assert hits["heaps"] == {"Heaps & priority queues"}
    assert hits["binary search trees"] == {"Binary search trees", "Trees & tree traversal"} and hits["binary search"] == {"Searching algorithms"}
    assert hits["I/O: input/output"] == {"Console input/output"} and hits["ſql"] == {"SQL"} and hits["c++s"] == {"C++"}


def test_index_equals_patterns(spark):
    """Random texts of the aliases' own words: the index finds what the patterns find, tried one by one."""
    rng = random.Random(4)
    extra = [Entry("x", "Dot net", "", [".net"]), Entry("x", "Grouped", "", ["re:a(b|c)+"]), Entry("x", "Sharp", "", ["c#", "f# code"])]
    taxonomy = TAXONOMY + extra
    words = [w for e in taxonomy for a in e.aliases if not a.startswith("re:") for w in a.split()] + [
        "full", "data", "memory", "decision", "tree", "trees", "heaps", "heap", "structures", "stack", "graph", "s", "es", "abc", "xab"]
    bodies = list({"".join(rng.choice(words) + rng.choice(["", "s", "es"]) + rng.choice([" ", " ", "-", ", ", "/", "+", "  "]) for _ in range(7)) for _ in range(300)})
    found = _named(spark, bodies, taxonomy)
    rows = spark.createDataFrame([(b,) for b in bodies], "b string").select("b", *[
        F.array(*[folded(F.col("b")).rlike(alias_pattern(a)) for a in e.aliases]).alias(f"e{i}") for i, e in enumerate(taxonomy)])
    for row in rows.collect():
        assert found[row["b"]] == {e.name for i, e in enumerate(taxonomy) if any(row[f"e{i}"])}, row["b"]


def test_runs_of_aliases():
    assert alias_grams("Big O") == ["big o", "big os", "big oes"]
    assert alias_grams("re:(?<!memory )heaps?(?! memory)") == ["heap", "heaps"] and alias_grams("re:binary search(?! trees?)") == ["binary search"]
    assert alias_grams("re:a(b|c)+") is None and alias_grams(".net") is None


def test_taxonomy_shape():
    assert len(TAXONOMY) == len(kept_entries()) == 72
    assert len(kept_entries(categories=["dsa"])) == 12


def test_taxonomy_table(spark):
    rows = {r["skill_name"]: r for r in taxonomy_table(spark).collect()}
    assert len(rows) == 72 and rows["HTML & CSS"]["skill_id"] == "cs_html_css" and rows["Stacks"]["sem_text"] == "Stacks: "
    long = taxonomy_table(spark, [Entry("c", "N", "", ["x" * 150, "y" * 150])]).first()["sem_text"]
    assert long == "N: " + "x" * 150 + ", " + "y" * 48


def test_long_bracketed_topics_in_linear_time(spark):
    """A million characters take about ten times as long as a hundred thousand, and the parts are those of a plain scan."""
    def plain(body):
        depth, parts = 0, [""]
        for char in body:
            if depth == 0 and char in ",;•":
                parts.append("")
                continue
            depth = depth + 1 if char in "([" else max(0, depth - 1) if char in ")]" else depth
            parts[-1] += char
        kept = [p for p in (p.strip().strip(" -:,.\t") for p in parts) if len(p) >= 3]
        return kept or [body]
    rng = random.Random(8)
    for length in (0, 1, 5, 300, 5_000, 30_000):
        body = "".join(rng.choice(["ab", " ", ",", ";", "(", ")", "[", "]", "•", "topic "]) for _ in range(length)) + "(,"
        rows = spark.createDataFrame([(body,)], "t string")
        assert rows.select(syllabus.split_topics(F.col("t"))).first()[0] == plain(body)

    def seconds(length):
        body = "a (b, c), " * (length // 10)
        rows = spark.createDataFrame([(body,)], "t string")
        begun = time.perf_counter()
        assert rows.select(F.size(syllabus.split_topics(F.col("t")))).first()[0] == length // 10
        return time.perf_counter() - begun
    seconds(1_000)
    short, long = seconds(100_000), seconds(1_000_000)
    assert short < 5 and long < 20 * max(short, 0.5)
