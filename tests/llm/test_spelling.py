"""Spelling variants against comparisons of all pairs."""

import random
import re
import zlib
from collections import Counter

import pytest

from lodestep.llm import queries, spelling


def near(a, b):
    """Exactly one inserted, deleted or replaced letter, tried out."""
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return any(long[:i] + long[i + 1:] == short for i in range(len(long)))


def brute_counts(rows):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-z\u00C0-\u00FF]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            counts[run if h % 199 else run[:h % len(run)] + run[h % len(run) + 1:]] += 1
    return {word: n for word, n in counts.items() if len(word) >= 6 and n >= 5}


def neighbours(counts):
    """Near words by deleting letters: two words are near only if they share a form with at most one letter less."""
    homes = {}
    for word in counts:
        for form in {word, *(word[:i] + word[i + 1:] for i in range(len(word)))}:
            homes.setdefault(form, set()).add(word)
    links = {word: set() for word in counts}
    for group in homes.values():
        for a in group:
            links[a] |= {b for b in group if b not in links[a] and near(a, b)}
    return links


def brute(rows):
    counts = brute_counts(rows)
    links, form = neighbours(counts), {}
    for word, n in counts.items():
        best = min(links[word], key=lambda w: (-counts[w], w), default=None)
        form[word] = best if best and counts[best] >= 5 * n else None

    def root(word):
        return word if form[word] is None else root(form[word])
    return {(w, form[w], root(w), n, len(links[w]), counts.get(form[w])) for w, n in counts.items()}


def result(frame):
    return {(r["word"], r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in frame.collect()}


def test_query_on_whole_small_tables(spark, data):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{data}/documents.parquet").collect()]
    want = brute(rows)
    assert result(queries.op12_spelling(spark, data)) == want and any(w[1] for w in want)


@pytest.mark.parametrize("letters, longest", [("ab", 9), ("abcdé", 8), ("xyz", 12)])
def test_pairs_of_dense_vocabularies(spark, letters, longest):
    rng = random.Random(longest)
    words = {"".join(rng.choice(letters) for _ in range(rng.randrange(6, longest + 1))) for _ in range(250)}
    counts = {word: rng.randrange(5, 60) for word in words}
    frame = spark.createDataFrame(list(counts.items()), "word string, n long")
    pairs = [(r["word"], r["near"]) for r in spelling.near_pairs(frame).collect()]
    want = {frozenset((a, b)) for a in words for b in words if near(a, b)}
    assert len(pairs) == len(want) and {frozenset(p) for p in pairs} == want
    summary = {r["word"]: (r["n_near"], r["best"], r["best_n"]) for r in spelling.near_summary(frame).collect()}
    links = {w: [v for v in words if near(w, v)] for w in words}
    assert summary == {w: (len(v), min(v, key=lambda x: (-counts[x], x)), max(counts[x] for x in v)) for w, v in links.items() if v}


def test_acceptor_is_minimal_and_numbers_words():
    words = sorted({"tap", "taps", "top", "tops", "map", "maps", "s"})
    acceptor = spelling.Acceptor(words)
    live, todo = set(), [0]
    while todo:
        state = todo.pop()
        if state not in live:
            live.add(state)
            todo += acceptor.moves[state].values()
    assert len(live) == 6 and acceptor.size[0] == len(words)   # start, t, m, one for ta, to and ma, one after p, end

    def number(word):
        state, at = 0, 0
        for letter in word:
            state, at = next((to, at + before) for x, to, before in acceptor.numbered(state) if x == letter)
        return at
    assert [number(word) for word in words] == list(range(len(words)))


def test_odd_rows(spark, docs_of, none):
    long = "q" * 30_000
    rows = [(i, f"{long} {long}x Straße STRASSE naïve", "en", "a") for i in range(6)] + [(None, "Straße", None, None)] * 3
    rows += [(9, None, "en", "a"), (9, "", "en", "a"), (10, "word " * 5, "en", "a"), (11, "naïve×naïve÷naïve \u212aelvin " * 9, "en", "a")]
    docs = docs_of(rows, clash=("word", "n", "key", "half"))
    assert result(spelling.spelling_variants(docs)) == brute([(r[0], r[1]) for r in rows])
    assert result(spelling.spelling_variants(none)) == set()


def test_roots_follow_chains(spark):
    forms = spark.createDataFrame([(f"w{i}", f"w{i + 1}") for i in range(11)], "word string, form string")
    assert {r["root"] for r in spelling.roots(forms).collect()} == {"w11"}


def test_short_words_are_refused(spark, none):
    with pytest.raises(ValueError):
        spelling.spelling_variants(none, least_length=3)
