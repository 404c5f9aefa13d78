"""Benchmark decontamination by a positional inverted index of rare benchmark words."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestep.llm.text import ascii_lower, cased_words
from lodestep.session import stored

#: Words of a window whose posting lists are intersected, the rarest ones.
PROBES = 2


def lower_words(text) -> Column:
    return cased_words(ascii_lower(text))


def benchmark_windows(items: DataFrame, width: int = 10) -> DataFrame:
    """``window_id, words, n`` and ``item_ids``: each distinct window of ``width`` consecutive item words.

    An item of fewer words, but not none, is one window. ``items`` needs ``item_id`` and ``text``.
    """
    words = items.select("item_id", lower_words(F.col("text")).alias("w")).where(F.size("w") > 0)
    last = F.greatest(F.size("w") - width + 1, F.lit(1))
    return words.select("item_id", "w", F.explode(F.sequence(F.lit(1), last)).alias("i")).select(
        "item_id", F.slice("w", F.col("i"), width).alias("words")).groupBy("words").agg(
        F.collect_set("item_id").alias("item_ids")).select(
        F.sha2(F.concat_ws(" ", "words"), 256).alias("window_id"), "words", F.size("words").alias("n"), "item_ids")


def postings(docs: DataFrame, pairs: DataFrame, reach: int) -> DataFrame:
    """``doc_id, text_hash, term, at, around, around_from``: where ``term`` stands with ``other`` at ``delta`` words from it.

    ``pairs`` holds ``term, delta, other``: of the two lists, the other's shifted by ``delta``, only the intersection
    leaves the scan, as the text's own words are at hand there. ``delta`` 0 takes all of ``term``'s list. ``at``
    counts words from 1. ``around`` holds the words within ``reach`` of it, the first of which stands at
    ``around_from``; case as in the text. A row is known by its id and the hash of its text.

    Terms are compared in full lower case, which finds all that A-Z lower-casing finds and more; what
    is compared later is exact. ``pairs`` follows the benchmark, not the documents; Catalyst broadcasts it if its
    stored size is below the session's threshold and else joins by shuffle.
    """
    words = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), cased_words(F.col("text")).alias("w"))
    # The outer form: Catalyst adds a filter to the plain one that would tokenise each text twice.
    flat = words.select("doc_id", "text_hash", "w", F.posexplode_outer("w").alias("i", "word")).withColumn(
        "here", F.lower("word"))
    there = F.lower(F.get(F.col("w"), F.col("i") + pairs["delta"]))
    hit = flat.join(pairs, (F.col("here") == pairs["term"]) & (there == pairs["other"]), "left_semi")
    first = F.greatest(F.col("i") + 1 - reach, F.lit(1))
    return hit.select("doc_id", "text_hash", F.col("here").alias("term"), (F.col("i") + 1).alias("at"),
                      F.slice("w", first, F.col("i") + 2 + reach - first).alias("around"), first.alias("around_from"))


def probes(windows: DataFrame, docs: DataFrame, count: int = PROBES) -> DataFrame:
    """``window_id, term, offset, rank``: the ``count`` rarest words of each window, by their number in all texts."""
    flat = windows.select("window_id", F.posexplode("words").alias("offset", "word")).withColumn("term", F.lower("word"))
    vocabulary = stored(flat.select("term").distinct(), "vocabulary")
    corpus = docs.select(F.explode_outer(cased_words(F.col("text"))).alias("word")).select(F.lower("word").alias("term"))
    counts = corpus.join(vocabulary, "term", "left_semi").groupBy("term").agg(F.count("*").alias("n"))
    rarest = Window.partitionBy("window_id").orderBy(F.coalesce("n", F.lit(0)), "offset")
    return flat.join(counts, "term", "left").withColumn("rank", F.row_number().over(rarest)).where(
        F.col("rank") <= count).select("window_id", "term", "offset", "rank")


def phrase_matches(docs: DataFrame, items: DataFrame, width: int = 10) -> DataFrame:
    """``doc_id, text_hash, start, n, item_ids``: each exact occurrence of a benchmark window, words from 1.

    The lists of a window's two rarest words, the second shifted by its distance from the first, are intersected;
    what both lists agree on is compared word by word with the text kept around the rarest word.
    """
    windows = stored(benchmark_windows(items, width), "windows")
    rank = F.struct("rank", "offset", "term")
    pair = probes(windows, docs, PROBES).groupBy("window_id").agg(
        F.min(rank).alias("first"), F.max(rank).alias("last")).select(
        "window_id", F.col("first.term").alias("term"), F.col("first.offset").alias("offset"),
        (F.col("last.offset") - F.col("first.offset")).alias("delta"), F.col("last.term").alias("other"))
    probe = stored(windows.join(pair, "window_id"), "probes")
    pairs = stored(probe.select("term", "delta", "other").distinct().coalesce(1), "pairs")
    index = stored(postings(docs, pairs, width - 1), "postings")
    start = F.col("at") - F.col("offset")
    here = F.slice("around", F.greatest(start - F.col("around_from") + 1, F.lit(1)), F.col("n"))
    return index.join(probe, "term").where(start >= 1).where(F.transform(here, ascii_lower) == F.col("words")).select(
        "doc_id", "text_hash", start.alias("start"), "n", "item_ids")


def proximity_matches(docs: DataFrame, items: DataFrame, width: int = 10, slop: int = 5,
                      probe_count: int = PROBES) -> DataFrame:
    """``doc_id, text_hash, window_id, first_at, last_at``: where a window's rarest words stand near each other.

    Near means in any order within ``width + slop`` words. Both lists are cut into blocks of that length and
    meet in the same or the next block, so no pairs beyond the neighbourhood are made.
    """
    reach = width + slop
    windows = stored(benchmark_windows(items, width), "windows")
    probe = stored(probes(windows, docs, probe_count), "probes")
    pairs = probe.select("term", F.lit(0).alias("delta"), F.col("term").alias("other")).distinct()
    index = stored(postings(docs, stored(pairs, "pairs"), 0), "postings").drop("around", "around_from")
    hits = index.join(probe, "term").withColumn("block", F.floor(F.col("at") / reach))
    key = ["doc_id", "text_hash", "window_id", "block"]
    first = hits.where("rank = 1").withColumn("block", F.explode(F.array(*(F.col("block") + i for i in (-1, 0, 1)))))
    wanted = windows.select("window_id", F.least("n", F.lit(probe_count)).alias("lists"))
    others = hits.where("rank > 1").select(*key, F.col("at").alias("other_at"), "rank")
    near = first.select(*key, "at").join(others, key, "left").where("other_at is null or abs(at - other_at) < " + str(reach))
    return near.groupBy("doc_id", "text_hash", "window_id", "at").agg(
        (1 + F.count_distinct("rank")).alias("seen"), F.min("other_at").alias("low"), F.max("other_at").alias("high"),
    ).join(wanted, "window_id").where("seen = lists").select(
        "doc_id", "text_hash", "window_id", F.least("at", "low").alias("first_at"), F.greatest("at", "high").alias("last_at"))


def contamination(docs: DataFrame, items: DataFrame, width: int = 10) -> DataFrame:
    """Per row of ``docs``: ``doc_id, text_hash, n_words, n_hit, n_items, items_sha256, contaminated``.

    ``n_hit`` counts words inside any occurrence of a window, ``n_items`` items with an occurring window;
    ``items_sha256`` is of their ids as strings, sorted and joined by commas. Null texts have no words. Repeated
    rows get the same result each; other columns are ignored. Null item ids are left out of the lists. Empty tables: no hits.

    Only where a window's two rarest words stand at their distance does a posting leave the scan, with some words of
    context, so what is shuffled follows the true occurrences; a passage in a third of all texts stays spread by document.
    """
    found = phrase_matches(docs, items, width)
    row = ["doc_id", "text_hash"]
    spans = found.groupBy(*row, "start").agg(
        F.max(F.col("start") + F.col("n")).alias("end"), F.flatten(F.collect_set("item_ids")).alias("ids"))
    earlier = Window.partitionBy(*row).orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    fresh = F.col("end") - F.greatest("start", F.coalesce(F.max("end").over(earlier), F.lit(0)))
    ids = F.array_distinct(F.flatten(F.collect_set("ids")))
    hits = spans.withColumn("fresh", F.greatest(fresh, F.lit(0))).groupBy(*row).agg(
        F.sum("fresh").alias("n_hit"), ids.alias("ids")).select(
        F.col("doc_id").alias("hit_id"), F.col("text_hash").alias("hit_hash"), "n_hit",
        F.size("ids").cast("long").alias("n_items"),
        F.array_join(F.array_sort(F.transform("ids", lambda x: x.cast("string"))), ",").alias("joined"))
    n_words = F.size(cased_words(F.col("text"))).cast("long")
    rows = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), n_words.alias("n_words"))
    same = F.col("doc_id").eqNullSafe(F.col("hit_id")) & (F.col("text_hash") == F.col("hit_hash"))
    return rows.join(hits, same, "left").select(
        "doc_id", "text_hash", "n_words", F.coalesce("n_hit", F.lit(0)).alias("n_hit"),
        F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"),
        F.sha2(F.coalesce("joined", F.lit("")), 256).alias("items_sha256"),
        (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"))


def decontaminate(docs: DataFrame, items: DataFrame, width: int = 10) -> DataFrame:
    """The rows of ``docs`` without an occurrence of a benchmark window; columns as they were."""
    dirty = stored(contamination(docs, items, width).where("contaminated").select(
        F.col("doc_id").alias("dirty_id"), F.col("text_hash").alias("dirty_hash")).distinct(), "contaminated")
    same = docs["doc_id"].eqNullSafe(dirty["dirty_id"]) & (F.xxhash64(docs["text"]) == dirty["dirty_hash"])
    return docs.join(dirty, same, "left_anti")
