"""Mixing sources to target weights: hash order, distributed prefix sums, a cut at each budget."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestep.llm.text import free_name, spaced_words
from lodestep.session import cut_lineage, stored

#: Hexadecimal digits of the key that name a range: 4,096 ranges in each source.
RANGE_DIGITS = 3


def hash_key(doc_id, seed: int) -> Column:
    """Where a document stands in its source: the same in each run, unrelated to the id."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))))


def source_key(source) -> Column:
    """Never null, so that it can be joined and grouped like any key."""
    return F.when(source.isNull(), "n").otherwise(F.concat(F.lit("s"), source.cast("string")))


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = (1, 2, 3), max_epochs: int = 3) -> DataFrame:
    """``source, source_size`` -> with ``target``: words each source contributes.

    The k-th source by code point, null last, has the k-th weight, in turn. The sources share the sum
    of all sizes by weight, but none more than ``max_epochs`` times its size; what is above goes to the
    others by weight until none is above. In order of cap / weight the capped sources come first, so
    the final share per weight is the largest of the shares that follow from capping 0, 1, 2, ... of them.
    One row per source; texts are not touched. An empty table gives an empty one.
    """
    everything = Window.partitionBy()
    by_name = Window.orderBy(F.col("source").isNull(), "source")
    by_cap = Window.orderBy(F.col("cap") / F.col("weight"), "place")
    ranked = sizes.withColumn("place", F.row_number().over(by_name)).withColumns({
        "weight": F.element_at(F.array(*map(F.lit, weights)), ((F.col("place") - 1) % len(weights) + 1).cast("int")),
        "cap": F.col("source_size") * max_epochs,
        "total": F.sum("source_size").over(everything),
    })
    level = (F.col("total") - F.coalesce(F.sum("cap").over(by_cap.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
             ).cast("double") / F.sum("weight").over(by_cap.rowsBetween(0, Window.unboundedFollowing)).cast("double")
    levelled = ranked.withColumn("level", level).withColumn("level", F.max("level").over(everything))
    return levelled.select("source", "source_size",
                           F.least(F.col("cap").cast("double"), F.col("weight") * F.col("level")).alias("target"))


def mix_sizes(docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), max_epochs: int = 3, seed: int = 1,
              ) -> DataFrame:
    """Per row: ``doc_id, size, source, source_size, target, taken`` and ``source_key, key, start, spare``.

    ``docs`` needs ``doc_id``, ``text`` and ``source``; other columns are ignored. In a source, rows
    stand in the order of a hash of the id. Each source is repeated as long as a whole copy fits its
    target; of the last copy it gives its first ``spare`` words in that order, so what all rows of a source
    take is its target rounded down. ``start`` is the number of words before the row.

    Null texts have size 0, null sources are a source, null ids are allowed. Rows with the same id
    and size may swap places, which leaves the same rows. The prefix sum has two levels: ranges of the hash, then
    rows in a range, so a source with any share of the rows is spread over thousands of ranges.
    """
    narrow = cut_lineage(docs.select(
        "doc_id", "source", source_key(F.col("source")).alias("source_key"), hash_key(F.col("doc_id"), seed).alias("key"),
        F.size(spaced_words(F.col("text"))).cast("long").alias("size"),
    ).withColumn("range", F.substring("key", 1, RANGE_DIGITS)))
    ranges = narrow.groupBy("source_key", "source", "range").agg(F.sum("size").alias("range_size"))
    sizes = ranges.groupBy("source").agg(F.sum("range_size").alias("source_size"))
    targets = source_targets(sizes, weights, max_epochs).select(
        source_key(F.col("source")).alias("source_key"), "source_size", "target")
    before = Window.partitionBy("source_key").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = ranges.withColumn("offset", F.coalesce(F.sum("range_size").over(before), F.lit(0))).select(
        "source_key", "range", "offset").join(targets, "source_key")
    inside = Window.partitionBy("source_key", "range").orderBy("key", "doc_id", "size").rowsBetween(
        Window.unboundedPreceding, -1)
    budget = F.floor("target")
    epochs = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(0)
    return narrow.join(offsets, ["source_key", "range"]).withColumns({
        "start": F.col("offset") + F.coalesce(F.sum("size").over(inside), F.lit(0)),
        "epochs": epochs.cast("long"),
    }).withColumn("spare", budget - F.col("epochs") * F.col("source_size")).withColumn(
        "taken", F.col("epochs") * F.col("size")
        + F.greatest(F.lit(0), F.least(F.col("size"), F.col("spare") - F.col("start")))).drop("range", "offset")


def mix(docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), max_epochs: int = 3, seed: int = 1) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it; columns as they were.

    Documents stay whole: of the last copy of a source, those whose middle lies within the budget are taken, so a
    source misses its target by half a document at most (more where rows share an id: they are taken
    together). A source's cut is one key, so texts are neither shuffled nor sorted. Rows without words stay once.
    """
    cuts = stored(mix_sizes(docs, weights, max_epochs, seed).groupBy("source_key").agg(
        F.max("epochs").alias("epochs"),
        F.max(F.when(F.col("start") + F.col("size") / 2 < F.col("spare"), F.col("key"))).alias("cut")))
    source, key, copies, epochs, cut = (free_name(docs, name) for name in (
        "mix_source", "mix_key", "mix_copy", "mix_epochs", "mix_cut"))
    cuts = cuts.select(F.col("source_key").alias(source), F.col("epochs").alias(epochs), F.col("cut").alias(cut))
    empty = F.size(spaced_words(F.col("text"))) == 0
    times = F.when(empty, 1).otherwise(
        F.col(epochs) + F.when(F.col(key) <= F.col(cut), 1).otherwise(0)).cast("int")
    keyed = docs.withColumns({source: source_key(F.col("source")), key: hash_key(F.col("doc_id"), seed)})
    return keyed.join(cuts, source).withColumn(
        copies, F.explode(F.when(times > 0, F.array_repeat(F.lit(1), times)).otherwise(F.array().cast("array<int>")))
    ).select(*[f"`{name}`" for name in docs.columns])
