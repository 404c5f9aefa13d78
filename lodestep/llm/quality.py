"""Quality rules: exact counts per text, and how far its histograms are from its language's."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestep.llm.text import spaced_words
from lodestep.session import stored

# Frequent words per language, whose shares are compared. Other languages share one reference.
COMMON_WORDS = {
    "en": ("the", "of", "and", "to", "in", "a", "is", "that", "it", "for", "was", "on"),
    "de": ("der", "die", "und", "in", "den", "von", "zu", "das", "mit", "sich", "des", "auf"),
    "fr": ("de", "la", "le", "et", "les", "des", "en", "un", "du", "une", "que", "est"),
    "es": ("de", "la", "que", "el", "en", "y", "a", "los", "se", "del", "las", "un"),
}
OTHER = "other"
SYMBOLS = "[#*$%&|<>]"
#: Kept characters of the histogram; what is left of a text is lower-case letters, mostly.
COUNTED = r"[^A-Z0-9#*$%&|<>.,;:!?'\"()\-]+"
WINDOW = 5
#: Shares of a histogram are rounded to so many places for the references, so their counts stay small.
PLACES = 3
#: A reference is the mean of these quantiles, the middle third, of each bin's shares.
MIDDLE = (0.35, 0.4, 0.45, 0.5, 0.55, 0.6, 0.65)


def _matches(text, pattern: str) -> Column:
    """How many single characters match; splitting is several times faster than extracting."""
    return (F.size(F.split(text, pattern)) - 1).cast("long")


def _one_of(*words: str):
    return lambda w: w.isin(*words, *(word.capitalize() for word in words))


def _repeated_starts(ordered) -> Column:
    """Where windows stand that occur twice or more; ``ordered`` holds all by hash, so equal ones are neighbours."""
    size = F.size(ordered)
    twice = F.filter(ordered, lambda x, i: F.coalesce((i > 0) & (F.get(ordered, i - 1)["hash"] == x["hash"]), F.lit(False))
                     | F.coalesce((i < size - 1) & (F.get(ordered, i + 1)["hash"] == x["hash"]), F.lit(False)))
    return F.array_sort(F.transform(twice, lambda x: x["at"]))


def text_features(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``text_hash``, exact counts and histograms per row, without any shuffle.

    ``n_words``, ``word_chars`` (code points in words), ``n_symbols``, ``n_dup_lines`` (lines with a word
    that equal an earlier one), ``n_repeat_words`` (words in windows of five that occur twice or more),
    ``group`` (the language whose reference applies), ``char_bins`` (A-Z, digits, symbols,
    punctuation, space, rest) and ``word_bins`` (each common word of the group). Null texts count as empty.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    group = F.when(F.col("lang").isin(*COMMON_WORDS), F.col("lang")).otherwise(OTHER)
    base = docs.select("doc_id", group.alias("group"), text.alias("text"), spaced_words(text).alias("words"))
    n = F.size("words")
    base = base.withColumns({
        "n_words": n.cast("long"),
        "hashes": F.when(n >= WINDOW, F.transform(F.sequence(F.lit(1), F.greatest(n - WINDOW + 1, F.lit(1))),
                                                  lambda i: F.xxhash64(F.slice("words", i, WINDOW)))),
        "lines": F.filter(F.split("text", "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]")),
        "counted": F.regexp_replace("text", COUNTED, ""),
        "word_chars": F.length(F.array_join("words", "")).cast("long"),
        "n_chars_seen": F.length("text").cast("long"),
    })
    repeats = F.size(F.array_distinct("hashes")) < F.size("hashes")
    base = base.withColumn("ordered", F.when(repeats, F.array_sort(F.transform(
        "hashes", lambda h, i: F.struct(h.alias("hash"), i.alias("at"))))))
    base = base.withColumn("places", F.when(F.col("ordered").isNotNull(), _repeated_starts(F.col("ordered"))))
    places = F.col("places")
    covered = F.aggregate(
        F.transform(places, lambda p, i: F.least(F.lit(WINDOW), F.coalesce(F.get(places, i + 1) - p, F.lit(WINDOW)))),
        F.lit(0), lambda a, x: a + x)
    symbols = _matches(F.col("counted"), SYMBOLS)
    upper, digits = _matches(F.col("counted"), "[A-Z]"), _matches(F.col("counted"), "[0-9]")
    marks = F.length("counted") - symbols - upper - digits
    spaces = F.col("n_chars_seen") - F.col("word_chars")
    rest = F.col("word_chars") - F.length("counted")
    chars = F.array(*(x.cast("double") for x in (upper, digits, symbols, marks, spaces, rest)))
    known = F.lit(None).cast("array<string>")
    bins = F.lit(None).cast("array<double>")
    for language, common in COMMON_WORDS.items():
        here = F.col("group") == language
        known = F.when(here, F.filter("words", _one_of(*common))).otherwise(known)
        bins = F.when(here, F.array(*(F.size(F.filter("known", _one_of(word))).cast("double") for word in common))
                      ).otherwise(bins)
    return base.withColumn("known", known).select(
        "doc_id", F.xxhash64("text").alias("text_hash"), "group", "n_words", "word_chars", symbols.alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"),
        chars.alias("char_bins"), bins.alias("word_bins"))


def total(bins) -> Column:
    return F.aggregate(bins, F.lit(0.0), lambda a, x: a + x)


def references(features: DataFrame, guard_common: int = 20, guard_texts: int = 10) -> DataFrame:
    """``group, char_reference, word_reference``: what a text of the group looks like; a row per group, five at most.

    Each distinct text counts once and by its shares, whatever its length and number of copies; word shares of texts with fewer than
    ``guard_common`` common words do not count. Of each bin the middle third of the shares is averaged, so up to a third of
    unlike texts on either side move a reference within the range of the others, never beyond. Groups of fewer than
    ``guard_texts`` texts have null references. Shares are rounded, so a bin has a thousand values at most to count, and tasks add
    up their own.
    """
    def middle(bins: str, i: int) -> Column:
        share = F.when(F.col(f"{bins}_total") > 0, F.round(F.get(bins, F.lit(i)) / F.col(f"{bins}_total"), PLACES))
        return total(F.percentile(share, F.array(*map(F.lit, MIDDLE)))) / len(MIDDLE)

    width = len(next(iter(COMMON_WORDS.values())))
    texts = features.select("group", "text_hash", "char_bins", "word_bins").distinct().withColumns({
        "char_bins_total": total(F.col("char_bins")),
        "word_bins_total": F.when(total(F.col("word_bins")) >= guard_common, total(F.col("word_bins")))})
    found = texts.groupBy("group").agg(
        F.array(*(middle("char_bins", i) for i in range(6))).alias("chars"), F.count("char_bins_total").alias("n_chars"),
        F.array(*(middle("word_bins", i) for i in range(width))).alias("words"), F.count("word_bins_total").alias("n_words"))
    return found.select("group", F.when(F.col("n_chars") >= guard_texts, F.col("chars")).alias("char_reference"),
                        F.when(F.col("n_words") >= guard_texts, F.col("words")).alias("word_reference"))


def js_distance(left, right) -> Column:
    """Jensen-Shannon distance of two histograms, 0 (alike) to 1 (disjoint); null where either is empty."""
    def part(p, q):
        m = (p + q) / 2
        return F.when(p > 0, p * F.log2(p / m)).otherwise(0.0) + F.when(q > 0, q * F.log2(q / m)).otherwise(0.0)

    a, b = total(left), total(right)
    parts = F.zip_with(left, right, lambda x, y: part(x / a, y / b))
    return F.when((a > 0) & (b > 0), F.sqrt(F.greatest(F.lit(0.0), total(parts) / 2)))


def quality(docs: DataFrame, min_words: int = 10, max_repeat_percent: int = 20,
            guard_words: int = 50, guard_common: int = 20, max_char_distance: float = 0.3,
            max_word_distance: float = 0.6, guard_texts: int = 10) -> DataFrame:
    """Per row the counts of :func:`text_features`, ``char_distance``, ``word_distance``, ``base_failed`` and ``kept``.

    A text fails the base rules with fewer than ``min_words`` words, or with more than
    ``max_repeat_percent`` of its words in repeated windows. Of the others, those of ``guard_words`` words or more
    are dropped whose character classes are further from the language's :func:`references` than
    ``max_char_distance``, or, with ``guard_common`` common words or more, whose shares of these are further
    than ``max_word_distance``; less text says too little for that. References come from the texts that can be dropped so: what
    the base rules drop and what is short has no part in them. Texts of unlisted or no language are held
    against those of all such texts, by character classes alone.

    ``docs`` needs ``doc_id, text, lang``; other columns are ignored. Texts are read once; their features are some hundred
    bytes a row. The references have a row per language listed above and one more, so joining them is a broadcast
    of five rows at most. A language of fewer than ``guard_texts`` such texts has no reference, and only the base rules
    hold. Null texts count as empty, repeated rows are judged alike, empty tables give empty results.
    """
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat_percent * F.col("n_words"))
    features = stored(text_features(docs).withColumn("base_failed", failed), "features")
    usable = features.where(~F.col("base_failed") & (F.col("n_words") >= guard_words))
    judged = features.join(F.broadcast(references(usable, guard_common, guard_texts)), "group", "left").withColumns({
        "char_distance": js_distance(F.col("char_bins"), F.col("char_reference")),
        "word_distance": js_distance(F.col("word_bins"), F.col("word_reference")),
    })
    common = F.coalesce(total(F.col("word_bins")), F.lit(0.0))
    far = (F.col("n_words") >= guard_words) & (
        (F.coalesce("char_distance", F.lit(0.0)) > max_char_distance)
        | ((common >= guard_common) & (F.coalesce("word_distance", F.lit(0.0)) > max_word_distance)))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "char_distance",
        "word_distance", "base_failed", (~F.col("base_failed") & ~far).alias("kept"))
