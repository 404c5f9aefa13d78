"""Demand side: posting-skill pairs, distinct employers per skill, threshold, depth and trend."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestep.functions import fixed_values as fixed
from lodestep.functions.text import dictionary_id, split_list
from lodestep.operators.filters import title_flags


def listed_skills(postings: DataFrame, skills: str = "skills", keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per skill string of a posting: ``posting, *keep, pos, raw``."""
    return postings.select("posting", *keep, F.posexplode(split_list(F.col(skills))).alias("pos", "raw"))


def posting_skills(mapped: DataFrame, min_skills: int = fixed.MIN_SKILLS_PER_POSTING) -> DataFrame:
    """``posting, skill_idx, employer, title, how`` of postings with enough mapped skills.

    ``mapped`` holds ``posting, employer, title, pos, skill_idx, how``. Where two strings of a posting
    map to one skill, the earlier one gives ``how``. Rows are spread by posting once, before the
    grouping; the per-posting count reuses that partitioning.
    """
    pairs = (
        mapped.repartition("posting")
        .groupBy("posting", "skill_idx")
        .agg(F.first("employer").alias("employer"), F.first("title").alias("title"),
             F.min_by("how", "pos").alias("how"))
    )
    return skilled_postings(pairs, min_skills)


def skilled_postings(pairs: DataFrame, min_skills: int = fixed.MIN_SKILLS_PER_POSTING) -> DataFrame:
    """Pairs of postings with at least ``min_skills`` distinct skills.

    The window group is one posting's skill cell, so it stays small whatever the table size.
    """
    per_posting = F.count("*").over(Window.partitionBy("posting"))
    return pairs.withColumn("_n", per_posting).filter(F.col("_n") >= min_skills).drop("_n")


def employer_skill_counts(pairs: DataFrame) -> DataFrame:
    """Counts per (skill, employer), the common base of every distinct count below.

    Spreading a skill over its employers keeps a skill that nearly all postings name from
    landing in one task, and needs no expansion for several distinct counts.
    """
    builder, junior = title_flags(F.col("title"))
    return pairs.groupBy("skill_idx", "employer").agg(
        F.count("*").alias("postings"),
        F.sum(builder.cast("long")).alias("builders"),
        F.sum(junior.cast("long")).alias("juniors"),
    )


def skill_counts(base: DataFrame) -> DataFrame:
    """``skill_idx, employers, postings, core_builder_share, junior_share``."""
    return base.groupBy("skill_idx").agg(
        F.count("*").alias("employers"),
        F.sum("postings").alias("postings"),
        (F.sum("builders") / F.sum("postings")).alias("core_builder_share"),
        (F.sum("juniors") / F.sum("postings")).alias("junior_share"),
    )


def employer_sketches(pairs: DataFrame, *period: str, precision: int = 12) -> DataFrame:
    """``*period, skill_idx, employers_sketch, postings_sketch``: mergeable sketches of what the exact counts count.

    Sketches of months, files or clusters merge without the rows behind them. A sketch takes at most ``2 ** precision`` bytes or so, and
    its estimate is off by about ``0.8 / 2 ** (precision / 2)`` of the count (standard error).
    """
    return pairs.groupBy(*period, "skill_idx").agg(
        F.hll_sketch_agg(F.col("employer").cast("string"), precision).alias("employers_sketch"),
        F.hll_sketch_agg(F.col("posting").cast("string"), precision).alias("postings_sketch"))


def merged_sketch_counts(sketches: DataFrame, *period: str) -> DataFrame:
    """``*period, skill_idx, employers, postings`` estimated from sketches, merged over all columns but those named.

    An approximate way out for series of any length; :func:`skill_counts` is exact and stays what thresholds use.
    """
    union = {name: F.hll_sketch_estimate(F.hll_union_agg(f"{name}_sketch")).alias(name) for name in ("employers", "postings")}
    return sketches.groupBy(*period, "skill_idx").agg(*union.values())


def employer_total(base: DataFrame) -> DataFrame:
    """One row: number of distinct employers left after the skill gate."""
    return base.select("employer").distinct().agg(F.count("*").alias("n_employers"))


def auto_threshold(n_employers: Column, min_employers: int = fixed.MIN_EMPLOYERS,
                   share: float = fixed.EMPLOYER_SHARE) -> Column:
    return F.greatest(F.lit(min_employers), F.ceil(n_employers * F.lit(share)).cast("int"))


def verified_skills(base: DataFrame, forced_k: int | None = None,
                    min_employers: int = fixed.MIN_EMPLOYERS,
                    share: float = fixed.EMPLOYER_SHARE) -> DataFrame:
    """Skill counts at or above the threshold, with the threshold as ``k``.

    The threshold is a scalar subquery, so it costs no join and no driver round trip.
    """
    if forced_k:
        k = F.lit(forced_k)
    else:
        k = (employer_total(base)
             .select(auto_threshold(F.col("n_employers"), min_employers, share).alias("k"))
             .scalar())
    return skill_counts(base).withColumn("k", k.cast("int")).filter(F.col("employers") >= F.col("k"))


def count_distribution(counts: DataFrame, column: str = "employers") -> DataFrame:
    """One row describing the counts; percentiles interpolate linearly."""
    quarter = F.percentile(column, F.array(*[F.lit(p) for p in (0.5, 0.75, 0.9, 0.95)]))
    return counts.agg(
        F.count(column).alias("n"), F.avg(column).alias("mean"), F.stddev_samp(column).alias("std"),
        F.min(column).alias("min"), quarter.alias("_p"), F.max(column).alias("max"),
    ).select("n", "mean", "std", "min", *[
        F.col("_p")[i].alias(name) for i, name in enumerate(("p50", "p75", "p90", "p95"))
    ], "max")


def survival_ladder(counts: DataFrame, column: str = "employers",
                    steps: tuple[int, ...] = fixed.SURVIVAL_STEPS) -> DataFrame:
    """``k, survivors`` for each step, from one pass over the counts."""
    survivors = counts.agg(*[F.count_if(F.col(column) >= k).alias(f"k{k}") for k in steps])
    return survivors.select(F.inline(F.array(*[
        F.struct(F.lit(k).alias("k"), F.col(f"k{k}").alias("survivors")) for k in steps
    ])))


def _holds_any(text: Column, words: list[str], match: str = "substring") -> Column:
    """Whether ``text`` holds one of the words, as a substring or as whole words."""
    if match == "word":
        return text.rlike(r"(?U)(?<![\w+#])(?:" + "|".join(f"\\Q{w}\\E" for w in words) + r")(?![\w+#])")
    hit = F.lit(False)
    for word in words:
        hit = hit | text.contains(word)
    return hit


def demand_depth(label: Column, builder_share: Column, junior_share: Column,
                 apply_labels: list[str] = fixed.APPLY_LABELS,
                 build_labels: list[str] = fixed.BUILD_LABELS, match: str = "substring",
                 junior_min: float = fixed.JUNIOR_SHARE_MIN,
                 builder_min: float = fixed.BUILDER_SHARE_MIN) -> Column:
    """Depth employers want, by label first and title shares second."""
    low = F.lower(label)
    return (
        F.when(_holds_any(low, apply_labels, match), "apply")
        .when(_holds_any(low, build_labels, match), "build")
        .when(junior_share >= junior_min, "apply")
        .when(builder_share >= builder_min, "build")
        .otherwise("apply")
    )


def keyword_trend(label: Column, rising: list[str] = fixed.RISING_LABELS,
                  fading: list[str] = fixed.FADING_LABELS) -> Column:
    """Trend the label alone decides, null where a fitted trend has to."""
    low = F.lower(label)
    return F.when(_holds_any(low, rising), "rising").when(_holds_any(low, fading), "fading")


def drawn_multiplier(key: Column, trend: Column, ranges: dict[str, tuple[float, float]] = fixed.KEYWORD_MULTIPLIERS) -> Column:
    """A number within the trend's range, picked by the digest of ``key``; null for trends without a range."""
    share = F.conv(F.substring(F.md5(key), 1, 6), 16, 10).cast("long") / float(16 ** 6)
    drawn = F.lit(None).cast("double")
    for name, (low, high) in ranges.items():
        drawn = F.when(trend == name, low + share * (high - low)).otherwise(drawn)
    return drawn


def estimate(employers: Column, multiplier: Column) -> Column:
    return F.rint(employers * multiplier).cast("int")


def estimate_band(value: Column, low: float = fixed.BAND[0], high: float = fixed.BAND[1]) -> Column:
    """Lower and upper bound, rounded half to even; null with the estimate."""
    return F.when(value.isNotNull(), F.array(
        F.rint(value * F.lit(low)).cast("int"), F.rint(value * F.lit(high)).cast("int")))


def demand_records(verified: DataFrame, dictionary: DataFrame, trends: DataFrame | None = None,
                   match: str = "substring",
                   keyword_ranges: dict[str, tuple[float, float]] | None = None) -> DataFrame:
    """Output records of the demand side, most employers first, ties by id.

    ``trends`` holds ``skill_idx, trend, multiplier``. A trend the label decides stands before a fitted one. Without the
    table, given ``keyword_ranges``, those labels have a trend with a multiplier from its range; else all trend fields are null.
    """
    rows = verified.join(dictionary.select("skill_idx", "uri", "label"), "skill_idx")
    if trends is None and keyword_ranges:
        rows = rows.withColumn("trend", keyword_trend(F.col("label"))).withColumn(
            "multiplier", drawn_multiplier(F.col("uri"), F.col("trend"), keyword_ranges))
    elif trends is None:
        rows = rows.withColumns({"trend": F.lit(None).cast("string"), "multiplier": F.lit(None).cast("double")})
    else:
        rows = rows.join(trends.withColumnRenamed("trend", "_fitted"), "skill_idx", "left").withColumn(
            "trend", F.coalesce(keyword_trend(F.col("label")), "_fitted"))
    value = F.when(F.col("trend").isNotNull(), estimate(F.col("employers"), F.col("multiplier")))
    return (
        rows.withColumn("trend_2030_estimate", value)
        .select(
            dictionary_id(F.col("uri")).alias("skill_id"),
            F.col("label").alias("skill_name"),
            F.col("uri").alias("esco_uri"),
            F.col("employers").cast("int").alias("distinct_employers"),
            F.col("postings").cast("int").alias("postings"),
            demand_depth(F.col("label"), F.col("core_builder_share"), F.col("junior_share"),
                         match=match).alias("demand_depth"),
            "trend",
            "trend_2030_estimate",
            estimate_band(F.col("trend_2030_estimate")).alias("trend_confidence_band"),
        )
        .orderBy(F.desc("distinct_employers"), "skill_id")
    )
