"""Yearly usage of skills: series, linear fit, direction, backtest and extrapolation."""

from __future__ import annotations

import itertools
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestep.functions.text import split_list


def usage_series(responses: DataFrame, country: str | None = None, delimiter: str = ";") -> DataFrame:
    """``skill_id, year, users, usage`` from ``year, country, technologies``.

    ``usage`` is the share of that year's respondents who name the skill; naming it twice counts once.
    """
    if country is not None:
        responses = responses.filter(F.col("country") == country)
    per_year = responses.groupBy("year").agg(F.count("*").alias("respondents"))
    named = F.array_distinct(split_list(F.coalesce("technologies", F.lit("")), delimiter))
    users = (responses.select("year", F.explode(named).alias("skill_id"))
             .groupBy("skill_id", "year").agg(F.count("*").alias("users")))
    return users.join(per_year, "year").select(
        "skill_id", "year", "users", (F.col("users") / F.col("respondents")).alias("usage"))


def direction(slope: Column, threshold: float) -> Column:
    return F.when(slope > threshold, "rising").when(slope < -threshold, "fading").otherwise("steady")


def fitted_trends(series: DataFrame, target_year: int = 2030, threshold: float = 0.0, t_value: float = 2.447,
                  log: bool = False) -> DataFrame:
    """Linear fit per skill with direction, value at ``target_year`` and its prediction range.

    The range is y +- t * s * sqrt(1 + 1/n + (x0 - mean)^2 / Sxx) and null below three points.
    ``t_value`` defaults to 95 % at eight points. With ``log`` the fit is to ln(usage), zero usage
    left out, and results are mapped back.
    """
    y = F.when(F.col("usage") > 0, F.ln("usage")) if log else F.col("usage")
    x = F.col("year").cast("double")
    sums = series.select("skill_id", x.alias("x"), y.alias("y")).filter("y is not null").groupBy("skill_id").agg(
        F.count("*").alias("n"), F.regr_slope("y", "x").alias("slope"),
        F.regr_intercept("y", "x").alias("intercept"), F.avg("x").alias("_mean"),
        F.regr_sxx("y", "x").alias("_sxx"), F.regr_syy("y", "x").alias("_syy"), F.regr_sxy("y", "x").alias("_sxy"))
    value = F.col("intercept") + F.col("slope") * target_year
    rest = F.greatest(F.col("_syy") - F.col("_sxy") * F.col("_sxy") / F.col("_sxx"), F.lit(0.0))
    spread = F.when(F.col("n") >= 3, F.sqrt(rest / (F.col("n") - 2)) * F.sqrt(
        1 + 1 / F.col("n") + F.pow(target_year - F.col("_mean"), F.lit(2)) / F.col("_sxx")) * t_value)

    def back(column: Column) -> Column:
        return F.exp(column) if log else column

    return sums.select("skill_id", "n", "slope", "intercept", direction(F.col("slope"), threshold).alias("trend"),
                       back(value).alias("estimate"), back(value - spread).alias("low"),
                       back(value + spread).alias("high"))


def backtest(series: DataFrame, last_train_year: int = 2022, threshold: float = 0.0) -> DataFrame:
    """``skill_id, predicted, actual, hit``: direction fitted up to a year against the years after."""
    def slope(part: Column) -> Column:
        return F.regr_slope(F.when(part, F.col("usage")), F.when(part, F.col("year").cast("double")))

    train = F.col("year") <= last_train_year
    return (
        series.groupBy("skill_id").agg(slope(train).alias("_p"), slope(~train).alias("_a"))
        .filter(F.col("_p").isNotNull() & F.col("_a").isNotNull())
        .select("skill_id", direction(F.col("_p"), threshold).alias("predicted"),
                direction(F.col("_a"), threshold).alias("actual"))
        .withColumn("hit", F.col("predicted") == F.col("actual"))
    )


def directional_accuracy(tested: DataFrame) -> DataFrame:
    return tested.agg(F.count("*").alias("n_skills"), F.avg(F.col("hit").cast("double")).alias("accuracy"))


#: Hexadecimal digits of a digest that make a number between 0 and 1.
DRAW_DIGITS = 6


def poisson_limits() -> list[float]:
    """The chances of at most 0, 1, 2, ... under Poisson(1), as far as ``DRAW_DIGITS`` tell them from 1."""
    shares = [math.exp(-1) / math.factorial(k) for k in range(20)]
    return [limit for limit in itertools.accumulate(shares) if limit <= 1 - 16 ** -DRAW_DIGITS]


def bootstrap_range(series: DataFrame, target_year: int = 2030, draws: int = 200, seed: int = 42,
                    level: float = 0.95) -> DataFrame:
    """``skill_id, low, high``: percentile range of refits on seeded Poisson-weighted points.

    Weights come from the digest of ``skill_id:year:draw:seed``, so a rerun, a lost executor or another engine gives the same draws.
    """
    digest = F.md5(F.concat_ws(":", "skill_id", "year", "draw", F.lit(seed)))
    uniform = F.conv(F.substring(digest, 1, DRAW_DIGITS), 16, 10).cast("long") / float(16 ** DRAW_DIGITS)
    weight = sum((F.when(uniform >= limit, 1).otherwise(0) for limit in poisson_limits()), F.lit(0))
    x, y, w = F.col("year") - F.lit(target_year), F.col("usage"), F.col("w")
    sums = (
        series.withColumn("draw", F.explode(F.sequence(F.lit(1), F.lit(draws))))
        .withColumn("w", weight).groupBy("skill_id", "draw")
        .agg(F.sum(w).alias("n"), F.sum(w * x).alias("sx"), F.sum(w * y).alias("sy"),
             F.sum(w * x * x).alias("sxx"), F.sum(w * x * y).alias("sxy"))
    )
    spread = F.col("n") * F.col("sxx") - F.col("sx") * F.col("sx")
    at_target = (F.col("sy") * F.col("sxx") - F.col("sx") * F.col("sxy")) / F.nullif(spread, F.lit(0))
    tails = F.percentile("v", F.array(F.lit((1 - level) / 2), F.lit((1 + level) / 2)))
    return (sums.select("skill_id", at_target.alias("v")).groupBy("skill_id").agg(tails.alias("_r"))
            .select("skill_id", F.col("_r")[0].alias("low"), F.col("_r")[1].alias("high")))
