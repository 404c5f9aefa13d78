"""Words of whole texts and row keys, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
SPACES = r"[\x20\x09-\x0D]+"
#: What separates words of digits, ASCII letters of either case and everything beyond ASCII.
SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def spaced_words(text) -> Column:
    """Maximal runs of anything but ASCII white space; none for null."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACES), "")


def cased_words(text) -> Column:
    """Runs of digits, ASCII letters and non-ASCII characters, case as it is; none for null."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SEPARATORS), "")


def ascii_lower(text) -> Column:
    """A-Z lower-cased, nothing else. Slow on whole texts: ``translate`` looks up each character."""
    return F.translate(text, UPPER, UPPER.lower())


def ascii_terms(text) -> Column:
    """Like :func:`cased_words` with A-Z lower-cased, right for comparisons with ASCII words only.

    ``lower`` is many times faster than ``translate``. Beyond ASCII it only turns the Kelvin sign into
    an ASCII letter, so that one is replaced first; where words stand stays the same.
    """
    return cased_words(F.lower(F.replace(text, F.lit("K"), F.lit("ĸ"))))


def free_name(df: DataFrame, wish: str) -> str:
    """``wish``, lengthened until no column of ``df`` has that name in any case."""
    taken = {name.lower() for name in df.columns}
    while wish.lower() in taken:
        wish += "_"
    return wish
