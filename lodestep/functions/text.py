"""Text normalisation as built-in column expressions. Those over arrays use lambdas, which run outside generated code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lodestep.functions import fixed_values as fixed

# The characters a Unicode-aware strip removes.
WHITESPACE = "".join(map(chr, [
    *range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B),
    0x2028, 0x2029, 0x202F, 0x205F, 0x3000,
]))
_SPACE_RUN = r"(?U)[\s\x1c-\x1f]+"


def ignore_case(pattern: str) -> str:
    """Java flags that give ``\\w``, ``\\b``, case and line ends their Unicode meaning."""
    return "(?Uiud)" + pattern


def matches(text: Column, pattern: str) -> Column:
    return text.rlike(ignore_case(pattern))


def strip(text: Column, chars: str = WHITESPACE) -> Column:
    return F.btrim(text, F.lit(chars))


def squeeze(text: Column) -> Column:
    return F.regexp_replace(text, _SPACE_RUN, " ")


def norm(text: Column) -> Column:
    """Lower case, single spaces, no edge punctuation."""
    return strip(squeeze(F.lower(text)), " .;:-")


def strip_paren(text: Column) -> Column:
    """``norm`` without parenthesised parts."""
    return norm(F.regexp_replace(text, r"(?d)\(.*?\)", ""))


def employer_key(name: Column) -> Column:
    """Employer name without legal suffixes and punctuation; the grouping key."""
    bare = F.regexp_replace(F.lower(name), ignore_case(fixed.EMPLOYER_SUFFIX), "")
    return strip(squeeze(F.regexp_replace(bare, "[^a-z0-9& ]+", " ")))


def dictionary_id(uri: Column) -> Column:
    return F.concat(F.lit(fixed.DICTIONARY_ID_PREFIX), F.substring(F.sha1(uri.cast("binary")), 1, 16))


def slug(text: Column) -> Column:
    return F.btrim(F.regexp_replace(F.lower(text), "[^a-z0-9]+", "_"), F.lit("_"))


def split_list(text: Column, delimiter: str = ",") -> Column:
    """Trimmed, non-blank members of a delimited cell, in order."""
    parts = F.transform(F.split(text, f"\\Q{delimiter}\\E"), lambda part: strip(part))
    return F.filter(parts, lambda part: part != "")


def fingerprint(title: Column, skills: Column, description: Column) -> Column:
    """Title, order-free skill list and description; equal for reworded copies only."""
    ordered = F.array_join(F.array_sort(F.transform(F.split(skills, ","), norm)), ",")
    return F.concat_ws(" | ", norm(title), ordered, norm(description))


def to_number(text: Column) -> Column:
    """Number held by a text, null where there is none; NaN counts as none."""
    bare = strip(text.cast("string"))
    shape = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"
    infinite = F.regexp_extract(bare, r"(?i)^([+-]?)inf(inity)?$", 1)
    return (
        F.when(bare.rlike(shape), bare.try_cast("double"))
        .when(bare.rlike(r"(?i)^[+-]?inf(inity)?$"),
              F.when(infinite == "-", F.lit(float("-inf"))).otherwise(F.lit(float("inf"))))
    )


def text_or_blank(value: Column) -> Column:
    return F.coalesce(value.cast("string"), F.lit(""))


def clean_cell(cell: Column) -> Column:
    return strip(squeeze(F.coalesce(cell, F.lit(""))))


def lines_of(text: Column) -> Column:
    """Trimmed lines of a page text."""
    return F.transform(F.split(text, "\n"), lambda line: strip(line))
