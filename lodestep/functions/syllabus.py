"""Column expressions over syllabus text: course vetting, headers, lesson lines, topics."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lodestep.functions import fixed_values as fixed
from lodestep.functions.text import clean_cell, ignore_case, matches, squeeze, strip


def _first(pattern: str, text: Column, group: int) -> Column:
    """Group of the first match, null without a match."""
    return F.when(text.rlike(pattern), F.regexp_extract(text, pattern, group))


def course_code_prefix(file_name: Column, page1: Column, pattern: str = fixed.COURSE_CODE) -> Column:
    pattern = "(?Ud)" + pattern
    return F.coalesce(_first(pattern, file_name, 1), _first(pattern, page1, 1))


def course_name(page1: Column, pattern: str = fixed.COURSE_NAME) -> Column:
    found = F.regexp_extract(page1, "(?s)" + ignore_case(pattern), 1)
    return strip(squeeze(found))


def course_verdict(page1: Column, file_name: Column,
                   prefixes: list[str] = fixed.COURSE_PREFIXES,
                   banned: list[str] = fixed.BANNED_COURSE_WORDS,
                   non_graded: list[str] = fixed.NON_GRADED_MARKS,
                   code_pattern: str = fixed.COURSE_CODE,
                   name_pattern: str = fixed.COURSE_NAME) -> Column:
    """``struct(ok, reason)`` of the first rule that applies to a course."""
    prefix = course_code_prefix(file_name, page1, code_pattern)
    name = course_name(page1, name_pattern)
    ungraded = F.lit(False)
    for mark in non_graded:
        ungraded = ungraded | page1.contains(mark)
    off_topic = F.lit(False)
    for word in banned:
        off_topic = off_topic | F.lower(name).contains(word)

    def verdict(ok: bool, *reason: Column | str) -> Column:
        parts = [F.lit(part) if isinstance(part, str) else part for part in reason]
        return F.struct(F.lit(ok).alias("ok"), F.concat(*parts).alias("reason"))

    return (
        F.when(strip(page1) == "", verdict(False, "Empty PDF"))
        .when(ungraded, verdict(False, "Mandatory Non-Graded (MNG)"))
        .when(prefix.isNotNull() & ~prefix.isin(prefixes),
              verdict(False, "Non-coding subject prefix '", prefix, "'"))
        .when(off_topic, verdict(False, "Non-core course title: '", name, "'"))
        .otherwise(verdict(True, "Core course: '", name, "'"))
    )


HEADER_TYPE = "struct<topic:int,ncols:int,kind:string,unit:int,bt:int,hours:int>"


def detected_header(cells: Column, topic_pattern: str = fixed.HEADER_TOPIC,
                    hours_pattern: str = fixed.HEADER_HOURS) -> Column:
    """Column positions a header row gives (0-based), null for any other row.

    Roles exclude one another in the order unit, level, hours. The first unit column counts,
    but the last level and hours columns.
    """
    def role(cell: Column) -> Column:
        low = strip(F.lower(cell))
        return (F.when(low.startswith("unit"), "unit")
                .when(low.contains("bt") & low.contains("co"), "bt")
                .when(matches(low, hours_pattern), "hours")
                .otherwise(""))

    roles = F.transform(cells, role)
    backwards = F.reverse(roles)

    def first_of(name: str) -> Column:
        place = F.array_position(roles, name)
        return F.when(place > 0, place - 1).cast("int")

    def last_of(name: str) -> Column:
        place = F.array_position(backwards, name)
        return F.when(place > 0, F.size(cells) - place).cast("int")

    topic = (F.array_position(F.transform(cells, lambda c: matches(c, topic_pattern)), True) - 1).cast("int")
    kind = F.when(F.lower(F.get(cells, topic)).contains("experiment"), "practical").otherwise("theory")
    return F.when(topic >= 0, F.struct(
        topic.alias("topic"), F.size(cells).alias("ncols"), kind.alias("kind"),
        first_of("unit").alias("unit"), last_of("bt").alias("bt"), last_of("hours").alias("hours"),
    ))


def cleaned_cells(cells: Column) -> Column:
    return F.transform(cells, clean_cell)


def contact_hours(cell: Column, kind: Column) -> Column:
    """First number in a cell; missing or zero falls back to the usual hours of the kind."""
    usual = F.when(kind == "practical", fixed.DEFAULT_HOURS["practical"]).otherwise(
        fixed.DEFAULT_HOURS["theory"])
    found = F.regexp_extract(F.coalesce(cell, F.lit("")), r"(\d+)", 1).try_cast("int")
    return F.coalesce(F.nullif(found, F.lit(0)), usual)


def line_fields(line: Column) -> Column:
    """``struct(raw, bt, hours)`` of a lesson line; ``raw`` may be blank."""
    body = F.regexp_replace(line, fixed.LINE_NUMBERING, "")
    body = F.regexp_replace(body, "(?d)" + fixed.LINE_LEVEL + ".*$", "")
    body = F.regexp_replace(body, "(?U)" + fixed.LINE_REFERENCES, "")
    hours = F.regexp_extract(line, ignore_case(fixed.LINE_HOURS), 1).try_cast("int")
    return F.struct(strip(body).alias("raw"),
                    F.regexp_extract(line, fixed.LINE_LEVEL, 0).alias("bt"),
                    hours.alias("hours"))


#: Pieces of a topic text whose depths are folded together, so that no array or string grows with the whole text.
_BLOCK = 128
#: Stands for a cut; no character of any text.
_CUT = "\uffff"


def _bound(value: Column, body) -> Column:
    """``body`` of a value that is computed once, however often a lambda inside names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _outside_brackets(pieces: Column, marks: str) -> Column:
    """The pieces joined again, with a cut for each of ``marks`` outside all brackets.

    Depth never falls below zero. A block of pieces moves it by a sum and at most down to its lowest point, so the depths
    that enter the blocks follow from two numbers each, and every block is then folded by itself.
    """
    def change(piece: Column) -> Column:
        return F.when(piece.isin("(", "["), 1).when(piece.isin(")", "]"), -1).otherwise(0)

    def summary(block: Column) -> Column:
        start = F.struct(F.lit(0).alias("sum"), F.lit(0).alias("low"))
        return F.aggregate(block, start, lambda state, piece: F.struct(
            (state["sum"] + change(piece)).alias("sum"), F.least(state["low"], state["sum"] + change(piece)).alias("low")))

    def entered(depths: Column, block: Column) -> Column:
        depth = F.element_at(depths, -1)
        return F.concat(depths, F.array(_bound(summary(block), lambda total: depth + total["sum"] - F.least(F.lit(0), depth + total["low"]))))

    def marked(block: Column, depth: Column) -> Column:
        def step(state: Column, piece: Column) -> Column:
            cut = F.when((state["depth"] == 0) & (change(piece) == 0), F.regexp_replace(piece, marks, _CUT)).otherwise(piece)
            return F.struct(F.greatest(state["depth"] + change(piece), F.lit(0)).alias("depth"), F.concat(state["text"], cut).alias("text"))
        return F.aggregate(block, F.struct(depth.alias("depth"), F.lit("").alias("text")), step, lambda state: state["text"])

    def joined(blocks: Column) -> Column:
        depths = F.aggregate(blocks, F.array(F.lit(0)), entered)
        return F.array_join(F.zip_with(blocks, F.slice(depths, F.lit(1), F.size(blocks)), marked), "")

    def in_blocks(pieces: Column) -> Column:
        numbers = F.sequence(F.lit(0), F.floor((F.size(pieces) - 1) / _BLOCK).cast("int"))
        return F.transform(numbers, lambda b: F.slice(pieces, b * _BLOCK + 1, _BLOCK))

    return _bound(_bound(pieces, in_blocks), joined)


def split_topics(text: Column, min_length: int = 3, prefix: str = fixed.TOPIC_PREFIX) -> Column:
    """Parts of a topic text between ``,``, ``;`` and bullets outside brackets, in time linear in its length.

    A text that opens no bracket, by far the usual case, is split as it is.
    """
    marks = "[,;•]"
    pieces = F.regexp_extract_all(text, F.lit(r"([(\[]|[)\]]|[^()\[\]]+)"))
    bracketed = text.contains("(") | text.contains("[")
    parts = F.when(bracketed, F.split(_outside_brackets(pieces, marks), _CUT)).otherwise(F.split(text, marks))
    cleaned = F.transform(parts, lambda part: F.btrim(
        F.regexp_replace(strip(part), ignore_case(prefix), ""), F.lit(" -:,.\t")))
    kept = F.filter(cleaned, lambda part: F.length(part) >= min_length)
    return F.when(F.size(kept) > 0, kept).otherwise(F.array(text))
