"""Language identification by cross-parsing: how few phrases of a language's text a text falls into."""

from __future__ import annotations

import functools
from collections.abc import Iterator
from math import log2

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: The fitted sample: at most so many rows per language, so many code points of each, and as many of all languages.
FIT_ROWS = 64
FIT_ROW_CHARS = 2_000
FIT_CHARS = 200_000
#: Letters fall into so many classes less one; class 0 is a run of anything else.
ALPHABET = 64
#: Texts are parsed in pieces of so many letters, side by side.
PIECE = 256
UNKNOWN = "und"


@functools.cache
def letter_classes() -> np.ndarray:
    """The class of each code point: 0 unless it is a letter; letters that lower-case alike share one."""
    classes = np.zeros(0x110000, np.uint8)
    for point in range(0x110000):
        if not 0xD800 <= point < 0xE000 and (char := chr(point)).isalpha():
            low = ord(char.lower()[0])
            classes[point] = 1 + (low - 97 if 97 <= low <= 122 else 26 + (low * 2654435761 >> 7) % (ALPHABET - 27))
    return classes


def coded(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The classes of all texts in a row, runs of non-letters as one, and where each text starts and ends."""
    points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    classes = letter_classes()[np.minimum(points, 0x10FFFF)]
    bounds = np.concatenate([[0], np.cumsum([len(text) for text in texts])])
    first = np.zeros(len(classes) + 1, bool)
    first[bounds] = True
    keep = (classes > 0) | first[:-1]
    keep[1:] |= classes[:-1] > 0
    places = np.concatenate([[0], np.cumsum(keep)])
    return classes[keep], places[bounds[:-1]], places[bounds[1:]]


def automaton(classes: np.ndarray) -> np.ndarray:
    """The suffix automaton of a text as a table: entry ``state + class`` is twice the next state, plus 1 where no
    longer match exists and a new phrase starts with that letter. States are multiples of ``ALPHABET``."""
    moves, links, lengths, last = [{}], [-1], [0], 0
    for letter in classes.tolist():
        moves.append({})
        lengths.append(lengths[last] + 1)
        links.append(0)
        new, at = len(moves) - 1, last
        while at >= 0 and letter not in moves[at]:
            moves[at][letter] = new
            at = links[at]
        if at >= 0:
            to = moves[at][letter]
            if lengths[at] + 1 != lengths[to]:
                moves.append(dict(moves[to]))
                lengths.append(lengths[at] + 1)
                links.append(links[to])
                clone = len(moves) - 1
                while at >= 0 and moves[at].get(letter) == to:
                    moves[at][letter] = clone
                    at = links[at]
                links[to] = links[new] = clone
            else:
                links[new] = to
        last = new
    start = np.array([moves[0].get(letter, 0) for letter in range(ALPHABET)], np.int32)
    table = np.tile(start * ALPHABET * 2 + 1, (len(moves), 1)).astype(np.int32)
    for state, out in enumerate(moves):
        for letter, to in out.items():
            table[state, letter] = to * ALPHABET * 2
    return table.ravel()


def phrases(table: np.ndarray, classes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """In how many phrases each text falls, each the longest match in the automaton from where the last ended."""
    pieces = -(-(ends - starts) // PIECE)
    text = np.repeat(np.arange(len(starts)), pieces)
    number = np.arange(len(text)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    at = starts[text] + number * PIECE
    length = np.minimum(PIECE, ends[text] - at)
    order = np.argsort(-length, kind="stable")
    at, length, text = at[order], length[order], text[order]
    state, count = np.zeros(len(at), np.int32), np.zeros(len(at), np.int32)
    active = np.searchsorted(-length, -np.arange(PIECE), "left")
    for step in range(PIECE):
        n = active[step]
        if not n:
            break
        entry = table[state[:n] + classes[at[:n] + step]]
        count[:n] += entry & 1
        state[:n] = entry >> 1
    return np.bincount(text, count + 1, len(starts))


@functools.lru_cache(maxsize=1)
def fitted(sample: tuple[tuple[str, str], ...]) -> list[tuple[str, np.ndarray, float]]:
    """``language, automaton, bits per phrase`` for each language of a sample; built once in each Python worker."""
    return [(language, automaton(coded([text])[0]), log2(len(text) + 1)) for language, text in sample]


def fit(docs: DataFrame, rows: int = FIT_ROWS, row_chars: int = FIT_ROW_CHARS, chars: int = FIT_CHARS,
        ) -> tuple[tuple[str, str], ...]:
    """``(language, text)`` pairs to compare with, from rows of ``docs`` with ``lang`` and ``text``.

    Of each language the ``rows`` rows with letters whose text hashes lowest, ``row_chars`` code points each; all
    languages share ``chars``. So the sample and what is built from it stay small whatever the input.
    """
    usable = docs.where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}")).select(
        "lang", F.xxhash64("text").alias("place"), F.substring("text", 1, row_chars).alias("text"))
    lowest = Window.partitionBy("lang").orderBy("place", "text")
    chosen = usable.withColumn("rank", F.row_number().over(lowest)).where(F.col("rank") <= rows).orderBy("lang", "rank").collect()
    texts: dict[str, list[str]] = {}
    for row in chosen:
        texts.setdefault(row["lang"], []).append(row["text"])
    return tuple((language, " ".join(own)[:max(1, chars // len(texts))]) for language, own in texts.items())


def identify(texts: list[str | None], sample: tuple[tuple[str, str], ...]) -> tuple[list[str], list[float]]:
    """The language of each text, and by which share the second best needs more bits per letter."""
    languages = fitted(sample)
    classes, starts, ends = coded([text or "" for text in texts])
    letters = np.concatenate([[0], np.cumsum(classes > 0)])
    letters = letters[ends] - letters[starts]
    if not languages:
        return [UNKNOWN] * len(texts), [0.0] * len(texts)
    bits = np.stack([phrases(table, classes, starts, ends) * cost for _, table, cost in languages])
    best = bits.argmin(0)
    ordered = np.sort(bits, 0)
    second = ordered[1] if len(languages) > 1 else ordered[0] * 2 + 1
    score = np.where(letters > 0, 1 - ordered[0] / np.maximum(second, 1e-9), 0.0)
    return [languages[i][0] if n else UNKNOWN for i, n in zip(best, letters)], np.clip(score, 0, 1).tolist()


def batches_of(texts: pd.Series, limit: int = 1_000_000) -> Iterator[list]:
    """Rows in order, as few together as hold ``limit`` code points, so memory follows the longest text."""
    part, size = [], 0
    for text in texts:
        text = None if text is None or text != text else text
        part.append(text)
        size += len(text or "")
        if size >= limit or len(part) >= 5_000:
            yield part
            part, size = [], 0
    if part:
        yield part


def language_of(sample: tuple[tuple[str, str], ...]):
    """A column function: text -> struct of ``lang_pred`` and ``score``."""
    @F.pandas_udf("lang_pred string, score double")
    def predict(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in parts:
            found = [identify(part, sample) for part in batches_of(texts)]
            yield pd.DataFrame({"lang_pred": [x for names, _ in found for x in names],
                                "score": [x for _, scores in found for x in scores]})
    return predict


def held_out(doc_id):
    """Whether a document is kept out of fitting: crc32 of its id as text leaves 1 when divided by 3; null ids are not."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def languages(docs: DataFrame) -> DataFrame:
    """Per row ``doc_id, held_out, lang_pred, score``, fitted on rows that are not held out.

    A text without letters, null or empty, is ``und`` with score 0, as are all if nothing is labelled. Ties go to the language first
    in order. Whole texts are parsed, in pieces side by side; other columns are ignored. No shuffle but that of the sample.
    """
    sample = fit(docs.where(~held_out(F.col("doc_id"))))
    found = language_of(sample)(F.col("text"))
    return docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), found.alias("found")).select(
        "doc_id", "held_out", "found.lang_pred", "found.score")


def keep_known(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose text has a language; columns as they were. Where nothing is labelled, nothing is learned and all rows stay."""
    sample = fit(docs.where(~held_out(F.col("doc_id"))))
    if not sample:
        return docs
    return docs.where(language_of(sample)(F.col("text"))["lang_pred"] != UNKNOWN)
