"""Spelling variants: the vocabulary's minimal acceptor composed with a one-edit transducer and the acceptor again.

Two words one edit apart share the first or the last half of the shorter one. So words meet in partitions of (direction, length
of the shorter word, half): the state that the half leads to from the initial state of the acceptor of all words, read
forwards or backwards. A partition builds the minimal acceptor of what follows the half, composes and enumerates; it holds
words of two lengths that agree in half their letters, and passes on one line per word, never the pairs.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestep.session import stored

RUN = re.compile("[A-Za-zÀ-ÿ]+")
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
#: One run in so many loses a letter, by a checksum of document and run.
SLIP = 199
LEAST_LENGTH, LEAST_COUNT, FORM_TIMES = 6, 5, 5
#: Words that a task counts before it passes them on.
HELD = 400_000


def runs(text: str | None) -> list[str]:
    """Maximal runs of letters, A-Z lower-cased."""
    return RUN.findall((text or "").encode("utf-8", "surrogatepass").translate(LOWER).decode("utf-8", "surrogatepass"))


def slipped(doc_id: str, run: str) -> str:
    """``run`` as this document spells it."""
    h = zlib.crc32(f"{doc_id}:{run}".encode())
    place = h % len(run)
    return run if h % SLIP else run[:place] + run[place + 1:]


def word_counts(docs: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT) -> DataFrame:
    """``word, n`` of all words long and frequent enough. A null text has none; a null id reads as empty; repeated rows count each."""
    schema = pa.schema([("word", pa.string()), ("n", pa.int64())])

    def batch_of(counts: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], schema=schema)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for run, n in Counter(runs(text)).items():
                    if len(run) >= least_length:
                        counts[slipped(doc_id, run)] += n
                if len(counts) >= HELD:
                    yield batch_of(counts)
                    counts.clear()
        yield batch_of(counts)

    slim = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.col("text").cast("string"))
    found = slim.toDF("doc", "text").mapInArrow(count, "word string, n long")
    return found.where(F.length("word") >= least_length).groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


class Acceptor:
    """The minimal acyclic acceptor of sorted, distinct words, built word by word; equal right languages share a state.

    ``moves[s]`` maps letters to states, ``final[s]`` says whether a word ends, ``size[s]`` counts the words from there,
    so the words before a path number its word.
    """

    def __init__(self, words: list[str]):
        self.moves: list[dict[str, int]] = [{}]
        self.final: list[bool] = [False]
        self.size: list[int] = [0]
        known: dict[tuple, int] = {}
        path, last = [0], ""

        def settle(depth: int) -> None:
            while len(path) > depth:
                state = path.pop()
                self.size[state] = self.final[state] + sum(self.size[to] for to in self.moves[state].values())
                if path:
                    key = (self.final[state], *self.moves[state].items())
                    self.moves[path[-1]][last[len(path) - 1]] = known.setdefault(key, state)

        for word in words:
            shared = 0
            while shared < min(len(word), len(last)) and word[shared] == last[shared]:
                shared += 1
            settle(shared + 1)
            for letter in word[shared:]:
                self.moves.append({})
                self.final.append(False)
                self.size.append(0)
                self.moves[path[-1]][letter] = len(self.moves) - 1
                path.append(len(self.moves) - 1)
            self.final[path[-1]] = True
            last = word
        settle(0)

    def numbered(self, state: int) -> list[tuple[str, int, int]]:
        """Letter, next state and how many of the state's words come before that letter's."""
        out, before = [], int(self.final[state])
        for letter, to in sorted(self.moves[state].items()):
            out.append((letter, to, before))
            before += self.size[to]
        return out


class OneEdit:
    """An acceptor composed with one replaced or inserted letter and itself.

    Before the edit both sides stand in one state. After it they read the same letters; a pair of states is explored
    once and keeps the numbers of the words it accepts, so states that share a right language share the work.
    """

    def __init__(self, acceptor: Acceptor):
        self.of = acceptor
        self.tables = {}
        self.common: dict[tuple[int, int], list[tuple[int, int]]] = {}

    def moves(self, state: int) -> list[tuple[str, int, int]]:
        if state not in self.tables:
            self.tables[state] = self.of.numbered(state)
        return self.tables[state]

    def same(self, p: int, q: int) -> list[tuple[int, int]]:
        """Numbers, from ``p`` and from ``q``, of the words that both accept. Words may be long, so nothing recurs."""
        todo = [(p, q)]
        while todo:
            a, b = pair = todo[-1]
            if pair in self.common:
                todo.pop()
            elif a == b:
                self.common[pair] = [(i, i) for i in range(self.of.size[a])]
            else:
                right = {letter: (to, before) for letter, to, before in self.moves(b)}
                steps = [(to, before, *right[letter]) for letter, to, before in self.moves(a) if letter in right]
                missing = [(to, other) for to, _, other, _ in steps if (to, other) not in self.common]
                if missing:
                    todo += missing
                else:
                    self.common[pair] = [(0, 0)] * (self.of.final[a] and self.of.final[b]) + [
                        (before + i, start + j) for to, before, other, start in steps for i, j in self.common[to, other]]
        return self.common[p, q]

    def pairs(self) -> set[tuple[int, int]]:
        """Numbers of the words that one edit turns into each other, the smaller first."""
        found: set[tuple[int, int]] = set()
        open_states = [(0, 0)]
        while open_states:
            state, at = open_states.pop()
            moves = self.moves(state)
            for k, (_, to, before) in enumerate(moves):
                for _, other, start in moves[k + 1:]:
                    found.update((at + before + i, at + start + j) for i, j in self.same(to, other))
                found.update((min(a, b), max(a, b)) for i, j in self.same(state, to) for a, b in [(at + i, at + before + j)])
                open_states.append((to, at + before))
        return found


def _half_keys():
    """Where a word meets others: with words of its length and one more, and with those one shorter, by either half."""
    length = F.length("word")
    keys = []
    for shorter in (length, length - 1):
        half = F.floor(shorter / 2).cast("int")
        keys += [F.struct(F.lit(False).alias("backward"), shorter.alias("shorter"), F.substring("word", F.lit(1), half).alias("half")),
                 F.struct(F.lit(True).alias("backward"), shorter.alias("shorter"), F.reverse(F.substring("word", length - half + 1, half)).alias("half"))]
    return F.array(*keys)


def _near_in_group(backward: bool, shorter: int, words: list[tuple[str, int]]) -> Iterator[tuple[str, int, str, int]]:
    """Pairs ``word, n, near, near_n`` of one partition, each pair once over all partitions.

    Of words that agree in both halves the forward partition reports; pairs of the longer length meet elsewhere.
    """
    half = shorter // 2
    turned = sorted((word[::-1][half:] if backward else word[half:], word, n) for word, n in words)
    for i, j in OneEdit(Acceptor([rest for rest, _, _ in turned])).pairs():
        (_, a, n), (_, b, m) = turned[i], turned[j]
        if min(len(a), len(b)) == shorter and not (backward and a[:half] == b[:half]):
            yield a, n, b, m


def _partitions(counts: DataFrame) -> DataFrame:
    return counts.withColumn("key", F.explode(_half_keys())).select("key.*", "word", "n").repartition(
        "backward", "shorter", "half").sortWithinPartitions("backward", "shorter", "half")


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[bool, int, list[tuple[str, int]]]]:
    each = (row for batch in batches for row in zip(*(column.to_pylist() for column in batch.columns)))
    for (backward, shorter, _), rows in groupby(each, key=lambda row: row[:3]):
        words = [(word, n) for *_, word, n in rows]
        if len(words) > 1:
            yield backward, shorter, words


def near_pairs(counts: DataFrame) -> DataFrame:
    """All pairs of distinct words one edit apart: ``word, n, near, near_n``, each pair once."""
    schema = pa.schema([("word", pa.string()), ("n", pa.int64()), ("near", pa.string()), ("near_n", pa.int64())])

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches):
            if rows := list(_near_in_group(*group)):
                yield pa.RecordBatch.from_arrays([pa.array(column, kind) for column, kind in zip(zip(*rows), schema.types)], schema=schema)

    return _partitions(counts).mapInArrow(pairs, "word string, n long, near string, near_n long")


def near_summary(counts: DataFrame) -> DataFrame:
    """Per word with near words: ``word, n_near`` and ``best``, the most frequent one (ties: the smallest) with its count."""
    schema = pa.schema([("word", pa.string()), ("n_near", pa.int64()), ("best_n", pa.int64()), ("best", pa.string())])

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lines in _chunks(_group_summaries(batches), 20_000):
            yield pa.RecordBatch.from_arrays([pa.array(column, kind) for column, kind in zip(zip(*lines), schema.types)], schema=schema)

    parts = _partitions(counts).mapInArrow(summed, "word string, n_near long, best_n long, best string")
    best = F.min(F.struct((-F.col("best_n")).alias("rank"), F.col("best").alias("word")))
    return parts.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("best")).select(
        "word", "n_near", F.col("best.word").alias("best"), (-F.col("best.rank")).alias("best_n"))


def _group_summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, int, str]]:
    for group in _groups(batches):
        seen: dict[str, int] = {}
        best: dict[str, tuple[int, str]] = {}
        for a, n, b, m in _near_in_group(*group):
            for word, near, count in ((a, b, m), (b, a, n)):
                seen[word] = seen.get(word, 0) + 1
                best[word] = min(best.get(word, (0, "")), (-count, near))
        for word, n_near in seen.items():
            yield word, n_near, -best[word][0], best[word][1]


def _chunks(rows: Iterator, size: int) -> Iterator[list]:
    held = []
    for row in rows:
        held.append(row)
        if len(held) == size:
            yield held
            held = []
    if held:
        yield held


def roots(forms: DataFrame) -> DataFrame:
    """``word, form`` -> ``word, root``: the end of the chain of forms.

    Every round doubles the steps taken. A form is several times as frequent as its word, so chains are as short as the
    logarithm of the largest count.
    """
    reached = stored(forms.select("word", F.col("form").alias("root")), "forms")
    while True:
        onward = reached.select(F.col("word").alias("root"), F.col("root").alias("further"))
        step = stored(reached.join(onward, "root", "left").select(
            "word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "forms")
        if step.where("moved").isEmpty():
            return step.select("word", "root")
        reached = step.select("word", "root")


def spelling_variants(docs: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT, times: int = FORM_TIMES) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of every frequent word of ``docs`` (``doc_id, text``; other columns are ignored).

    ``form`` is the near word with the largest count, ties to the smallest in code-point order, if it has ``times`` the word's own; ``root`` the
    end of the chain of forms. Words of fewer than four letters cannot be asked for: halves would be empty of letters.
    """
    if least_length < 4:
        raise ValueError("words need four letters at least")
    counts = stored(word_counts(docs, least_length, least_count), "words")
    joined = counts.join(near_summary(counts), "word", "left")
    fits = F.col("best_n") >= times * F.col("n")
    named = stored(joined.select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(fits, F.col("best")).alias("form"),
                                 F.when(fits, F.col("best_n")).alias("form_n")), "variants")
    ends = roots(named.where("form IS NOT NULL").select("word", "form"))
    return named.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
