"""Chat formatting: a template rendered turn by turn as a black box, its output compared to find every turn's span.

A template is any function of a list of ``(role, text)`` that returns a string. Nothing is known about it: the turns
are rendered as growing prefixes, and where two successive outputs part, one turn ends and the next begins. The text
inside a turn lies where the outputs for two probe texts differ. A template that changes what it has already
written, up to the end of the turn before, rewrites history; its rows say so.

Long conversations are cut by turn number into blocks that know a few turns before and one after, so a
conversation of any length is formatted by many tasks, each holding a bounded window of rows.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestep.session import stored

Turn = tuple[str, str]
Template = Callable[[list[Turn]], str]

#: Turns of a block, and how many before it are rendered with it.
BLOCK = 64
BEFORE = 2

_HEAD, _TAIL = "### ", "\n</turn>\n"
_HEADER = re.compile(r"### ((?:\\.|[^\\:])*):\n", re.S)
PIECES = ("conv_id long, turn long, place int, piece string, text_from int, text_to int, in_loss boolean, rewrites boolean")


def escape(text: str) -> str:
    """``text`` without the template's control strings; a backslash marks what is escaped, itself included."""
    return text.replace("\\", "\\\\").replace(_HEAD, "\\" + _HEAD).replace("</turn>", "\\</turn>")


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.S) if "\\" in text else text


def marked_turns(turns: list[Turn]) -> str:
    """The default template: ``### role:``, the escaped text, ``</turn>``, each on lines of its own."""
    return "".join(f"{_HEAD}{escape(role).replace(':', '\\:')}:\n{escape(text)}{_TAIL}" for role, text in turns)


def parse(formatted: str) -> Iterator[tuple[str, str, int, int]]:
    """``role, text`` of each turn of the default template's output, and from where to where its escaped text goes."""
    at = 0
    while at < len(formatted):
        header = _HEADER.match(formatted, at)
        end = formatted.find(_TAIL, header.end()) if header else -1
        if end < 0:
            raise ValueError(f"no turn at {at}")
        yield unescape(header[1]), unescape(formatted[header.end():end]), header.end(), end
        at = end + len(_TAIL)


def common_prefix(a: str, b: str) -> int:
    """How many characters two strings share from the left, by halving."""
    if b.startswith(a):
        return len(a)
    low, high = 0, min(len(a), len(b))
    while low < high:
        middle = (low + high + 1) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle - 1
    return low


def common_suffix(a: str, b: str) -> int:
    n = 0
    while n < min(len(a), len(b)) and a[-1 - n] == b[-1 - n]:
        n += 1
    return n


def locate(turns: list[Turn], template: Template) -> tuple[str, list[tuple[int, int, int, int, bool]]]:
    """The output for ``turns``, and per turn its span, its text's span and whether it rewrites what stood before it.

    Spans adjoin and cover the output. The probes differ in their first and last character, so the text lies between
    what their outputs share, whatever it holds itself.
    """
    outputs = [""] + [template(turns[:k + 1]) for k in range(len(turns))]
    edges = [0] + [common_prefix(outputs[k], outputs[k + 1]) for k in range(1, len(turns))] + [len(outputs[-1])]
    found, text_end = [], 0
    for k, (role, _) in enumerate(turns):
        one, other = (template([*turns[:k], (role, probe)]) for probe in ("a", "b"))
        start, after = common_prefix(one, other), common_suffix(one, other)
        found.append((edges[k], edges[k + 1], start, len(outputs[k + 1]) - after, edges[k] < text_end or edges[k] > start))
        text_end = found[-1][3]
    return outputs[-1], found


def _pieces(rows: list[dict], first: int, last: int, place: int, template: Template, loss_roles: frozenset) -> list[dict]:
    """Rows ``first`` to ``last`` of a window as pieces of the formatted conversation."""
    output, spans = locate([(row["role"] or "", row["text"] or "") for row in rows], template)
    pieces = []
    for i in range(first, last):
        start, end, text_from, text_to, rewrites = spans[i]
        pieces.append({"conv_id": rows[i]["conv_id"], "turn": rows[i]["turn"], "place": place + i - first, "piece": output[start:end],
                       "text_from": text_from - start, "text_to": text_to - start, "in_loss": rows[i]["role"] in loss_roles, "rewrites": rewrites})
    return pieces


def _format_block(rows: Iterator[dict], template: Template, loss_roles: frozenset) -> Iterator[list[dict]]:
    """The pieces of one block's own rows, in windows of ``BEFORE`` + ``BLOCK`` + 1 rows at most, whatever the block holds."""
    window, place, after = [], 0, False
    own = 0  # where the window's own rows begin
    for row in rows:
        if row["own"] < 0:
            window = [*window, row][-BEFORE:]
            own = len(window)
            continue
        window.append(row)
        if row["own"] > 0:
            after = True
            break
        if len(window) - own > BLOCK:
            yield _pieces(window, own, len(window) - 1, place, template, loss_roles)
            place += len(window) - 1 - own
            window = window[-1 - BEFORE:]
            own = len(window) - 1
    end = len(window) - after
    if end > own:
        yield _pieces(window, own, end, place, template, loss_roles)


def format_conversations(rows: DataFrame, template: Template = marked_turns, loss_roles: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """``conv_id, turn, role, text`` -> one row per turn: its ``piece`` of the formatted conversation and where the text lies in it.

    A conversation's output is its pieces in the order of ``turn, place``; ``text_from`` to ``text_to`` is the loss mask where
    ``in_loss``. Rows of a conversation go by turn (null first), equal turns by role and text, all kept. Null role or text
    reads as empty, a null ``conv_id`` as a conversation of its own; other columns are ignored. A turn is rendered after
    the turns of its block and up to two turns before it; where turn numbers leave a block's length free, what follows starts anew.
    """
    lead = F.pmod("turn", F.lit(BLOCK))
    block = F.floor(F.col("turn") / BLOCK)
    homes = F.array_compact(F.array(
        F.struct(block.alias("block"), F.lit(0).alias("own")),
        F.when(lead >= BLOCK - BEFORE, F.struct((block + 1).alias("block"), F.lit(-1).alias("own"))),
        F.when(lead == 0, F.struct((block - 1).alias("block"), F.lit(1).alias("own")))))
    slim = rows.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), F.col("role").cast("string"), F.col("text").cast("string"))
    dealt = (slim.withColumn("home", F.explode(homes)).select("conv_id", "turn", "role", "text", "home.block", "home.own")
             .repartition("conv_id", "block").sortWithinPartitions("conv_id", "block", "turn", "role", "text"))
    roles = frozenset(loss_roles)
    schema = pa.schema([("conv_id", pa.int64()), ("turn", pa.int64()), ("place", pa.int32()), ("piece", pa.string()), ("text_from", pa.int32()),
                        ("text_to", pa.int32()), ("in_loss", pa.bool_()), ("rewrites", pa.bool_())])

    def formatted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        each = (row for batch in batches for row in batch.to_pylist())
        held: list[dict] = []
        for _, block_rows in groupby(each, key=lambda row: (row["conv_id"], row["block"])):
            for pieces in _format_block(block_rows, template, roles):
                held += pieces
                if len(held) >= 2_000:
                    yield pa.RecordBatch.from_pylist(held, schema)
                    held = []
        if held:
            yield pa.RecordBatch.from_pylist(held, schema)

    return dealt.mapInArrow(formatted, PIECES)


class _Digest:
    """Running figures of one conversation."""

    def __init__(self):
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()
        self.n_turns = self.loss_chars = self.formatted_chars = 0

    def add(self, row: dict) -> None:
        self.formatted_chars += len(row["piece"])
        for role, text, _, _ in parse(row["piece"]):
            self.n_turns += 1
            self.turns.update(f"{role}\n{text}\n".encode())
        if row["in_loss"]:
            masked = unescape(row["piece"][row["text_from"]:row["text_to"]])
            self.loss_chars += len(masked)
            self.loss.update(masked.encode())

    def row(self, conv_id) -> dict:
        return {"conv_id": conv_id, "n_turns": self.n_turns, "turns_sha256": self.turns.hexdigest(), "loss_chars": self.loss_chars,
                "loss_sha256": self.loss.hexdigest(), "formatted_chars": self.formatted_chars}


def read_back(pieces: DataFrame) -> DataFrame:
    """Per conversation of the default template's pieces: turns, a digest of them, and what stands under the loss mask.

    A digest needs its conversation in order, so the pieces stream through one task; only running digests are held.
    """
    schema = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()),
                        ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        each = (row for batch in batches for row in batch.to_pylist())
        done: list[dict] = []
        for conv_id, rows in groupby(each, key=lambda row: row["conv_id"]):
            digest = _Digest()
            for row in rows:
                digest.add(row)
            done.append(digest.row(conv_id))
            if len(done) >= 10_000:
                yield pa.RecordBatch.from_pylist(done, schema)
                done = []
        if done:
            yield pa.RecordBatch.from_pylist(done, schema)

    ordered = pieces.select("conv_id", "turn", "place", "piece", "text_from", "text_to", "in_loss").repartition("conv_id").sortWithinPartitions(
        "conv_id", "turn", "place")
    return ordered.mapInArrow(digests, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


def format_and_read(rows: DataFrame) -> DataFrame:
    """The conversations formatted, stored, and read back."""
    return read_back(stored(format_conversations(rows), "formatted", "zstd"))
