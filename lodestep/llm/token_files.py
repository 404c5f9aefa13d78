"""Token ids in binary files: frequency ranks in byte-aligned variable-length code with separate control bytes."""

from __future__ import annotations

import struct
import sys
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lodestep.session import new_folder, stored

#: Distinct words of which a Python worker remembers the ids.
REMEMBERED = 1_000_000
#: Coded bytes per file, about; files are read whole by one task each.
FILE_BYTES = 8 << 20
END = 0
#: Before each document: its id, whether that is null, its number of ids, bytes of its code.
HEAD = "<q?II"

_TOKENIZERS: dict[str, WordIds] = {}


def byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in a byte-level vocabulary: printable ones for themselves, the rest from U+0100 on."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = [byte for byte in range(256) if byte not in plain]
    return {byte: chr(byte) for byte in plain} | {byte: chr(256 + i) for i, byte in enumerate(others)}


class WordIds(dict):
    """Word with the space before it -> its ids as bytes, for texts whose spaces all start a word.

    A byte-level tokenizer cuts a text into parts by a pattern, before each such space among others, and encodes each part by
    itself: letters with the space before them, runs of other marks. Words of letters repeat, so most are looked up; a
    mark at a word's end is a part of its own. Texts with other white space after a space are cut by the pattern. Texts that
    an added token may occur in are encoded whole by the tokenizer itself.
    """

    def __init__(self, path: str):
        super().__init__()
        import public_tokenizers
        import regex
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.kind, self.code = ("<u2", "H") if self.tokenizer.get_vocab_size() <= 1 << 16 else ("<u4", "I")
        self.tokenize, self.letters = self.tokenizer.model.tokenize, byte_letters()
        self.cut = regex.compile(public_tokenizers.PATTERN).findall
        self.marks = {mark: self.part(mark) for mark in ".,;:!?|"}
        added = self.tokenizer.get_added_tokens_decoder().values()
        self.added = [token.content for token in added if token.content]
        # Normalised tokens are matched in normalised text, which may hold them where the text does not.
        self.whole = self.tokenizer.normalizer is not None and any(token.normalized for token in added)

    def part(self, text: str) -> bytes:
        letters = text.encode("utf-8", "surrogatepass").decode("latin-1").translate(self.letters)
        return self.packed([token.id for token in self.tokenize(letters)])

    def packed(self, found: list[int]) -> bytes:
        ids = array(self.code, found)
        if sys.byteorder == "big":
            ids.byteswap()
        return ids.tobytes()

    def encode(self, text: str) -> bytes:
        return b"".join([self[part[1:]] if part[0] == " " and part[1:].isalpha() else self.part(part) for part in self.cut(text)])

    def __missing__(self, word: str) -> bytes:
        if word.isalpha():
            ids = self.part(" " + word)
        elif word[-1:] in self.marks and word[:-1].isalpha():
            return self[word[:-1]] + self.marks[word[-1]]
        else:
            ids = self.encode(" " + word)
        if len(self) < REMEMBERED:
            self[word] = ids
        return ids

    def ids(self, text: str) -> bytes:
        if self.whole or any(content in text for content in self.added):
            return self.packed(self.tokenizer.encode(text, add_special_tokens=False).ids)
        first, *words = text.split(" ")
        if not all(words) or any(map(str.isspace, {word[0] for word in words})):
            return self.encode(text)
        return self.encode(first) + b"".join(map(self.__getitem__, words))


def tokenizer(path: str) -> WordIds:
    if path not in _TOKENIZERS:
        _TOKENIZERS[path] = WordIds(path)
    return _TOKENIZERS[path]


def encode_texts(docs: DataFrame, path: str) -> DataFrame:
    """``doc_id, n, ids`` per row: ids of the whole text, null as empty, and the end id, as little-endian numbers.

    ``path`` names a byte-level tokenizer of the tokenizers library. Numbers have 16 bits if its vocabulary allows, else 32.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = tokenizer(path)
        end, width = np.array([END], words.kind).tobytes(), np.dtype(words.kind).itemsize
        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                part = batch.slice(i, 256)
                ids = [words.ids(text or "") + end for text in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays([
                    part.column("doc_id"), pa.array([len(x) // width for x in ids], pa.int64()), pa.array(ids, pa.binary())],
                    names=["doc_id", "n", "ids"])
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, n long, ids binary")


def ids_of(column: pa.Array, kind: str) -> tuple[np.ndarray, np.ndarray]:
    """The ids of a batch's documents in a row, and how many each has."""
    ends = np.frombuffer(column.buffers()[1], np.int32)[column.offset:column.offset + len(column) + 1]
    width = np.dtype(kind).itemsize
    if not len(column) or ends[-1] == ends[0]:
        return np.zeros(0, kind), np.zeros(len(column), np.int64)
    held = np.frombuffer(column.buffers()[2], np.uint8)[ends[0]:ends[-1]]
    return held.view(kind) if held.ctypes.data % width == 0 else held.copy().view(kind), np.diff(ends).astype(np.int64) // width


def frequency_ranks(encoded: DataFrame, kind: str) -> np.ndarray:
    """All ids that occur, the most frequent first, ties by id; at most as many as the tokenizer's vocabulary has."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros(0, np.int64)
        for batch in batches:
            found = np.bincount(ids_of(batch.column("ids"), kind)[0])
            if len(found) > len(totals):
                totals = np.concatenate([totals, np.zeros(len(found) - len(totals), np.int64)])
            totals[:len(found)] += found
        some = np.flatnonzero(totals)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(totals[some])], names=["id", "n"])
    counts = encoded.select("ids").mapInArrow(count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))
    return np.array([row["id"] for row in counts.orderBy(F.desc("n"), "id").collect()], np.uint32)


def pack_all(values: np.ndarray, lengths: np.ndarray) -> list[bytes]:
    """Per document control bytes, then data bytes: two bits per value tell whether it takes 1, 2, 3 or 4 bytes.

    ``values`` are those of all documents in a row; only the last slices are taken document by document.
    """
    values = np.ascontiguousarray(values, "<u4")
    width = ((values > 0xFF).view(np.uint8) + (values > 0xFFFF) + (values > 0xFFFFFF)).astype(np.uint8)
    quads = -(-lengths // 4)
    first, place = np.cumsum(lengths) - lengths, np.cumsum(quads) - quads
    padded = np.zeros(int(quads.sum()) * 4, np.uint8)
    padded[np.arange(len(values)) + np.repeat(4 * place - first, lengths)] = width
    control = (padded.reshape(-1, 4) << np.array([0, 2, 4, 6], np.uint8)).sum(1).astype(np.uint8).tobytes()
    data = values.view(np.uint8).reshape(-1, 4)[np.arange(4) <= width[:, None]].tobytes()
    ends = np.concatenate([[0], np.cumsum(width.astype(np.int64) + 1)])
    bounds = zip(place.tolist(), (place + quads).tolist(), ends[first].tolist(), ends[first + lengths].tolist())
    return [control[a:b] + data[c:d] for a, b, c, d in bounds]


def pack(values: np.ndarray) -> bytes:
    return pack_all(values, np.array([len(values)]))[0]


#: For each control byte, how many bytes its four values take.
WIDTHS = (np.arange(256)[:, None] >> np.array([0, 2, 4, 6]) & 3) + 1
MASKS = np.array([0xFF, 0xFFFF, 0xFFFFFF, 0xFFFFFFFF], np.uint32)


def unpack(code: bytes, n: int) -> np.ndarray:
    """The ``n`` values of :func:`pack`, by looking up widths and masks."""
    controls = -(-n // 4)
    width = WIDTHS[np.frombuffer(code, np.uint8, controls)].ravel()[:n]
    starts = np.cumsum(width) - width
    data = np.frombuffer(code + bytes(4), np.uint8)[controls:].astype(np.uint32)
    wide = data[:-3] | data[1:-2] << 8 | data[2:-1] << 16 | data[3:] << 24
    return wide[starts] & MASKS[width - 1]


def write_token_files(docs: DataFrame, folder: str, path: str, file_bytes: int = FILE_BYTES) -> np.ndarray:
    """Write the ids of all rows to binary files in ascending order of ``doc_id`` (null first), and the ranked ids beside them.

    A file is a sequence of documents: ``HEAD``, control bytes, data bytes, a line end. Ids are replaced by their rank
    by frequency in all texts, so the most frequent 256 take one byte. Files are named in order of their documents;
    rows with one id stand in order of their code, in one file. Quantiles of the ids make files of about ``file_bytes``. Spark's
    text writer writes the records, so they get wherever Spark writes and survive lost tasks.
    """
    encoded, kind = stored(encode_texts(docs, path), "ids", "zstd"), tokenizer(path).kind
    ranked = frequency_ranks(encoded, kind)
    rank = np.zeros(int(ranked.max(initial=0)) + 1, np.uint32)
    rank[ranked] = np.arange(len(ranked))

    total = encoded.agg(F.sum("n")).first()[0] or 0
    files = int(1 + total * 1.5 // file_bytes)
    shares = [i / files for i in range(1, files)]
    bounds = np.array((shares and encoded.agg(F.percentile_approx("doc_id", shares, 100 * files)).first()[0]) or [], np.int64)

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                part = batch.slice(i, 256)
                doc_ids = part.column("doc_id").to_pylist()
                ids, lengths = ids_of(part.column("ids"), kind)
                records = [struct.pack(HEAD, doc_id or 0, doc_id is None, n, len(packed)) + packed
                           for doc_id, n, packed in zip(doc_ids, lengths.tolist(), pack_all(rank[ids], lengths))]
                ranges = [0 if doc_id is None else int(np.searchsorted(bounds, doc_id)) for doc_id in doc_ids]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(records, pa.binary()), pa.array(ranges, pa.int32())],
                                                 names=["doc_id", "record", "range"])

    # Bounds come from the ids alone; a range partitioner would code every text twice, once to sample.
    coded = encoded.select("doc_id", "ids").mapInArrow(code, "doc_id long, record binary, range int")
    coded.repartitionById(files, F.col("range")).sortWithinPartitions("doc_id", "record").select(
        F.col("record").cast("string").alias("value")).write.option("lineSep", "\n").text(f"{folder}/documents")
    docs.sparkSession.createDataFrame([(rank, int(x)) for rank, x in enumerate(ranked)], "rank long, id long").coalesce(1).write.parquet(
        f"{folder}/ranks")
    return ranked


def read_token_files(spark, folder: str, with_ids: bool = True) -> DataFrame:
    """``file, place, doc_id, n, before, crc32, ids`` of each document in the files; ``before`` counts ids before it in its file.

    Without ``with_ids`` the ids are decoded and checked, but do not leave the task.
    """
    ranked = np.array([row["id"] for row in spark.read.schema("rank long, id long").parquet(f"{folder}/ranks").orderBy("rank").collect()], np.uint32)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column("path").to_pylist(), batch.column("content")):
                data, at, before, rows = memoryview(content.as_buffer()), 0, 0, []
                while at < len(data):
                    doc_id, null, n, size = struct.unpack_from(HEAD, data, at)
                    at += struct.calcsize(HEAD)
                    ids = ranked[unpack(bytes(data[at:at + size]), n)].astype("<u4").tobytes()
                    at += size + 1
                    rows.append((name, len(rows), None if null else doc_id, n, before, zlib.crc32(ids), *([ids] if with_ids else [])))
                    before += n
                    if len(rows) % 256 == 0:
                        yield batch_of(rows[-256:])
                if len(rows) % 256:
                    yield batch_of(rows[-(len(rows) % 256):])

    schema = "file string, place long, doc_id long, n long, before long, crc32 long" + (", ids binary" if with_ids else "")
    names = [part.split()[0] for part in schema.split(", ")]
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()][:len(names)]

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(x, kind) for x, kind in zip(zip(*rows), kinds)], names=names)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(f"{folder}/documents")
    return files.select("path", "content").mapInArrow(decode, schema)


def token_index(spark, folder: str) -> DataFrame:
    """Per document of the files: ``doc_id, start, n_tokens, ids_crc32``; ``start`` counts the ids of all documents before it."""
    rows = stored(read_token_files(spark, folder, with_ids=False), "index")
    files = rows.groupBy("file").agg(F.sum("n").alias("file_n"))
    earlier = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    offsets = files.select("file", F.coalesce(F.sum("file_n").over(earlier), F.lit(0)).alias("offset"))
    return rows.join(offsets, "file").select(
        "doc_id", (F.col("offset") + F.col("before")).alias("start"), F.col("n").alias("n_tokens"), F.col("crc32").alias("ids_crc32"))


def token_output(docs: DataFrame, path: str) -> DataFrame:
    """Write the token files of ``docs`` to a new folder in the shared one, read them back and return :func:`token_index`.

    Needs ``doc_id`` and ``text``; other columns are ignored. Null and empty texts have the end id alone. Repeated
    rows are documents of their own. An empty table makes files without documents.
    """
    folder = new_folder(docs.sparkSession, "tokens")
    write_token_files(docs, folder, path)
    return token_index(docs.sparkSession, folder)
