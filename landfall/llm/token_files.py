"""Token ids in files of independent zstandard frames, with a seek table at the end.

A file holds whole documents in their order. Each document is one or more frames of at
most `FRAME_IDS` ids, compressed on their own. Two skippable frames close the file: the
documents' ids and lengths, and a seek table (compressed size, size and checksum of
every frame) of the public seekable layout of zstandard, which other readers of that
layout understand as well. A reader takes the tables from the end of the file, then
only the frames of the documents asked for, and holds each against its checksum.

Encoding is the tokenizers library's, with the vocabulary of a file. With a byte-level
vocabulary, a long text goes in pieces, cut where the vocabulary's splitting rule always
cuts: before a blank between two solid characters. Where a text has no characters beyond
U+024F and no special token, its parts are split here by that same rule, and the
library's model encodes each part that the worker does not remember. The ids are always
those of the whole text.

Documents are encoded and compressed where they are read; what is shuffled into order is
ids, not text. The order is the document id, then a hash of the text, then the place in
the table, so rows of one id, or of none, spread over many files. A task that runs again
writes files of other names, and the manifest lists those of the run that counted.

Edge cases: a NULL text is an empty one, of the end id alone. Rows of NULL id come last.
Rows that repeat an id are documents of their own; equal ones differ in `start` only.
Empty tables give empty results and no file. Other columns are never looked at. A text
without any place to cut goes in one piece.
"""

from __future__ import annotations

import json
import re
import struct
import uuid
import zlib
from collections.abc import Iterator
from functools import cache
from typing import BinaryIO

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.shared import new_folder
from .common import saved, text_of
from .warc import store_of

END_ID = 2
FRAME_IDS = 1 << 16
FILE_BYTES = 32 << 20
LEVEL = 3
# Parts a worker remembers, the longest of them, and characters of a long text's piece.
REMEMBERED = 800_000
LONGEST_WORD = 64
PIECE = 1 << 20
# Fixed values of the seekable layout: both skippable frames' marks, the footer's.
SEEK_MARK, TABLE_MARK, FOOTER_MARK = 0x184D2A5E, 0x184D2A50, 0x8F92EAB1
CHECKED = 0x80
_FRAME = struct.Struct("<II")
_ENTRY = np.dtype([("packed", "<u4"), ("size", "<u4"), ("check", "<u4")])
_FOOTER = struct.Struct("<IBI")
_TABLE = struct.Struct("<4sBQ")
_DOCUMENT = np.dtype([("doc_id", "<i8"), ("known", "u1"), ("n_tokens", "<u8")])
NAME = b"LFTK"


class TokenFileError(ValueError):
    """A file that is not what it says."""


# ---------------------------------------------------------------- encoding

# A blank between two solid characters, solid to any reading of what a blank is: the
# splitting rule of byte-level BPE always cuts before it.
_SOLID = "[^\\s\u180e\u200b\ufeff]"
_CUT = re.compile(rf" (?={_SOLID})(?<={_SOLID} )")
# Letters, numbers and blanks up to U+024F, and that splitting rule over them.
_FAR = re.compile("[^\0-\u024f]")
_L, _N, _S = "A-Za-z\u00aa\u00b5\u00ba\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f", "0-9\u00b2\u00b3\u00b9\u00bc-\u00be", "\\t-\\r \u0085\u00a0"
_PARTS = re.compile(
    rf" ?[{_L}]+|'(?:[stmd]|re|ve|ll)| ?[{_N}]+| ?[^{_L}{_N}{_S}]+|[{_S}]+(?![^{_S}])|[{_S}]+"
)


def byte_letters() -> dict[int, int]:
    """The character that stands for each byte: printable ones for themselves, others from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in shown]
    return {b: b for b in shown} | {b: 0x100 + k for k, b in enumerate(others)}


class Words(dict):
    """Ids of parts of text, by the model of a byte-level vocabulary; new ones are worked out."""

    def __init__(self, tokenizer, kind: str):
        super().__init__()
        self.model, self.kind, self.letters = tokenizer.model, kind, byte_letters()

    def __missing__(self, part: str) -> bytes:
        letters = part.encode().decode("latin-1").translate(self.letters)
        ids = np.array([t.id for t in self.model.tokenize(letters)], self.kind).tobytes()
        if len(part) <= LONGEST_WORD:
            self[part] = ids
        return ids


class Encoder:
    """Ids of texts, as little-endian bytes of `width` an id."""

    def __init__(self, vocabulary: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(vocabulary)
        self.width = width_of(self.tokenizer.get_vocab_size())
        rules = json.loads(self.tokenizer.to_str())
        split = rules["pre_tokenizer"] or {}
        self.plain = (
            (rules["normalizer"], rules["model"]["type"], split.get("type")) == (None, "BPE", "ByteLevel")
            and split["use_regex"]
            and not split["add_prefix_space"]
        )
        self.special = [t["content"] for t in rules["added_tokens"]]
        self.words = Words(self.tokenizer, f"<u{self.width}")

    def _whole(self, piece: str) -> bytes:
        found = self.tokenizer.encode_batch_fast([piece], add_special_tokens=False)[0]
        return np.array(found.ids, f"<u{self.width}").tobytes()

    def encode(self, text: str) -> bytes:
        """Text of the characters the parts are known for goes part by part, other text as it is."""
        if not self.plain:
            return self._whole(text)
        if len(self.words) > REMEMBERED:
            self.words.clear()
        known = (text.isascii() or not _FAR.search(text)) and not any(s in text for s in self.special)
        out = []
        for piece in pieces_of(text):
            if known:
                out.append(b"".join(map(self.words.__getitem__, _PARTS.findall(piece))))
            else:
                out.append(self._whole(piece))
        return b"".join(out)


def pieces_of(text: str) -> Iterator[str]:
    """The text in pieces of about `PIECE` characters, cut where the splitting rule cuts."""
    at = 0
    while cut := _CUT.search(text, at + PIECE):
        yield text[at : cut.start()]
        at = cut.start()
    yield text[at:]


def width_of(ids: int) -> int:
    return 2 if ids <= 1 << 16 else 4


@cache
def encoder_of(vocabulary: str) -> Encoder:
    return Encoder(vocabulary)


def frames_of(ids: bytes, width: int) -> tuple[bytes, np.ndarray]:
    """Frames of a document's ids, one after the other, and their entries of the seek table."""
    packer = zstandard.ZstdCompressor(level=LEVEL, write_content_size=True)
    step, frames, entries = FRAME_IDS * width, [], []
    for at in range(0, len(ids), step):
        piece = ids[at : at + step]
        frames.append(packer.compress(piece))
        check = xxhash.xxh64_intdigest(piece) & 0xFFFFFFFF
        entries.append((len(frames[-1]), len(piece), check))
    return b"".join(frames), np.array(entries, _ENTRY)


ENCODED = "n_tokens long, frames binary, entries binary"


def encoded(text: Column, vocabulary: str) -> Column:
    """A struct of a text's number of ids, its frames and their entries; the end id is added."""

    @F.arrow_udf(returnType=ENCODED)
    def encode(texts: pa.Array) -> pa.Array:
        known = encoder_of(vocabulary)
        end = np.array([END_ID], f"<u{known.width}").tobytes()
        counts, frames, entries = [], [], []
        for text in texts:
            ids = known.encode(text.as_py()) + end
            packed, table = frames_of(ids, known.width)
            counts.append(len(ids) // known.width)
            frames.append(packed)
            entries.append(table.tobytes())
        return pa.StructArray.from_arrays(
            [pa.array(counts, pa.int64()), pa.array(frames, pa.binary()), pa.array(entries, pa.binary())],
            ["n_tokens", "frames", "entries"],
        )

    return encode(text)


# ---------------------------------------------------------------- files


def closing(documents: list[tuple[int | None, int]], entries: list[bytes], width: int) -> bytes:
    """The two skippable frames that close a file."""
    rows = np.array([(i or 0, i is not None, n) for i, n in documents], _DOCUMENT)
    table = _TABLE.pack(NAME, width, len(rows)) + rows.tobytes()
    table = _FRAME.pack(TABLE_MARK, len(table)) + table
    own = np.array([(len(table), 0, xxhash.xxh64_intdigest(b"") & 0xFFFFFFFF)], _ENTRY)
    seek = b"".join([*entries, own.tobytes()])
    footer = _FOOTER.pack(len(seek) // _ENTRY.itemsize, CHECKED, FOOTER_MARK)
    return table + _FRAME.pack(SEEK_MARK, len(seek) + len(footer)) + seek + footer


class TokenFile:
    """A file's documents, each read by its place, from an open file that can seek."""

    def __init__(self, source: BinaryIO):
        self.source = source
        size = source.seek(0, 2)
        if size < _FOOTER.size:
            raise TokenFileError("the file is too short")
        count, flags, mark = _FOOTER.unpack(self._bytes(size - _FOOTER.size, _FOOTER.size))
        if mark != FOOTER_MARK or flags != CHECKED or not count:
            raise TokenFileError("the file does not end in a seek table")
        length = count * _ENTRY.itemsize + _FOOTER.size
        start = size - length - _FRAME.size
        if start < 0 or _FRAME.unpack(self._bytes(start, _FRAME.size)) != (SEEK_MARK, length):
            raise TokenFileError("the seek table is not as long as it says")
        entries = np.frombuffer(self._bytes(start + _FRAME.size, length - _FOOTER.size), _ENTRY)
        self.offsets = np.concatenate([[0], np.cumsum(entries["packed"], dtype=np.int64)])
        if self.offsets[-1] != start:
            raise TokenFileError("the frames are not as long as the seek table says")
        table = self._bytes(int(self.offsets[-2]), int(entries["packed"][-1]))
        mark, length = _FRAME.unpack(table[: _FRAME.size])
        name, self.width, documents = _TABLE.unpack(table[_FRAME.size : _FRAME.size + _TABLE.size])
        if (mark, length, name) != (TABLE_MARK, len(table) - _FRAME.size, NAME):
            raise TokenFileError("the table of documents is broken")
        self.entries = entries[:-1]
        self.documents = np.frombuffer(table[_FRAME.size + _TABLE.size :], _DOCUMENT)
        frames = -(-self.documents["n_tokens"].astype(np.int64) // FRAME_IDS)
        self.frames = np.concatenate([[0], np.cumsum(frames)])
        if len(self.documents) != documents or self.frames[-1] != len(self.entries):
            raise TokenFileError("the documents do not fill the frames")
        # starts within the file, of each document and of what follows the last
        self.starts = np.concatenate([[0], np.cumsum(self.documents["n_tokens"].astype(np.int64))])

    def _bytes(self, at: int, length: int) -> bytes:
        self.source.seek(at)
        data = self.source.read(length)
        if len(data) != length:
            raise TokenFileError("the file ends within a frame")
        return data

    def doc_id(self, place: int) -> int | None:
        row = self.documents[place]
        return int(row["doc_id"]) if row["known"] else None

    def pieces(self, place: int) -> Iterator[np.ndarray]:
        """A document's ids, frame by frame; no other frame is read."""
        unpacker = zstandard.ZstdDecompressor()
        left = int(self.documents["n_tokens"][place])
        for frame in range(int(self.frames[place]), int(self.frames[place + 1])):
            entry = self.entries[frame]
            packed = self._bytes(int(self.offsets[frame]), int(entry["packed"]))
            try:
                ids = unpacker.decompress(packed, max_output_size=int(entry["size"]))
            except zstandard.ZstdError as error:
                raise TokenFileError(f"a frame cannot be read: {error}") from error
            if len(ids) != entry["size"] or xxhash.xxh64_intdigest(ids) & 0xFFFFFFFF != entry["check"]:
                raise TokenFileError("a frame does not match its checksum")
            found = np.frombuffer(ids, f"<u{self.width}").astype("<u4")
            left -= len(found)
            yield found
        if left:
            raise TokenFileError("a document is not as long as it says")

    def ids(self, place: int) -> np.ndarray:
        return np.concatenate(list(self.pieces(place)))


MANIFEST = "part int, number int, file string, documents long, ids long"


def write_files(
    documents: DataFrame, folder: str, vocabulary: str, file_bytes: int | None = None
) -> DataFrame:
    """Encode the documents and write them in order below a shared folder; the manifest.

    `start` of a file is the number of ids in all files before it.
    """
    file_bytes = file_bytes or FILE_BYTES
    text = text_of()
    rows = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.xxhash64(text).alias("tie"),
        F.monotonically_increasing_id().alias("uid"),
        text.alias("text"),
    )
    rows = rows.withColumn("found", encoded(F.col("text"), vocabulary))
    rows = saved(rows.select("doc_id", "tie", "uid", "found.*"), "encoded")
    size = rows.agg(F.sum(F.octet_length("frames"))).first()[0] or 0
    order = (F.asc_nulls_last("doc_id"), "tie", "uid")
    spread = rows.repartitionByRange(1 + size // file_bytes, *order).sortWithinPartitions(*order)
    width = encoder_of(vocabulary).width

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, path = store_of(folder)
        store.create_dir(path, recursive=True)
        part, attempt = TaskContext.get().partitionId(), uuid.uuid4().hex
        out, held, entries, done = None, [], [], []

        def close() -> None:
            out.write(closing(held, entries, width))
            out.close()
            done.append((part, len(done), name, len(held), sum(n for _, n in held)))

        for batch in batches:
            columns = (batch.column(c) for c in ("doc_id", "n_tokens", "frames", "entries"))
            for row in zip(*columns, strict=True):
                doc_id, n_tokens, frames, table = (x.as_py() for x in row)
                if out is None:
                    name, held, entries = f"{part:06d}-{len(done):04d}-{attempt}.ids", [], []
                    out = store.open_output_stream(f"{path}/{name}", compression=None)
                out.write(frames)
                held.append((doc_id, n_tokens))
                entries.append(table)
                if out.tell() >= file_bytes:
                    close()
                    out = None
        if out is not None:
            close()
        yield pa.RecordBatch.from_pylist(
            [dict(zip(("part", "number", "file", "documents", "ids"), d, strict=True)) for d in done],
            pa.schema(
                [("part", pa.int32()), ("number", pa.int32()), ("file", pa.string())]
                + [("documents", pa.int64()), ("ids", pa.int64())]
            ),
        )

    manifest = saved(spread.select("doc_id", "n_tokens", "frames", "entries").mapInArrow(write, MANIFEST), "manifest")
    before = Window.orderBy("part", "number").rowsBetween(Window.unboundedPreceding, -1)
    return manifest.withColumn("start", F.coalesce(F.sum("ids").over(before), F.lit(0)))


READ = "doc_id long, start long, n_tokens long, ids_crc32 long"


def read_files(manifest: DataFrame, folder: str) -> DataFrame:
    """All documents of the files a manifest lists, each file read by one task."""

    def rows(file: TokenFile, row: dict) -> Iterator[tuple]:
        if (len(file.documents), int(file.starts[-1])) != (row["documents"], row["ids"]):
            raise TokenFileError(f"{row['file']} holds other documents than the manifest says")
        for place in range(len(file.documents)):
            check = 0
            for ids in file.pieces(place):
                check = zlib.crc32(ids.tobytes(), check)
            start = row["start"] + int(file.starts[place])
            yield file.doc_id(place), start, int(file.documents["n_tokens"][place]), check

    return _opened(manifest, folder, rows, READ)


INDEX = "file string, place long, doc_id long, n_tokens long"


def index_files(manifest: DataFrame, folder: str) -> DataFrame:
    """Where each document lies; only the tables at the files' ends are read."""

    def rows(file: TokenFile, row: dict) -> Iterator[tuple]:
        for place in range(len(file.documents)):
            yield row["file"], place, file.doc_id(place), int(file.documents["n_tokens"][place])

    return _opened(manifest, folder, rows, INDEX)


def fetch(index: DataFrame, wanted: DataFrame, folder: str) -> DataFrame:
    """`doc_id` and `ids` of the documents `wanted` names; no frame of another is read."""
    asked = index.join(wanted.select("doc_id").distinct(), "doc_id", "left_semi")
    asked = asked.groupBy("file").agg(F.sort_array(F.collect_list("place")).alias("places"))

    def rows(file: TokenFile, row: dict) -> Iterator[tuple]:
        for place in row["places"]:
            yield file.doc_id(place), file.ids(place).tolist()

    return _opened(asked, folder, rows, "doc_id long, ids array<long>")


# Rows a task hands on at a time.
ROWS = 4096


def _opened(files: DataFrame, folder: str, rows, schema: str) -> DataFrame:
    """What `rows` makes of each file, opened by its task."""
    names = [c.split()[0] for c in schema.split(", ")]
    kinds = {"string": pa.string(), "long": pa.int64(), "array<long>": pa.list_(pa.int64())}
    columns = pa.schema([(c.split()[0], kinds[c.split()[1]]) for c in schema.split(", ")])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, path = store_of(folder)
        for batch in batches:
            for row in batch.to_pylist():
                with store.open_input_file(f"{path}/{row['file']}") as source:
                    some = []
                    for found in rows(TokenFile(source), row):
                        some.append(dict(zip(names, found, strict=True)))
                        if len(some) == ROWS:
                            yield pa.RecordBatch.from_pylist(some, columns)
                            some = []
                    yield pa.RecordBatch.from_pylist(some, columns)

    spread = files.repartition(max(1, files.count()), "file")
    return spread.mapInArrow(read, schema)


def store_documents(documents: DataFrame, vocabulary: str) -> DataFrame:
    """Write all documents' ids below the shared folder, and read the files back."""
    folder = new_folder(documents.sparkSession, "ids")
    return read_files(write_files(documents, folder, vocabulary), folder)
