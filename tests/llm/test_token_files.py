"""Files of token ids against the library, and as a format."""

import io
import zlib

import numpy as np
import public_tokenizers
import pytest
import zstandard
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from landfall.llm import queries, token_files
from landfall.llm.common import ship
from landfall.sources.shared import new_folder

FOLDER = "/root/testdata/sf0.001"
VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
SCHEMA = "doc_id long, text string, start long, ids_crc32 string, uid long, file string"
TEXTS = [
    "", " ", "\n", "a", " a", "a ", "a b\nc", "a  b", "a \n b", "a\n\nb", "  a\t b \r\n c", "x.\nY, it's we'll 'd",
    "<|endoftext|>", "a <|endoftext|> b", "a\n<|endoftext|>b <|end oftext|>", "漢字 かな\n한국어 ​ x ᠎ y",
    " a  b  c", "1 22\n333 4,5", "a\x00 b\x1c c\x85 d", "é̂ é \U0001f600 \U0001f600\n\U0001f600",
    "w" * 300 + " " + "v" * 300, "﻿a ﻿ b", "ß ǆ ªº ٣٤ ² Ⅷ", "a b " * 50_000, "x" * 20_000,
]


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(VOCABULARY)
    return lambda text: tokenizer.encode(text, add_special_tokens=False).ids


def expected(rows, library):
    """Rows in order of id (None last); the start of equal ids follows a hash, so it is left out."""
    out, start = [], 0
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        ids = np.array([*library(text or ""), 2], "<u4")
        out.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


def test_texts_in_pieces_have_the_librarys_ids(library, monkeypatch):
    monkeypatch.setattr(token_files, "PIECE", 5)
    known = token_files.Encoder(VOCABULARY)
    assert known.plain
    random = np.random.default_rng(3)
    scraps = []
    for alphabet in ("ab \n\t.,'sÉ1\x00\x85\xa0²", "ab \n.'s1é漢 \u200b\u0301<|>", "aß\u01c6\u00aa\u00ad\x1f ¼_-"):
        scraps += ["".join(random.choice(list(alphabet), random.integers(1, 14))) for _ in range(3000)]
    scraps += [chr(a) + b + chr(c) for a in range(0x250) for b in ("", " ", "'") for c in (0x41, 0x20, 0x31, 0x2E)]
    for text in TEXTS + scraps + TEXTS:
        assert np.frombuffer(known.encode(text), "<u2").tolist() == library(text), text[:50]
    assert not any(len(w) > token_files.LONGEST_WORD for w in known.words)
    monkeypatch.setattr(token_files, "REMEMBERED", 2)
    assert [known.encode(t) for t in TEXTS[:8]] == [token_files.Encoder(VOCABULARY).encode(t) for t in TEXTS[:8]]


def test_another_kind_of_vocabulary(spark):
    path = public_tokenizers.path("word_bpe_49k.json")
    tokenizer = Tokenizer.from_file(path)
    known = token_files.Encoder(path)
    assert not known.plain
    for text in TEXTS:
        found = np.frombuffer(known.encode(text), f"<u{known.width}").tolist()
        assert found == tokenizer.encode(text, add_special_tokens=False).ids


def test_whole_table_is_brute_force(spark, library):
    documents = spark.read.parquet(f"{FOLDER}/documents.parquet")
    found = queries.QUERIES["op12_token_files"](spark, FOLDER).orderBy("start").collect()
    assert [tuple(r) for r in found] == expected(documents.select("doc_id", "text").collect(), library)


def test_odd_rows_over_many_files(spark, library, monkeypatch):
    monkeypatch.setattr(token_files, "FILE_BYTES", 2000)
    monkeypatch.setattr(token_files, "FRAME_IDS", 1000)
    ship(spark)
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(None, None), (None, "a"), (5, "b"), (5, "b"), (-1, None)]
    frame = spark.createDataFrame([(*r, 1, "x", 2, "f") for r in rows], SCHEMA).repartition(4)
    found = token_files.store_documents(frame, VOCABULARY).orderBy("start").collect()
    brute = expected(rows, library)
    key = lambda r: (r[0] is None, r[0] or 0, r[2], r[3])
    assert sorted([(r[0], 0, *r[2:]) for r in found], key=key) == sorted(
        [(r[0], 0, *r[2:]) for r in brute], key=key
    )
    assert [r[0] for r in found] == [r[0] for r in brute]
    assert [r["start"] for r in found] == np.cumsum([0, *(r["n_tokens"] for r in found)])[:-1].tolist()
    assert token_files.store_documents(frame.filter("false"), VOCABULARY).collect() == []


def test_only_frames_asked_for_are_read(spark, library, monkeypatch):
    monkeypatch.setattr(token_files, "FRAME_IDS", 100)
    texts = ["a b c", "d " * 500, "e", "f " * 300]
    known = token_files.Encoder(VOCABULARY)
    ids = [known.encode(t) + b"\x02\x00" for t in texts]
    packed = [token_files.frames_of(i, 2) for i in ids]
    documents = [(k if k != 2 else None, len(i) // 2) for k, i in enumerate(ids)]
    data = b"".join(f for f, _ in packed)
    data += token_files.closing(documents, [e.tobytes() for _, e in packed], 2)

    class Watched(io.BytesIO):
        read_bytes = 0

        def read(self, length=-1):
            self.read_bytes += length
            return super().read(length)

    source = Watched(data)
    file = token_files.TokenFile(source)
    tables = source.read_bytes
    assert file.ids(2).tolist() == [*library("e"), 2]
    assert source.read_bytes - tables == len(packed[2][0])
    assert file.ids(1).tolist() == [*library(texts[1]), 2]
    assert [file.doc_id(k) for k in range(4)] == [0, 1, None, 3]
    # to a plain reader the file is the ids, one frame after the other, and skippable frames
    plain = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(data), read_across_frames=True).read()
    assert plain == b"".join(ids)
    at = len(packed[0][0]) + 20
    broken = data[:at] + bytes([data[at] ^ 1]) + data[at + 1 :]
    assert token_files.TokenFile(io.BytesIO(broken)).ids(0).tolist() == [*library("a b c"), 2]
    with pytest.raises(token_files.TokenFileError):
        token_files.TokenFile(io.BytesIO(broken)).ids(1)
    for cut in (data[:-1], data[:5], data[40:], b""):
        with pytest.raises(token_files.TokenFileError):
            file = token_files.TokenFile(io.BytesIO(cut))
            [file.ids(k) for k in range(4)]


def test_fetch(spark, library):
    ship(spark)
    documents = spark.read.parquet(f"{FOLDER}/documents.parquet")
    folder = new_folder(spark, "ids")
    manifest = token_files.write_files(documents, folder, VOCABULARY, file_bytes=50_000)
    assert manifest.count() > 3
    index = token_files.index_files(manifest, folder)
    assert index.count() == documents.count()
    wanted = documents.filter(F.col("doc_id") % 17 == 3).select("doc_id", "text")
    found = token_files.fetch(index, wanted, folder).collect()
    assert sorted((r.doc_id, r.ids) for r in found) == sorted(
        (r.doc_id, [*library(r.text or ""), 2]) for r in wanted.collect()
    )
