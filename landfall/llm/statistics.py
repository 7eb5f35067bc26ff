"""Counts over whole texts, and the features made of them."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import BLANK, numbered, text_of

SYMBOLS = b"#*$%&|<>"
COUNTS = (
    "n_words",
    "word_chars",
    "n_symbols",
    "n_dup_lines",
    "n_repeat_words",
    "n_lines",
    "n_distinct",
    "n_upper",
    "n_digits",
    "n_punctuation",
    "n_stops",
    "n_short",
    "n_bytes",
    "most_common",
)
COUNTS_TYPE = T.StructType([T.StructField(name, T.LongType(), False) for name in COUNTS])
_UPPER = bytes(range(65, 91))
_DIGITS = b"0123456789"
_PUNCTUATION = rb"""!"'(),-./:;?@[\]^_`{}~+="""
_STOPS = b".!?"


def count_text(text: str) -> tuple[int, ...]:
    """The counts of one text, in the order of COUNTS.

    Words are runs of anything but ASCII blanks. A line counts as repeated if it
    has a word and equals an earlier line of the text.
    """
    raw = text.encode()
    words = raw.split()
    n = len(words)
    of = lambda kind: len(raw) - len(raw.translate(None, kind))
    lines = [line for line in raw.split(b"\n") if line.strip()]
    known: dict[bytes, int] = {}
    ids = numbered(words, known)
    repeated = 0
    if n >= 3:
        size = len(known) + 1
        keys = (ids[:-2] * size + ids[1:-1]) * size + ids[2:]
        order = np.argsort(keys, kind="stable")
        same = keys[order][1:] == keys[order][:-1]
        again = np.zeros(n - 2, bool)
        again[order[1:][same]] = True
        again[order[:-1][same]] = True
        covered = np.zeros(n, bool)
        for shift in range(3):
            covered[shift : n - 2 + shift] |= again
        repeated = int(covered.sum())
    lengths = np.fromiter(map(len, words), np.int64, n)
    return (
        n,
        len(text) - of(BLANK),
        of(SYMBOLS),
        len(lines) - len(set(lines)),
        repeated,
        len(lines),
        len(known),
        of(_UPPER),
        of(_DIGITS),
        of(_PUNCTUATION),
        of(_STOPS),
        int((lengths <= 3).sum()),
        len(raw),
        int(np.bincount(ids).max()) if n else 0,
    )


def text_counts(text: str = "text") -> Column:
    """A struct of COUNTS for each whole text; NULL counts as empty."""

    @F.arrow_udf(returnType=COUNTS_TYPE)
    def counts(texts: pa.Array) -> pa.Array:
        rows = np.array([count_text(x.as_py()) for x in texts], np.int64).reshape(-1, len(COUNTS))
        columns = [pa.array(rows[:, i]) for i in range(len(COUNTS))]
        fields = [pa.field(name, pa.int64(), False) for name in COUNTS]
        return pa.StructArray.from_arrays(columns, fields=fields)

    return counts(text_of(text))


FEATURES = (
    "word_length",
    "symbols",
    "dup_lines",
    "repeat_words",
    "distinct",
    "upper",
    "digits",
    "punctuation",
    "stops",
    "short",
    "wide",
    "most_common",
    "line_words",
)


def features(counts: dict[str, np.ndarray]) -> np.ndarray:
    """Ratios of the counts, one row a text; none grows with the length of the text as such."""
    c = {name: np.asarray(values, float) for name, values in counts.items()}
    words, size = np.maximum(c["n_words"], 1), np.maximum(c["n_bytes"], 1)
    return np.column_stack(
        [
            c["word_chars"] / words,
            c["n_symbols"] / size,
            c["n_dup_lines"] / np.maximum(c["n_lines"], 1),
            c["n_repeat_words"] / words,
            c["n_distinct"] / words**0.75,
            c["n_upper"] / size,
            c["n_digits"] / size,
            c["n_punctuation"] / size,
            c["n_stops"] / words,
            c["n_short"] / words,
            (size - c["word_chars"]) / size,
            c["most_common"] / words,
            np.log1p(words / np.maximum(c["n_lines"], 1)),
        ]
    )
