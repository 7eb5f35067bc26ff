"""Dirty text into types, as Column -> Column rules: C1-C15.

Every rule yields NULL for a value it cannot read and never throws, with ANSI
mode on or off. Each rule names its input as few times as it can, so a wide
contract stays one flat projection.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .moments import Moment, moment

# What counts as a number, a truth word, an ISO date, and the
# first year a timestamp may lie in.
NUMERIC = r"^-?\d+(\.\d+)?$"
TRUE_WORDS = ("true", "1", "yes", "t")
FALSE_WORDS = ("false", "0", "no", "f")
ISO_DATE = r"^\d{4}-\d{2}-\d{2}$"
FIRST_YEAR = 1900

# Spellings tried after the ISO form. None leaves out a part of the date, as
# the missing part would have to come from the day of the run.
TIMESTAMP_FORMATS = (
    "M/d/yyyy H:mm:ss",
    "M/d/yyyy H:mm",
    "M/d/yyyy h:mm:ss a",
    "M/d/yyyy h:mm a",
    "M/d/yyyy",
    "MMM d, yyyy H:mm:ss",
    "MMM d, yyyy",
    "MMMM d, yyyy",
    "d MMM yyyy H:mm:ss",
    "d MMM yyyy",
    "yyyy/M/d H:mm:ss",
    "yyyy/M/d",
    "MMM d yyyy h:mma",
    "MMM  d yyyy h:mma",
    "MMM d yyyy",
    "d-MMM-yyyy H:mm:ss",
    "d-MMM-yyyy",
    "yyyy.M.d",
    "yyyyMMdd H:mm:ss",
    "yyyyMMdd'T'HHmmss",
    "yyyyMMdd",
)
DATE_FORMATS = ("yyyy-M-d H:mm:ss", "yyyy-M-d'T'H:mm:ss", *TIMESTAMP_FORMATS)

FUTURE_POLICIES = ("keep", "clamp", "null")


def number(text: Column, target: T.DataType) -> Column:
    """Decimal or double from text with thousands commas.

    The pattern is matched and the value taken in one step: no match gives
    the empty string, which casts to NULL.
    """
    bare = F.trim(F.replace(text.cast("string"), F.lit(","), F.lit("")))
    return F.regexp_extract(bare, NUMERIC, 0).try_cast(target)


def truth(text: Column) -> Column:
    """Boolean from a truth word."""
    word = F.lower(text.cast("string"))
    return F.when(word.isin(*TRUE_WORDS), True).when(word.isin(*FALSE_WORDS), False)


def flag(text: Column) -> Column:
    """``TRUE`` or ``FALSE`` for a truth word, any other value as it is."""
    word = F.lower(text.cast("string"))
    return (
        F.when(word.isin(*TRUE_WORDS), "TRUE")
        .when(word.isin(*FALSE_WORDS), "FALSE")
        .otherwise(text.cast("string"))
    )


def valid_json(text: Column) -> Column:
    """The text itself if it is JSON, else NULL.

    Spark's parser stops after the first value and ignores what follows. So the
    text is parsed as first element of an array whose second is a hash of the
    text: only if the text is one whole value does the hash come back in place.
    The parser rejects ``NaN``, repeated object keys and very long values; see
    ``json_by_outline`` for a check that takes them.
    """
    text = text.cast("string")
    mark = F.xxhash64(text)
    parsed = F.try_parse_json(F.concat(F.lit("["), text, F.lit(","), mark, F.lit("]")))
    return F.when(F.try_variant_get(parsed, "$[1]", "bigint") == mark, text)


# Parts of JSON text that are the same to its grammar, and the text that remains of them.
# Control characters are not JSON, in strings or outside, so one can stand for a string.
_JSON_PARTS = (
    (r"\x01", "\x02"),
    (r"\\(?:[\"\\/bfnrt]|u[0-9a-fA-F]{4})", "_"),
    (r'"[^"\\\x00-\x1f]*+"', "\x01"),
    (r"-?(?:0|[1-9][0-9]*+)(?:\.[0-9]++)?(?:[eE][+-]?[0-9]++)?|-?Infinity|NaN|true|false|null", "0"),
)
_OUTLINE = r'^[\[\]{},:0\x01 \t\n\r]*+$'


def json_by_outline(text: Column) -> Column:
    """The text if it is JSON once strings are empty and all other values 0, else NULL.

    Neither the length of a value nor a repeated key matters to the parser that
    reads the outline. That parser takes more than JSON, so the outline may hold only
    the characters that JSON has outside of strings.
    """
    text = text.cast("string")
    outline = text
    for part, remains in _JSON_PARTS:
        outline = F.regexp_replace(outline, part, remains)
    outline = F.replace(F.when(outline.rlike(_OUTLINE), outline), F.lit("\x01"), F.lit('""'))
    both = F.concat(F.lit("["), outline, F.lit(",1]"))
    return F.when(F.get_json_object(both, "$[1]") == "1", text)


_TOKEN = re.compile(
    r"'(?P<literal>[^']*)'|(?P<run>(?P<letter>[A-Za-z])(?P=letter)*)|(?P<other>.)", re.DOTALL
)


def shape(pattern: str) -> str | None:
    """Regular expression that all text the date pattern fits will match.

    Trying a pattern on other text costs an exception per value; matching the
    shape first costs a small part of that. ``None`` for a pattern with letters
    whose text has no simple shape.
    """
    parts = []
    for token in _TOKEN.finditer(pattern):
        run = token["run"]
        if not run:
            parts.append(re.escape(token["literal"] or token["other"] or "'"))
        elif run[0] == "a" or run.startswith("MMM"):
            parts.append(r"\p{L}[\p{L}.]*")
        elif run[0] not in "yMdHhmsS":
            return None
        elif run == "yyyy":
            parts.append(r"\d{4,}")
        else:
            parts.append(r"\d{2}" if len(run) == 2 else r"\d+")
    return "^" + "".join(parts) + "$"


# Text that can be a date at all: four characters or more, with a digit.
DATELIKE = r"(?s)^(?=.{4}).*\d"


def _fitting(text: Column, pattern: str) -> Column:
    """The text if it is date-like and has the pattern's shape, else NULL."""
    expected = shape(pattern)
    if expected is None:
        expected = DATELIKE
    elif "yyyy" not in pattern:
        expected = expected.replace("^", "^(?=.{4})", 1)
    return F.when(text.rlike(expected), text)


def timestamp(
    text: Column, formats: Sequence[str] = TIMESTAMP_FORMATS, as_of: Moment = None
) -> Column:
    """Timestamp from text: Spark's own reading, then each format.

    A bare time of day is read on the day of ``as_of``. Text without an offset
    is read in the session time zone.
    """
    text = text.cast("string")
    day = F.date_format(moment(as_of), "yyyy-MM-dd")
    dated = F.when(
        text.rlike(r"^\s*T?\d{1,2}:"), F.concat(day, F.lit("T"), F.ltrim(text, F.lit("T ")))
    ).otherwise(text)
    # A coalesce on the outside, not a condition: Catalyst would push what is
    # done with the result into the branches, and parse once for each use.
    return F.coalesce(
        F.try_to_timestamp(F.when(F.length(text) > 3, dated)),
        *(F.try_to_timestamp(_fitting(text, f), F.lit(f)) for f in formats),
    )


def date(text: Column, formats: Sequence[str] = DATE_FORMATS) -> Column:
    """Date from text: the ISO form, then each format."""
    text = text.cast("string")
    return F.coalesce(
        F.try_to_date(F.when(text.rlike(ISO_DATE), text)),
        *(F.try_to_date(_fitting(text, f), f) for f in formats),
    )


def in_range(value: Column, as_of: Moment = None) -> Column:
    """NULL for a timestamp before 1900 or after next year."""
    first = F.lit(f"{FIRST_YEAR}-01-01 00:00:00").cast("timestamp")
    end = (F.year(moment(as_of)) + 2).cast("string")
    return F.when((value >= first) & (value < end.cast("timestamp")), value)


def audit_default(value: Column, as_of: Moment = None) -> Column:
    """A missing audit timestamp becomes the time of the load."""
    return F.coalesce(value, moment(as_of))


def future(value: Column, policy: str, as_of: Moment = None, data_type: str = "timestamp") -> Column:
    """Values after ``as_of``: kept, clamped to it, or NULL."""
    if policy not in FUTURE_POLICIES:
        raise ValueError(f"unknown future policy: {policy!r}, expected one of {FUTURE_POLICIES}")
    if policy == "keep":
        return value
    now = moment(as_of).cast(data_type)
    late = F.when(value > now, now if policy == "clamp" else F.lit(None).cast(data_type))
    return late.otherwise(value)
