"""Opt-in exact readings that Spark has no expression for: C1, C4, C6.

Arrow-batched, and meant for the few values the native rules could not read:
the caller passes NULL for all others, so those cost one pointer each.
"""

from __future__ import annotations

import json
from datetime import datetime
from zoneinfo import ZoneInfo

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from .cleaning import DATELIKE


def python_json(text: Column) -> Column:
    """The text if Python's ``json`` reads it, else NULL."""

    @F.arrow_udf("string")
    def check(texts: pa.Array) -> pa.Array:
        def kept(value):
            try:
                json.loads(value, parse_int=str, parse_float=str)  # numbers of any length
            except (ValueError, RecursionError):
                return None
            return value

        values = texts.to_pylist()
        return pa.array([None if v is None else kept(v) for v in values], pa.string())

    return check(text.cast("string"))


def _reader(as_of: datetime, zone: str):
    """Free-form text -> datetime as written, or None.

    Made on the driver and sent to the tasks by value, so that these need
    ``dateutil`` but not this package. Parts the text leaves out come from the
    day of the load, not of the task.
    """
    blank = as_of.astimezone(ZoneInfo(zone))
    blank = blank.replace(hour=0, minute=0, second=0, microsecond=0, tzinfo=None)

    def read(text):
        from dateutil import parser

        if text is None:
            return None
        try:
            return parser.parse(text, default=blank)
        except (ValueError, OverflowError, TypeError):
            return None

    return read


def free_form_timestamp(text: Column, as_of: datetime, zone: str) -> Column:
    """Timestamp in any spelling ``dateutil`` takes; naive text is in ``zone`` (C4)."""
    read, home = _reader(as_of, zone), ZoneInfo(zone)

    @F.arrow_udf("timestamp")
    def parse(texts: pa.Array) -> pa.Array:
        def instant(value):
            return value if value is None or value.tzinfo else value.replace(tzinfo=home)

        values = [instant(read(v)) for v in texts.to_pylist()]
        return pa.array(values, pa.timestamp("us", "UTC"))

    return parse(F.when(text.rlike(DATELIKE), text))


def free_form_date(text: Column, as_of: datetime, zone: str) -> Column:
    """Date in any spelling ``dateutil`` takes, as written."""
    read = _reader(as_of, zone)

    @F.arrow_udf("date")
    def parse(texts: pa.Array) -> pa.Array:
        values = [read(v) for v in texts.to_pylist()]
        return pa.array([None if v is None else v.date() for v in values], pa.date32())

    return parse(F.when(text.rlike(DATELIKE), text))
