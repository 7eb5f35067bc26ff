"""The schema of a folder whose files differ in types, noted beside them (K3).

Each widening adds a note with the next number, under a name that readers of files pass
over; it comes up by one rename, so that a run that dies leaves the note before or the
whole new one. The last one holds. A note wider than all files there is harmless: it is
written before the rows that need it. Replacing the folder drops its notes.
"""

from __future__ import annotations

import json
import re
import uuid

from pyspark.sql import SparkSession
from pyspark.sql import types as T

from ..sources.shared import _hadoop

_NOTE = re.compile(r"_schema-(\d{6})\.json")


def _notes(spark: SparkSession, path: str) -> dict[int, str]:
    files, place = _hadoop(spark, path)
    if not files.exists(place):
        return {}
    found = [s.getPath() for s in files.listStatus(place)]
    matched = [(_NOTE.fullmatch(p.getName()), p.toString()) for p in found]
    return {int(m[1]): name for m, name in matched if m}


def noted_schema(spark: SparkSession, path: str) -> T.StructType | None:
    notes = _notes(spark, path)
    if not notes:
        return None
    files, place = _hadoop(spark, notes[max(notes)])
    stream = files.open(place)
    try:
        text = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    return T.StructType.fromJson(json.loads(text))


def note_schema(spark: SparkSession, path: str, schema: T.StructType) -> None:
    number = max(_notes(spark, path), default=0) + 1
    files, beside = _hadoop(spark, f"{path.rstrip('/')}/_schema-{uuid.uuid4().hex}.tmp")
    stream = files.create(beside, False)
    try:
        stream.write(bytearray(schema.json().encode()))
    finally:
        stream.close()
    note = _hadoop(spark, f"{path.rstrip('/')}/_schema-{number:06d}.json")[1]
    if not files.rename(beside, note):
        raise OSError(f"cannot note the schema of {path}")
