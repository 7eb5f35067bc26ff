"""A database embedded in the driver's own process, for tests of scans: no query uses it."""

from __future__ import annotations

import uuid

from landfall.functions.names import QualifiedName
from landfall.sources.jdbc import Database


def embedded(name: str | None = None) -> Database:
    name = name or f"landfall{uuid.uuid4().hex}"
    return Database(f"jdbc:derby:memory:{name};create=true")


def put(database: Database, df, name: str) -> QualifiedName:
    """Copy a frame into the database."""
    df.write.jdbc(database.url, name, mode="overwrite")
    return QualifiedName("APP", name.upper())
