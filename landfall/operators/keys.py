"""Content key as a column of a frame, and how held keys were made: D1-D3, P5."""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.digest import KeyMaking, content_key
from ..functions.names import ref
from .audit import AUDIT_COLUMNS


def add_key(
    df: DataFrame,
    key: str | None,
    *,
    encoding: str = "strict",
    digest: str = "sha3_512",
    nested: str = "reject",
    version: int | None = None,
    columns: Collection[str] | None = None,
    exclude: Collection[str] = AUDIT_COLUMNS,
) -> DataFrame:
    """Put a digest of the row's content in front, as column ``key``.

    All columns count but the audit columns and the key itself, or only
    ``columns`` if given. Without a key name the frame is returned as it is.
    """
    if key is None:
        return df
    fields = [f for f in _content(df, key, exclude) if columns is None or f.name in columns]
    digested = content_key(
        fields, encoding=encoding, digest=digest, nested=nested, version=version
    )
    return df.select(digested.alias(key), *(ref(c) for c in df.columns if c != key))


def _content(df: DataFrame, key: str, exclude: Collection[str]) -> list[T.StructField]:
    return [f for f in df.schema.fields if f.name != key and f.name not in exclude]


# Where a table's schema says how its keys were made.
RECORD = "landfall.key"
# Rows that are looked at where a table does not say.
SAMPLE = 64


class KeyMismatch(ValueError):
    """Keys of two makings would be compared."""


def recorded(df: DataFrame, key: str, making: KeyMaking) -> DataFrame:
    """The frame with a note on the key column of how its keys were made."""
    return df.withMetadata(key, {RECORD: making.name})


def making_of(held: DataFrame, key: str) -> KeyMaking | None:
    """How a table says its keys were made; formats without column notes say nothing."""
    name = held.schema[key].metadata.get(RECORD)
    return KeyMaking.named(name) if name else None


def recognised(
    held: DataFrame,
    key: str,
    making: KeyMaking,
    exclude: Collection[str] = AUDIT_COLUMNS,
) -> KeyMaking | None:
    """Which making gives the keys that a few rows of a table hold, ``making`` before others.

    ``None`` if none does, as where values were settled or dropped after the key was made.
    """
    fields = _content(held, key, exclude)
    sample = held.filter(ref(key).isNotNull()).limit(SAMPLE)
    tried, same = [], []
    for candidate in (making, *making.others()):
        try:
            made = candidate.key(fields)
        except TypeError:  # a type this making does not read
            continue
        tried.append(candidate)
        same.append((made == F.lower(ref(key))).alias(str(len(same))))
    if not tried:
        return None
    # projected first, as aggregates take no call of a Java method
    found = sample.select(*same).agg(*(F.count_if(str(n)) for n in range(len(same)))).first()
    return next((m for m, n in zip(tried, found, strict=True) if n), None)


def check_making(
    held: DataFrame, key: str, making: KeyMaking, theirs: KeyMaking | None = None
) -> None:
    """Raise where a table's keys were made in another way than those to be compared with them.

    ``theirs`` is what the table says of them; else its rows are asked.
    """
    if key not in held.columns:
        return
    theirs = theirs or recognised(held, key, making)
    if theirs is not None and theirs != making:
        raise KeyMismatch(f"held keys are {theirs.name}, the load's {making.name}: re-key the table")


OLD, NEW, SAME = "__old", "__new", "__same"


def rekeyed(
    held: DataFrame,
    key: str,
    making: KeyMaking,
    theirs: KeyMaking,
    contents: DataFrame | None = None,
    exclude: Collection[str] = AUDIT_COLUMNS,
) -> DataFrame:
    """The rows of a table, keyed by another making.

    A row whose key its own columns give is keyed from them anew. Others had values
    changed after the key was made; ``contents``, rows as they were then, say what
    becomes of their keys. A row that neither explains stops the job. Only rows of the
    second kind are shuffled.
    """
    fields = _content(held, key, exclude)
    rows = held.withColumn(SAME, theirs.key(fields) == F.lower(ref(key)))
    mine = rows.filter(F.coalesce(SAME, F.lit(True))).drop(SAME)
    mine = _with_key(mine, key, F.when(ref(key).isNotNull(), making.key(fields)))
    loose = rows.filter(~ref(SAME)).drop(SAME)
    says = F.concat(F.lit("no row explains the key "), ref(key))
    if contents is None:
        loose = _with_key(loose, key, F.raise_error(says).cast("string"))
    else:
        source = _content(contents, key, exclude)
        known = contents.select(theirs.key(source).alias(OLD), making.key(source).alias(NEW)).distinct()
        loose = loose.join(known, F.lower(ref(key)) == ref(OLD), "left")
        loose = _with_key(loose, key, F.coalesce(NEW, F.raise_error(says).cast("string")))
        loose = loose.drop(OLD, NEW)
    return recorded(mine.unionByName(loose), key, making)


def _with_key(df: DataFrame, key: str, made: Column) -> DataFrame:
    return df.select(*(made.alias(key) if c == key else ref(c) for c in df.columns))


def key_sample(df: DataFrame, key: str, count: int = 5) -> DataFrame:
    """A few keys to look at (L1); costs a job of its own, so it is never run unasked."""
    return df.select(ref(key)).limit(count)
