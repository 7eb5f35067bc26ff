"""Content keys as column expressions: D1, D3, D4.

Two encodings turn a row into one string, each in versions that never change:

``compat``  values in frame order, NULLs skipped, joined by ``||``. Rows that
            differ only in where a NULL stands share a key.
``strict``  fields that are not NULL, sorted by name, each as name and value with
            their byte lengths; arrays and structs likewise, element by element.
            Different rows give different strings, and neither column order
            nor session time zone matters, nor a further column that is all NULL.
            Version 1 went without names: the length and text of every field by
            name, -1 for NULL, and nested values as JSON.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .names import ref

# Fixed value: separator of the compat encoding.
SEPARATOR = "||"

CODEC = "org.apache.commons.codec.digest.DigestUtils"


def sha3_512(text: Column) -> Column:
    """SHA3-512 of UTF-8 text as 128 hex characters, NULL for NULL.

    Spark has no native SHA-3; the codec class ships with it, so this stays in
    the JVM. It throws on NULL, hence the guard.
    """
    return F.when(text.isNotNull(), F.java_method(F.lit(CODEC), F.lit("sha3_512Hex"), text))


DIGESTS: dict[str, Callable[[Column], Column]] = {
    "sha3_512": sha3_512,
    "sha2_512": lambda text: F.sha2(text, 512),
    "sha2_256": lambda text: F.sha2(text, 256),
}

# Length of a digest in hex digits.
HEX_DIGITS = {"sha3_512": 128, "sha2_512": 128, "sha2_256": 64}

# Versions of the encodings, the last one of each the present one.
VERSIONS = {"compat": (1,), "strict": (1, 2)}


@dataclass(frozen=True)
class KeyMaking:
    """How keys are made: what two keys must have in common to be compared."""

    encoding: str = "strict"
    digest: str = "sha3_512"
    nested: str = "reject"
    version: int | None = None

    def __post_init__(self):
        if self.encoding not in VERSIONS:
            raise ValueError(f"unknown key encoding: {self.encoding!r}")
        if self.digest not in DIGESTS:
            raise ValueError(f"unknown digest: {self.digest!r}, expected one of {sorted(DIGESTS)}")
        if self.version is None:
            object.__setattr__(self, "version", VERSIONS[self.encoding][-1])
        elif self.version not in VERSIONS[self.encoding]:
            raise ValueError(f"the {self.encoding} encoding has no version {self.version}")

    @property
    def name(self) -> str:
        """As it is recorded with a table."""
        return "/".join((self.encoding, str(self.version), self.digest, self.nested))

    @classmethod
    def named(cls, name: str) -> KeyMaking:
        encoding, version, digest, nested = name.split("/")
        return cls(encoding, digest, nested, int(version))

    def others(self) -> list[KeyMaking]:
        """Makings of keys of the same digest."""
        every = [(e, v) for e, versions in VERSIONS.items() for v in versions]
        found = [replace(self, encoding=e, version=v) for e, v in every]
        return [m for m in found if m != self]

    def key(self, fields: Sequence[T.StructField]) -> Column:
        return content_key(
            fields,
            encoding=self.encoding,
            digest=self.digest,
            nested=self.nested,
            version=self.version,
        )


def _holds(data_type: T.DataType, kinds: tuple[type, ...]) -> bool:
    if isinstance(data_type, kinds):
        return True
    if isinstance(data_type, T.ArrayType):
        return _holds(data_type.elementType, kinds)
    if isinstance(data_type, T.StructType):
        return any(_holds(f.dataType, kinds) for f in data_type.fields)
    return False


def field_text(
    field: T.StructField, *, strict: bool, nested: str = "reject", as_json: bool = False
) -> Column:
    """Text of one field for hashing; ``as_json`` writes strict nested values as JSON."""
    column, kind = ref(field.name), field.dataType
    if _holds(kind, (T.MapType, T.VariantType)):
        raise TypeError(f"{field.name}: {kind.simpleString()} has no stable text to hash")
    if isinstance(kind, (T.ArrayType, T.StructType)):
        if nested != "json":
            raise TypeError(f"{field.name}: nested={nested!r} does not hash {kind.simpleString()}")
        return _nested_text(column, kind) if strict and not as_json else F.to_json(column)
    if strict and isinstance(kind, T.TimestampType):
        return F.unix_micros(column).cast("string")
    if strict and isinstance(kind, T.BinaryType):
        return F.hex(column)
    return column.cast("string")


def _sized(text: Column) -> Column:
    """Text after its length in bytes; NULL stays NULL."""
    return F.concat(F.octet_length(text).cast("string"), F.lit("|"), text)


def _nested_text(column: Column, kind: T.DataType) -> Column:
    """Strict text of a value of any type: whole microseconds, hex for bytes, NULLs told apart."""
    if isinstance(kind, T.ArrayType):
        each = F.transform(
            column, lambda e: F.coalesce(_sized(_nested_text(e, kind.elementType)), F.lit("-"))
        )
        return F.concat(F.size(column).cast("string"), F.lit("["), F.array_join(each, "|"))
    if isinstance(kind, T.StructType):
        fields = sorted(kind.fields, key=lambda f: f.name)
        parts = [_named(f.name, _nested_text(column[f.name], f.dataType)) for f in fields]
        return F.when(column.isNotNull(), F.concat_ws("|", F.lit("{"), *parts))
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(column).cast("string")
    if isinstance(kind, T.BinaryType):
        return F.hex(column)
    return column.cast("string")


def _named(name: str, text: Column) -> Column:
    """Text of a field after its name; NULL stays NULL."""
    return F.concat(F.lit(f"{len(name.encode())}|{name}|"), _sized(text))


def row_text(
    fields: Sequence[T.StructField],
    *,
    encoding: str = "strict",
    nested: str = "reject",
    version: int | None = None,
) -> Column:
    """One string for the whole row, in the present version unless another is named."""
    if encoding == "compat":
        texts = [field_text(f, strict=False, nested=nested) for f in fields]
        return F.concat_ws(SEPARATOR, *texts) if texts else F.lit("")
    if encoding != "strict":
        raise ValueError(f"unknown key encoding: {encoding!r}")
    parts: list[Column] = []
    for field in sorted(fields, key=lambda f: f.name):
        if version == 1:
            text = field_text(field, strict=True, nested=nested, as_json=True)
            parts += [F.coalesce(F.octet_length(text), F.lit(-1)).cast("string"), text]
            continue
        parts.append(_named(field.name, field_text(field, strict=True, nested=nested)))
    return F.concat_ws("|", *parts) if parts else F.lit("")


def content_key(
    fields: Sequence[T.StructField],
    *,
    encoding: str = "strict",
    digest: str = "sha3_512",
    nested: str = "reject",
    version: int | None = None,
) -> Column:
    """Hex digest over the given fields.

    It is never NULL. The coalesce tells Catalyst so, which then drops the NULL
    checks of joins on the key instead of hashing each row again for them.
    """
    if digest not in DIGESTS:
        raise ValueError(f"unknown digest: {digest!r}, expected one of {sorted(DIGESTS)}")
    text = row_text(fields, encoding=encoding, nested=nested, version=version)
    return F.coalesce(DIGESTS[digest](text), F.lit(""))
