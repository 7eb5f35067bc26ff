"""Column, table and key names: P1, P2, S15 and the key naming rule."""

from __future__ import annotations

import re
from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F

NOT_WORD = re.compile(r"\W+")
# A bare word, or anything in double quotes.
IDENTIFIER = re.compile(r'(\w+)|"((?:[^"]|"")+)"')


def ref(name: str) -> Column:
    """The column called exactly ``name``, whatever characters it holds."""
    return F.col(quoted(name))


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def strict_name(name: str) -> str:
    """Every run of non-word characters becomes one underscore."""
    return NOT_WORD.sub("_", name)


def light_name(name: str) -> str:
    """Spaces and dots become underscores, all else stays."""
    return name.translate(str.maketrans(" .", "__"))


def squashed(name: str) -> str:
    """Raw spelling of a contract column: lower case, no underscores."""
    return name.replace("_", "").lower()


def staged_name(system: str, table: str) -> str:
    """Name of a staged table."""
    return f"STG_{system.upper()}_{table.upper()}"


def key_name(system: str, table: str) -> str:
    """Name of the key column of a staged table."""
    return f"{staged_name(system, table)}_KEY"


class QualifiedName(NamedTuple):
    schema: str
    table: str

    def quote(self, left: str = '"', right: str = '"') -> str:
        return ".".join(quote_identifier(part, left, right) for part in self)


def quote_identifier(name: str, left: str = '"', right: str = '"') -> str:
    return left + name.replace(right, right * 2) + right


def qualified_name(text: str, default_schema: str = "public") -> QualifiedName:
    """Read ``table`` or ``schema.table``, each bare or in double quotes.

    Within quotes any character may stand, dots too, and a quote is written twice.
    """
    parts, at = [], 0
    while found := IDENTIFIER.match(text, at):
        bare, held = found.groups()
        parts.append(bare or held.replace('""', '"'))
        at = found.end()
        if not text.startswith(".", at):
            break
        at += 1
    if at != len(text) or text.endswith(".") or len(parts) not in (1, 2):
        raise ValueError(f"not a table name: {text!r}")
    return QualifiedName(*([default_schema, *parts][-2:]))
