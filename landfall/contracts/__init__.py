"""What a conformed table must look like: columns, names and column roles."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field, fields
from functools import cached_property
from typing import Any

from pyspark.sql import types as T

from ..functions.cleaning import DATE_FORMATS, FUTURE_POLICIES, TIMESTAMP_FORMATS
from ..functions.names import squashed
from ..operators.audit import AUDIT_SCHEMA


@dataclass(frozen=True)
class Contract:
    """The declared shape of one table, as configuration.

    ``columns`` is a DDL string or ``StructType`` of the business columns. The
    key column and the audit columns are added around them. A raw column
    belongs to the contract column whose name it equals once underscores are
    dropped and case is ignored, unless ``renames`` (raw name -> column) says
    otherwise.
    """

    name: str
    columns: str | T.StructType
    key: str | None = None
    renames: Mapping[str, str] = field(default_factory=dict)
    json: Sequence[str] = ()
    flags: Sequence[str] = ()
    # Column -> what becomes of values after the load's own time.
    future: Mapping[str, str] = field(default_factory=dict)
    timestamp_formats: Sequence[str] = TIMESTAMP_FORMATS
    date_formats: Sequence[str] = DATE_FORMATS
    # Raw columns no contract column claims: part of the key ("hash") or not.
    extras: str = "ignore"
    # How JSON is checked that Spark's parser rejects: by its outline, by Python's
    # parser ("python"), or not at all ("native").
    json_check: str = "outline"
    key_encoding: str = "strict"
    key_digest: str = "sha3_512"
    # Zone of free-form text, if the slower reading of any spelling is wanted.
    free_form_zone: str | None = None

    def __post_init__(self):
        if bad := set(self.future.values()) - set(FUTURE_POLICIES):
            raise ValueError(f"{self.name}: unknown future policy: {sorted(bad)}")
        if self.extras not in ("hash", "ignore"):
            raise ValueError(f"{self.name}: extras must be 'hash' or 'ignore'")
        if self.json_check not in ("outline", "native", "python"):
            raise ValueError(f"{self.name}: json_check must be 'outline', 'native' or 'python'")

    @cached_property
    def business(self) -> T.StructType:
        """The columns that come from the source.

        Spark's parser reads the DDL, so this needs a session, unlike the
        contract as such.
        """
        shape = self.columns
        if not isinstance(shape, T.StructType):
            shape = T.StructType.fromDDL(shape)
        roles = {*self.json, *self.flags, *self.future, *self.renames.values()}
        if unknown := roles - set(shape.names):
            raise ValueError(f"{self.name}: no such contract column: {sorted(unknown)}")
        return shape

    @cached_property
    def schema(self) -> T.StructType:
        """Key, business columns, audit columns: the shape of the target."""
        key = [T.StructField(self.key, T.StringType())] if self.key else []
        return T.StructType(key + self.business.fields + AUDIT_SCHEMA.fields)

    @cached_property
    def raw_names(self) -> dict[str, str]:
        """Raw name in lower case -> contract column."""
        renamed = set(self.renames.values())
        by_rule = {squashed(n): n for n in self.business.names if n not in renamed}
        return by_rule | {raw.lower(): name for raw, name in self.renames.items()}

    @classmethod
    def from_dict(cls, config: Mapping[str, Any]) -> Contract:
        unknown = set(config) - {f.name for f in fields(cls)}
        if unknown:
            raise ValueError(f"not part of a contract: {sorted(unknown)}")
        return cls(**config)

    @classmethod
    def from_json(cls, text: str) -> Contract:
        return cls.from_dict(json.loads(text))
