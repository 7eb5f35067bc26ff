"""Align a frame with a contract: P3, P4, P6, P8, S6 and the check V1."""

from __future__ import annotations

from collections.abc import Collection, Mapping
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..contracts import Contract
from ..functions.names import ref
from .audit import AUDIT_COLUMNS

# Source types with no use downstream, and what stands in.
UNSUPPORTED_TYPES = ("money", "sql_variant")
STAND_IN_TYPE = "VARCHAR(50)"


def conform(df: DataFrame, contract: Contract) -> DataFrame:
    """Contract names for raw columns, typed NULLs for missing ones.

    Raw names match without regard to case; of names equal up to case the last
    wins. Columns keep the frame's order, as the compat key needs it. Raw
    columns the contract does not know stay if it hashes extras. A raw key
    column and raw audit columns are dropped: both are made anew.
    """
    own = {name.lower(): name for name in contract.business.names}
    derived = {name.lower() for name in (*AUDIT_COLUMNS, *filter(None, [contract.key]))}
    last = {name.lower(): name for name in df.columns}
    chosen: dict[str, str] = {}
    kept = []
    for raw in df.columns:
        low = raw.lower()
        if low in derived:
            continue
        target = contract.raw_names.get(low) or own.get(low)
        if target is None:
            if contract.extras == "hash":
                kept.append(ref(raw))
        elif last[low] == raw:
            if target in chosen:
                raise ValueError(
                    f"{contract.name}: both {chosen[target]!r} and {raw!r} are {target}"
                )
            chosen[target] = raw
            kept.append(ref(raw).alias(target))
    missing = [f for f in contract.business.fields if f.name not in chosen]
    return df.select(*kept, *(F.lit(None).cast(f.dataType).alias(f.name) for f in missing))


def project(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Exactly the schema's columns in its order."""
    return df.select([ref(name) for name in schema.names])


def null_unsupported(
    df: DataFrame,
    source_types: Mapping[str, str],
    unsupported: Collection[str] = UNSUPPORTED_TYPES,
    *,
    keep_text: bool = False,
) -> DataFrame:
    """Replace columns of unsupported source types by NULL text.

    ``keep_text`` casts the value to text instead of losing it.
    """
    bad = {name for name, kind in source_types.items() if kind.lower() in unsupported}
    return df.select(
        *(
            (ref(c) if keep_text else F.lit(None)).cast("string").alias(c) if c in bad else ref(c)
            for c in df.columns
        )
    )


class Violation(NamedTuple):
    column: str
    problem: str
    expected: str
    found: str | None


class ContractViolation(ValueError):
    """A frame does not have the declared columns; carries every fault."""

    def __init__(self, violations: list[Violation]):
        self.violations = violations
        lines = [
            f"{v.column}: {v.problem}, expected {v.expected}"
            + (f", found {v.found}" if v.found else "")
            for v in violations
        ]
        super().__init__("; ".join(lines))


def violations(df: DataFrame, schema: T.StructType, *, types: bool = True) -> list[Violation]:
    """Every missing or mistyped column, in contract order (V1).

    Types are compared in full, with precision and scale; nullability is not,
    neither of columns nor of elements and fields.
    """
    found = {f.name: f.dataType for f in df.schema.fields}
    faults = []
    for field in schema.fields:
        expected = field.dataType.simpleString()
        if field.name not in found:
            faults.append(Violation(field.name, "missing", expected, None))
        elif types and (actual := found[field.name].simpleString()) != expected:
            faults.append(Violation(field.name, "type", expected, actual))
    return faults


def validate(df: DataFrame, schema: T.StructType, *, types: bool = True) -> DataFrame:
    """The frame itself, or one error that names every fault (V1)."""
    faults = violations(df, schema, types=types)
    if faults:
        raise ContractViolation(faults)
    return df


def violations_frame(spark: SparkSession, faults: list[Violation]) -> DataFrame:
    """Faults as rows, for a report."""
    return spark.createDataFrame(
        faults, "column string, problem string, expected string, found string"
    )
