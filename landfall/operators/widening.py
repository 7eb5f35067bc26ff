"""Held schemas widened by an order of types, so that later rows with wider types fit (K3).

A column's type may grow to the least type that holds all values of both:

* whole numbers: byte, short, int, long;
* whole numbers and decimals: the decimal with digits enough before and after the point;
* float and double, and whole numbers up to int beside either: double;
* date and timestamp without a zone: the latter.

Every other pair of different types is refused. Columns that one side lacks are added
and read as NULL there. Parquet's reader takes files of the narrower types for all of
these, so nothing held is written again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.names import ref
from .conform import ContractViolation, Violation

# Whole numbers from narrow to wide, with the decimal digits each can need.
WHOLE = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 20}
MOST_DIGITS = 38


def wider_type(held: T.DataType, new: T.DataType) -> T.DataType | None:
    """The least type that holds all values of both, ``None`` if there is none."""
    if held == new:
        return held
    for one, other in ((held, new), (new, held)):
        if isinstance(one, T.NullType):
            return other
    whole = [type(t) in WHOLE for t in (held, new)]
    if all(whole):
        return max(held, new, key=lambda t: WHOLE[type(t)])
    decimal = [isinstance(t, T.DecimalType) for t in (held, new)]
    if all(w or d for w, d in zip(whole, decimal, strict=True)):
        return _wider_decimal(held, new)
    for one, other in ((held, new), (new, held)):
        if isinstance(one, T.DoubleType | T.FloatType):
            if isinstance(other, T.DoubleType | T.FloatType):
                return T.DoubleType()
            if type(other) in WHOLE and not isinstance(other, T.LongType):
                return T.DoubleType()
        if isinstance(one, T.DateType) and isinstance(other, T.TimestampNTZType):
            return other
    return None


def _wider_decimal(held: T.DataType, new: T.DataType) -> T.DataType | None:
    sizes = [
        (t.precision - t.scale, t.scale) if isinstance(t, T.DecimalType) else (WHOLE[type(t)], 0)
        for t in (held, new)
    ]
    before, after = (max(s[i] for s in sizes) for i in (0, 1))
    return T.DecimalType(before + after, after) if before + after <= MOST_DIGITS else None


def same_text(held: T.DataType, new: T.DataType) -> bool:
    """Whether equal values of both types read alike, so that keys made of them agree."""

    def kind(t: T.DataType):
        if type(t) in WHOLE:
            return 0
        return t.scale if isinstance(t, T.DecimalType) else t

    return kind(held) == kind(new) or isinstance(held, T.NullType) or isinstance(new, T.NullType)


def wider_schema(held: T.StructType, new: T.StructType, *, keyed: bool = False) -> T.StructType:
    """Held columns in their order, each as wide as needed, then the added ones.

    ``keyed`` refuses, on top of types without a common one, those whose equal values
    read otherwise: a row that is there already would get another key.
    """
    found = {f.name: f for f in new.fields}
    folded = {f.name.lower(): f.name for f in held.fields}
    fields, faults = [], []
    for field in held.fields:
        other = found.get(field.name)
        kind = field.dataType if other is None else wider_type(field.dataType, other.dataType)
        if kind is not None and keyed and other and not same_text(field.dataType, other.dataType):
            kind = None
        if kind is None:
            expected, actual = field.dataType.simpleString(), other.dataType.simpleString()
            faults.append(Violation(field.name, "type", expected, actual))
            continue
        fields.append(T.StructField(field.name, kind, True, field.metadata))
    for field in new.fields:
        if field.name in {f.name for f in held.fields}:
            continue
        if (clash := folded.get(field.name.lower())) is not None:
            faults.append(Violation(field.name, "case", clash, field.name))
        else:
            fields.append(T.StructField(field.name, field.dataType, True, field.metadata))
    if faults:
        raise ContractViolation(faults)
    return T.StructType(fields)


def widened_to(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The frame with exactly these columns: cast where narrower, NULL where it lacks them."""
    kinds = {f.name: f.dataType for f in df.schema.fields}

    def column(field: T.StructField):
        if field.name not in kinds:
            return F.lit(None).cast(field.dataType).alias(field.name)
        if kinds[field.name] == field.dataType:
            return ref(field.name)
        return ref(field.name).cast(field.dataType).alias(field.name)

    return df.select(*map(column, schema.fields))
