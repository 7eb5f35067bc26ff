"""Type-driven cleaning of a conformed frame: C0-C16."""

from __future__ import annotations

from datetime import UTC, datetime

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..contracts import Contract
from ..functions import cleaning, lenient
from ..functions.moments import Moment
from ..functions.names import ref
from .audit import AUDIT_COLUMNS

TIMESTAMPS = (T.TimestampType, T.TimestampNTZType)


def _instant(as_of: Moment) -> datetime:
    if isinstance(as_of, datetime) and as_of.tzinfo is not None:
        return as_of
    if as_of is None:
        return datetime.now(UTC)
    raise TypeError("free-form reading needs as_of as a datetime with a time zone")


def _cleaned(source: T.StructField, target: T.StructField, contract: Contract, as_of) -> Column:
    """The one rule that applies to a column, roles before types."""
    value, kind = _raw(source, as_of), target.dataType
    text = value if isinstance(source.dataType, T.StringType) else value.cast("string")
    if target.name in contract.json:
        valid = cleaning.valid_json(text)
        again = {"outline": cleaning.json_by_outline, "python": lenient.python_json}
        if check := again.get(contract.json_check):
            valid = F.coalesce(valid, check(F.when(valid.isNull(), text)))
        return valid
    if isinstance(kind, (*TIMESTAMPS, T.DateType)):
        if isinstance(source.dataType, (*TIMESTAMPS, T.DateType)):
            return value.cast(kind)
        return _moment(source, kind, value, text, contract, as_of)
    if isinstance(kind, (T.DecimalType, T.DoubleType)):
        exact = isinstance(source.dataType, (T.IntegralType, T.DecimalType))
        return value.try_cast(kind) if exact else cleaning.number(text, kind)
    if isinstance(kind, T.BooleanType):
        return value if source.dataType == kind else cleaning.truth(text)
    if target.name in contract.flags:
        return cleaning.flag(text)
    return text


def _raw(source: T.StructField, as_of: Moment) -> Column:
    """The column as it came, but for timestamps out of range."""
    value = ref(source.name)
    return cleaning.in_range(value, as_of) if isinstance(source.dataType, TIMESTAMPS) else value


def _moment(source, kind, value, text, contract: Contract, as_of) -> Column:
    """Timestamp or date from text, or from a number of seconds."""
    is_date = isinstance(kind, T.DateType)
    if is_date:
        parsed = cleaning.date(text, contract.date_formats)
    elif isinstance(source.dataType, T.NumericType):
        parsed = F.when(F.length(text) > 3, value.try_cast("timestamp"))
    else:
        parsed = cleaning.timestamp(text, contract.timestamp_formats, as_of)
    if contract.free_form_zone:
        free_form = lenient.free_form_date if is_date else lenient.free_form_timestamp
        rest = F.when(parsed.isNull(), text)
        parsed = F.coalesce(parsed, free_form(rest, _instant(as_of), contract.free_form_zone))
    return parsed if is_date else cleaning.in_range(parsed.cast(kind), as_of)


def clean(
    df: DataFrame,
    contract: Contract,
    as_of: Moment = None,
    losses: Observation | None = None,
) -> DataFrame:
    """Clean every contract column in one projection; others pass through.

    Of the others, only timestamps are range-checked (P8, C12). ``losses`` gets, for each
    column, how many values became NULL; it is filled by the first job over the frame,
    which has to read it whole, and costs no job of its own.
    """
    targets = {f.name: f for f in contract.business.fields}
    cleaned = [
        _cleaned(field, targets[field.name], contract, as_of).alias(field.name)
        if field.name in targets
        else _raw(field, as_of).alias(field.name)
        for field in df.schema.fields
    ]
    if losses is None:
        return df.select(*cleaned)
    had = {name: f"__had_{place}" for place, name in enumerate(df.columns)}
    both = df.select(*cleaned, *(ref(name).isNotNull().alias(flag) for name, flag in had.items()))
    counts = [F.count_if(ref(flag) & ref(name).isNull()).alias(name) for name, flag in had.items()]
    return both.observe(losses, *counts).drop(*had.values())


def settle_future(df: DataFrame, contract: Contract, as_of: Moment = None) -> DataFrame:
    """Apply each column's policy for values after ``as_of``.

    Runs after the key is made: a clamped value changes from run to run, and
    a key made from it would bring the row in again each time.
    """
    kinds = {f.name: f.dataType.simpleString() for f in contract.business.fields}
    late = {
        name: cleaning.future(ref(name), policy, as_of, kinds[name])
        for name, policy in contract.future.items()
        if policy != "keep"
    }
    return df.withColumns(late) if late else df


def clean_timestamps(df: DataFrame, as_of: Moment = None) -> DataFrame:
    """Range-check every timestamp of a frame without a contract."""

    def fixed(field: T.StructField) -> Column:
        if not isinstance(field.dataType, TIMESTAMPS):
            return ref(field.name)
        value = cleaning.in_range(ref(field.name), as_of)
        if field.name in AUDIT_COLUMNS:
            value = cleaning.audit_default(value, as_of).cast(field.dataType)
        return value.alias(field.name)

    return df.select(*(fixed(f) for f in df.schema.fields))
