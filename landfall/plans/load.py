"""One table from source to targets: O1-O3, R1, S12, L2."""

from __future__ import annotations

import time
from contextlib import contextmanager
from dataclasses import dataclass, fields, replace
from datetime import UTC, datetime

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.digest import HEX_DIGITS, KeyMaking
from ..functions.names import ref
from ..operators.audit import stamp
from ..operators.changes import checked_keys, new_rows
from ..operators.clean import clean, settle_future
from ..operators.conform import ContractViolation, conform, project, validate, violations
from ..operators.keys import KeyMismatch, add_key, check_making, recognised, recorded, rekeyed
from ..operators.naming import clean_names
from ..sinks.targets import Target
from ..sources.shared import staged, use_checkpoints
from .spec import TableSpec


@dataclass
class LoadResult:
    """What became of one table."""

    table: str
    mode: str
    status: str = "success"
    reason: str | None = None
    source_rows: int | None = None
    offered: int | None = None
    landing_before: int | None = None
    landed: int | None = None
    landing_after: int | None = None
    warehouse_before: int | None = None
    loaded: int | None = None
    warehouse_after: int | None = None
    as_of: datetime | None = None
    seconds: float | None = None
    # Column -> values that cleaning made NULL, if they were counted.
    lost: dict[str, int] | None = None

    def row(self) -> tuple:
        return tuple(getattr(self, f.name) for f in fields(self))


_COUNTS = {"source_rows", "offered", "landing_before", "landed", "landing_after"} | {
    "warehouse_before",
    "loaded",
    "warehouse_after",
}
_TYPES = dict.fromkeys(_COUNTS, T.LongType()) | {
    "as_of": T.TimestampType(),
    "seconds": T.DoubleType(),
    "lost": T.MapType(T.StringType(), T.LongType()),
}
RESULT_SCHEMA = T.StructType(
    [T.StructField(f.name, _TYPES.get(f.name, T.StringType())) for f in fields(LoadResult)]
)


class CountMismatch(RuntimeError):
    """Rows got lost or came up on the way."""


class ContentMismatch(RuntimeError):
    """As many rows as there should be, but not the ones written."""


class TargetAbsent(LookupError):
    """The mode needs a target that is not there."""


def contents(
    spark: SparkSession, spec: TableSpec, as_of: datetime, losses: Observation | None = None
) -> DataFrame:
    """The table's rows with the values that keys are made from."""
    df, contract = spec.source.scan(spark), spec.contract
    if contract is None:
        return clean_names(df, spec.names) if spec.names else df
    df = validate(conform(df, contract), contract.business, types=False)
    return clean(df, contract, as_of, losses)


def prepare(
    spark: SparkSession, spec: TableSpec, as_of: datetime, losses: Observation | None = None
) -> DataFrame:
    """The table's rows as the targets hold them: one lazy plan, no action.

    The key is made from cleaned values, before values later than ``as_of``
    are settled, so it is the same in every run.
    """
    contract, key = spec.contract, spec.key_column
    df = add_key(
        contents(spark, spec, as_of, losses),
        key,
        encoding=spec.encoding,
        digest=spec.digest,
        nested=spec.nested,
        version=spec.making.version,
    )
    if contract is not None:
        df = settle_future(df, contract, as_of)
    df = stamp(df, spec.system, as_of, creator=spec.creator)
    if contract is not None:
        df = validate(project(df, contract.schema), contract.schema)
    return df


@contextmanager
def _batch(spark: SparkSession, spec: TableSpec, as_of: datetime, losses: Observation | None):
    """The prepared rows, and their number if it is known before they are written.

    A load that replaces its target reads the source once anyway. Others look
    at the batch several times, so a source that may change is staged first.
    Losses are counted by the one job that is sure to read all rows: the write of a load
    that replaces, the staging, else the counting of the batch.
    """
    plain = prepare(spark, spec, as_of)
    df = plain if losses is None else prepare(spark, spec, as_of, losses)
    if spec.source.repeatable and spec.replaces:
        yield df, plain.count()
    elif spec.source.repeatable:
        yield plain, df.count()
    elif spec.replaces:
        yield df, 0 if plain.isEmpty() else None
    else:
        with staged(df) as copy:
            yield copy, copy.count()


def _later(spark: SparkSession, spec: TableSpec, since: int | None) -> TableSpec:
    """The spec with its source read from the mark on, unless a target has yet to be filled."""
    if spec.high_water is None or since is None:
        return spec
    if not all(t.exists(spark) for t in (spec.landing, spec.warehouse) if t):
        return spec
    return replace(spec, source=spec.high_water.later(spec.source, since))


def load_table(
    spark: SparkSession,
    spec: TableSpec,
    as_of: datetime | None = None,
    *,
    since: int | None = None,
) -> LoadResult:
    """Load one table into its targets; errors are raised.

    ``since`` is when the last successful load began, in microseconds since 1970, for
    specs with a high-water mark.

    A source without rows leaves the targets alone. Running a load again is
    safe in every mode but ``append``: rows an earlier run, whole or broken off,
    has brought in are found and left out.
    """
    started = time.monotonic()
    as_of = as_of or datetime.now(UTC)
    spec = _later(spark, spec, since)
    result = LoadResult(spec.name, spec.mode, as_of=as_of)
    if spec.count_source:
        result.source_rows = spec.source.count(spark)
    losses = Observation() if spec.count_losses else None
    with _batch(spark, spec, as_of, losses) as (batch, result.offered):
        _check_source(result)
        if result.offered == 0:
            result.status, result.reason = "skipped", "empty"
        else:
            _fill_targets(spark, spec, batch, result)
            _check_source(result)
            if losses is not None and result.status == "success":
                result.lost = {name: n for name, n in losses.get.items() if n}
    result.seconds = round(time.monotonic() - started, 3)
    return result


def _check_source(result: LoadResult) -> None:
    if None not in (result.source_rows, result.offered) and result.source_rows != result.offered:
        raise CountMismatch(f"counted {result.source_rows}, read {result.offered}")


def _fill_targets(spark, spec: TableSpec, batch: DataFrame, result: LoadResult) -> None:
    try:
        if spec.landing:
            counts = fill(spark, spec, spec.landing, batch, result.offered)
            result.landing_before, result.landed, result.landing_after = counts
            if result.offered is None:
                result.offered = result.landed
        if spec.warehouse:
            rows, offered, fresh = batch, result.offered, False
            if spec.landing and spec.replaces:
                rows, offered = spec.landing.read(spark), result.landing_after
            elif spec.landing and spec.mode in ("incremental", "incremental_insert"):
                rows, offered, fresh = _missed(spark, spec, batch), None, True
            counts = fill(spark, spec, spec.warehouse, rows, offered, fresh=fresh)
            result.warehouse_before, result.loaded, result.warehouse_after = counts
            if result.offered is None:
                result.offered = result.loaded
    except TargetAbsent as error:
        result.status, result.reason = "skipped", str(error)
        return
    if not (result.landed or result.loaded):
        result.reason = "no new rows"


def _missed(spark: SparkSession, spec: TableSpec, batch: DataFrame) -> DataFrame:
    """Landed rows whose key the warehouse lacks, and the batch's rows without a key.

    Keys decide, as counts may be equal where rows differ. Only the key columns of
    both sides are compared; wide rows are read for the keys that are missing, those
    of the batch as well as what earlier loads that broke off have left behind.
    """
    key = spec.key_column
    landed, held = spec.landing.read(spark), spec.warehouse.read(spark)
    if held is None:
        return landed
    use_checkpoints(spark)
    missing = new_rows(
        landed.select(ref(key)).filter(ref(key).isNotNull()),
        held.select(ref(key)),
        key,
        dedupe=True,
        hex_digits=HEX_DIGITS[spec.digest],
        existing_buckets=spec.warehouse.buckets,
    ).checkpoint()
    rows = landed.join(missing, key, "left_semi").select(*map(ref, landed.columns))
    loose = batch.filter(ref(key).isNull())
    return rows.unionByName(loose, allowMissingColumns=True)


def _check_types(batch: DataFrame, target: Target, held: DataFrame) -> None:
    """Files take rows of any type, and cannot be read back if the types differ."""
    faults = [v for v in violations(batch, held.schema) if v.problem == "type"]
    if faults and (target.path or target.table):
        raise ContractViolation(faults)


def rekey(
    spark: SparkSession,
    spec: TableSpec,
    target: Target,
    as_of: datetime | None = None,
    theirs: KeyMaking | None = None,
) -> int:
    """Give a target the keys that loads by the spec make; rows it holds, 0 if nothing was to do.

    How the held keys were made is what the target says or its rows show, or ``theirs``.
    Rows whose key their own columns no longer give, since values were settled after it
    was made, are found again in the source, which must still hold them.
    """
    key, held = spec.key_column, target.read(spark)
    if held is None or key is None:
        return 0
    theirs = theirs or target.making(held, key) or recognised(held, key, spec.making)
    if theirs is None:
        raise KeyMismatch(f"{spec.name}: cannot tell how the held keys were made")
    if theirs == spec.making:
        return 0
    before = target.count(spark, held)
    source = None
    if spec.contract is not None:
        source = contents(spark, spec, as_of or datetime.now(UTC))
    rows = rekeyed(held, key, spec.making, theirs, source)
    if target.publish == "switch" and not target.buckets:
        written = target.overwrite(rows, key)
    else:
        with staged(rows) as copy:
            written = target.overwrite(recorded(copy, key, spec.making), key)
    if written != before:
        raise CountMismatch(f"held {before}, re-keyed {written}")
    return written


def fill(
    spark: SparkSession,
    spec: TableSpec,
    target: Target,
    batch: DataFrame,
    offered: int | None,
    *,
    fresh: bool = False,
) -> tuple[int, int, int]:
    """Write a batch to one target by the spec's mode; rows before, written, after.

    ``fresh`` says that the target holds none of the batch's keys.
    """
    key = spec.key_column
    by_key = key and spec.mode in ("incremental", "incremental_insert")
    held = None if spec.replaces else target.read(spark)
    before = 0 if held is None else target.count(spark, held)
    if held is None and spec.mode not in ("historical", "incremental"):
        raise TargetAbsent("target does not exist")
    if held is not None:
        if target.widen:
            held, batch = target.widened(held, batch, keyed=bool(by_key))
        _check_types(batch, target, held)
        if key and spec.mode != "truncate_append":
            check_making(held, key, spec.making, target.making(held, key))
    if spec.replaces:
        write, rows = target.overwrite, batch
    elif spec.mode in ("append", "truncate_append"):
        write, rows = target.append, batch
        if spec.mode == "truncate_append":
            before = 0
            if target.publish == "switch":
                write = target.overwrite
            else:
                target.truncate(spark, batch.schema, key)
    else:
        write = target.overwrite if held is None else target.append
        kept = target.key_filter
        if kept and not fresh and before and kept.rows(spark) == before:
            batch = checked_keys(batch, key, HEX_DIGITS[spec.digest])
            batch, existing = kept.sift(batch, key, compact=not spec.one_per_key)
            existing_rows = None
        else:
            existing, existing_rows = (None, None) if fresh else (held, before)
        rows = new_rows(
            batch,
            existing,
            key,
            dedupe=spec.one_per_key,
            batch_rows=offered,
            existing_rows=existing_rows,
            hex_digits=HEX_DIGITS[spec.digest],
            existing_buckets=target.buckets,
            compact=not target.buckets,
        )
    keys = _kept_keys(spark, spec, target, rows, before)
    rows = recorded(rows, key, spec.making) if key else rows
    appended_to = held if spec.check_content and before and write == target.append else None
    content = 0 if appended_to is None else multiset(appended_to)
    seen = Observation()
    if spec.check_content:
        rows = rows.observe(seen, content_sum(rows).alias("content"))
    written = write(rows, key)
    after = target.count(spark)
    if after != before + written or (spec.replaces and offered not in (None, written)):
        raise CountMismatch(f"held {before}, offered {offered}, wrote {written}, holds {after}")
    if spec.check_content:
        expected, found = content + int(seen.get["content"] or 0), multiset(target.read(spark))
        if expected != found:
            raise ContentMismatch(f"rows add up to {expected} as written, to {found} as held")
    if target.key_filter and key:
        _keep_keys(spark, target, key, keys, written, after)
    return before, written, after


def content_sum(df: DataFrame) -> Column:
    """A sum over hashes of whole rows: the same for the same rows in any order."""
    return F.sum(F.xxhash64(*(ref(c) for c in sorted(df.columns))).cast("decimal(38,0)"))


def multiset(df: DataFrame) -> int:
    return int(df.agg(content_sum(df)).first()[0] or 0)


def _kept_keys(spark, spec: TableSpec, target: Target, rows: DataFrame, before: int):
    """The keys about to be written, if the target's filter is in step with what it holds.

    They are written down first: once the rows are there, they are no longer new.
    """
    kept, by_key = target.key_filter, spec.mode in ("incremental", "incremental_insert")
    if not (kept and by_key and spec.key_column and before) or kept.rows(spark) != before:
        return None
    use_checkpoints(spark)
    return rows.select(ref(spec.key_column)).checkpoint()


def _keep_keys(spark, target: Target, key: str, keys: DataFrame | None, written: int, after: int):
    """Bring the target's filter in step: by the keys written, or anew from all it holds."""
    if keys is not None and written:
        target.key_filter.add(keys, key, written)
    elif keys is None:
        target.key_filter.clear(spark)
        target.key_filter.add(target.keys(spark, key), key, after)
