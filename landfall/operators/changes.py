"""Rows a target does not hold yet: J1, J2, and duplicates within a batch."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.names import ref
from ..sources.shared import use_checkpoints

# The most that is broadcast at a time, and what a key costs beside its bytes.
BROADCAST_BYTES = 128 << 20
ROW_BYTES = 128
# A key held by this many rows of the batch is too much for one join task.
HOT_ROWS = 1_000_000

KEY, ROWS, KNOWN = "__key", "__rows", "__known"


def new_rows(
    batch: DataFrame,
    existing: DataFrame | None,
    key: str,
    *,
    dedupe: bool = False,
    order_by: Sequence[str | Column] = (),
    batch_rows: int | None = None,
    existing_rows: int | None = None,
    hex_digits: int | None = None,
    existing_buckets: int | None = None,
    compact: bool = False,
    broadcast_bytes: int = BROADCAST_BYTES,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """The rows of ``batch`` whose key ``existing`` lacks.

    A NULL key matches nothing, so such rows are always new. Rows of the batch
    that share a new key all stay, unless ``dedupe`` keeps one of them, the
    first by ``order_by``. ``existing`` may be ``None``: nothing is held yet.

    The sizes of both sides decide the way. They are counted unless given, and
    over columnar files a count reads footers only. Only keys that are measured
    to take at most ``broadcast_bytes`` are ever broadcast. ``hex_digits`` says
    that the batch's keys are hex digests of that length: it saves the measuring,
    and large sets of keys travel as bytes, half as long. Existing keys then count
    in either case, those that are no digests match nothing, and a key of the batch that
    is no digest in lower case stops the job, whichever way is taken. ``existing_buckets`` says that
    ``existing`` is a table in that many buckets by key. ``compact`` brings the
    new rows together in few partitions if they turn out to be few among many
    rows read, so that writing them does not leave a small file per task.

    * few existing keys: these are broadcast, the batch is not shuffled;
    * small batch: its keys are broadcast to thin out the existing keys where
      they are read, so the large target is not shuffled;
    * both large, or a large batch to dedupe: see :func:`_tally`.
    """
    limits = (key, hex_digits, broadcast_bytes)
    if existing is not None and existing_rows is None:
        existing_rows = existing.count()
    held = existing.select(ref(key)) if existing_rows else None
    if hex_digits:
        batch = checked_keys(batch, key, hex_digits)
    if held is not None and hex_digits:
        # Keys of another making match none of the batch's, and may be of any length.
        digest = (F.length(ref(key)) == hex_digits) & F.unhex(ref(key)).isNotNull()
        held, plain = held.filter(digest), ref(key) == F.lower(ref(key))
        # Buckets are by the key as it stands, so they serve only if all are in lower case.
        if not existing_buckets or not held.filter(~plain).isEmpty():
            held, existing_buckets = held.select(F.lower(ref(key)).alias(key)), None
    if batch_rows is None and (dedupe or held is not None):
        batch_rows = batch.count()
    few = held is not None and _fits(held, existing_rows, *limits)
    if few:
        kept, held = _without(batch, F.broadcast(held), key), None
    else:
        kept = batch
    if held is None and not dedupe:
        return kept
    if not _fits(batch, batch_rows, *limits):
        # Buckets are by the key as it stands.
        packed = hex_digits if not existing_buckets else None
        tally = _tally(kept, held, key, packed, existing_buckets)
        rows = _by_tally(
            kept, tally, key, packed, dedupe, order_by, compact, broadcast_bytes, hot_rows
        )
        return rows.select(*map(ref, batch.columns))
    if held is not None:
        offered = F.broadcast(batch.select(ref(key)))
        met = held.join(offered, key, "left_semi").distinct()
        kept = _without(batch, F.broadcast(met), key)
    if dedupe:
        kept = first_per_key(kept, key, order_by)
    return kept.hint("rebalance") if compact else kept


def key_cost(df: DataFrame, key: str) -> Column:
    """Bytes one key takes in a broadcast."""
    kind = df.schema[key].dataType
    if isinstance(kind, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(ref(key)), F.lit(0)) + ROW_BYTES
    return F.lit(16 + ROW_BYTES)


def _fits(
    df: DataFrame, rows: int, key: str, key_bytes: int | None, broadcast_bytes: int
) -> bool:
    """Whether the frame's keys may be broadcast.

    Keys of unknown length are measured, but only if their number alone leaves
    a chance, so never over a large table.
    """
    if key_bytes is None and rows * ROW_BYTES <= broadcast_bytes:
        return (df.agg(F.sum(key_cost(df, key))).first()[0] or 0) <= broadcast_bytes
    return rows * (ROW_BYTES + (key_bytes or 0)) <= broadcast_bytes


def _without(batch: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    return batch.join(keys, key, "left_anti").select(*map(ref, batch.columns))


def _within(batch: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    return batch.join(keys, key, "left_semi").select(*map(ref, batch.columns))


def _as_bytes(key: str) -> Column:
    """A digest as bytes, of half its length.

    Never NULL: Catalyst would check for it before a join, and make the digest
    once more for that.
    """
    return F.coalesce(F.unhex(ref(key)), F.lit("").cast("binary"))


def checked_keys(batch: DataFrame, key: str, hex_digits: int) -> DataFrame:
    """The batch, in which a key that is no digest of that length stops the job."""
    says = F.lit(f"a key is not {hex_digits} hex digits in lower case: ")
    wrong = F.raise_error(F.concat(says, ref(key))).cast("string")
    good = ref(key).isNull() | ref(key).rlike(f"^[0-9a-f]{{{hex_digits}}}$")
    checked = F.when(good, ref(key)).otherwise(wrong)
    if not batch.schema[key].nullable:
        checked = F.coalesce(checked, F.lit(""))
    return batch.withColumn(key, checked)


def _tally(
    batch: DataFrame,
    held: DataFrame | None,
    key: str,
    hex_digits: int | None,
    buckets: int | None,
) -> DataFrame:
    """How many rows of the batch each key has, and whether it is known.

    The keys of both sides are counted in one aggregation, which collapses a
    hot key within each map task. Keys held in buckets need no shuffle; there
    the counted keys of the batch are sent to the buckets instead.
    """
    use_checkpoints(batch.sparkSession)
    seen = batch.filter(ref(key).isNotNull()).select(ref(key).alias(KEY))
    if hex_digits:
        seen = seen.select(_as_bytes(KEY).alias(KEY))
    if held is None or buckets:
        tally = seen.groupBy(KEY).agg(F.count(F.lit(1)).alias(ROWS))
        is_known = F.lit(False)
        if held is not None:
            known = held.filter(ref(key).isNotNull()).distinct()
            known = known.select(ref(key).alias(KEY), F.lit(True).alias(KNOWN))
            tally = tally.repartition(buckets, KEY).join(known, KEY, "left")
            is_known = ref(KNOWN).isNotNull()
        return tally.select(KEY, ROWS, is_known.alias(KNOWN)).checkpoint()
    known = held.select((F.unhex(ref(key)) if hex_digits else ref(key)).alias(KEY))
    return (
        seen.select(KEY, F.lit(1).alias(ROWS), F.lit(False).alias(KNOWN))
        .union(known.filter(ref(KEY).isNotNull()).select(KEY, F.lit(0), F.lit(True)))
        .groupBy(KEY)
        .agg(F.sum(ROWS).alias(ROWS), F.max(KNOWN).alias(KNOWN))
        .filter(ref(ROWS) > 0)
        .checkpoint()
    )


def _by_tally(
    batch, tally, key, hex_digits, dedupe, order_by, compact, broadcast_bytes, hot_rows
) -> DataFrame:
    """Pick the rows by what is known of their keys.

    Rows of new keys are picked, with ``dedupe`` apart for keys that occur once
    and for keys to dedupe. Mostly either the keys wanted or all others are few;
    then these are broadcast and the wide rows are filtered where they are read.
    Else the wide rows are shuffled, but for those of hot keys, which are few: a
    key is hot from ``hot_rows`` rows on, or from more if the keys of that many
    rows might be too many to broadcast.
    """
    keyed, on = batch.filter(ref(key).isNotNull()), key
    if hex_digits:
        keyed, on = keyed.withColumn(KEY, _as_bytes(key)), KEY
    is_fresh, once, cost = ~ref(KNOWN), ref(ROWS) == 1, key_cost(tally, KEY)
    size = tally.agg(
        F.coalesce(F.sum(F.when(is_fresh & once, cost)), F.lit(0)).alias("once"),
        F.coalesce(F.sum(F.when(is_fresh & ~once, cost)), F.lit(0)).alias("more"),
        F.coalesce(F.sum(cost), F.lit(0)).alias("all"),
        F.coalesce(F.max(cost), F.lit(0)).alias("widest"),
        F.coalesce(F.sum(ROWS), F.lit(0)).alias("rows"),
        F.coalesce(F.max(ROWS), F.lit(0)).alias("most"),
    ).first()
    # So many rows a key that all such keys together fit the limit.
    hot_rows = max(hot_rows, size["rows"] * size["widest"] // broadcast_bytes + 1)
    is_hot = ref(ROWS) >= hot_rows

    def keys(condition: Column) -> DataFrame:
        return tally.filter(condition).select(ref(KEY).alias(on))

    def pick(wanted: Column, bytes_wanted: int) -> DataFrame:
        if bytes_wanted == 0:
            return keyed.limit(0)
        if bytes_wanted == size["all"]:
            return keyed
        if bytes_wanted <= broadcast_bytes:
            return _within(keyed, F.broadcast(keys(wanted)), on)
        if size["all"] - bytes_wanted <= broadcast_bytes:
            return _without(keyed, F.broadcast(keys(~wanted)), on)
        if size["most"] < hot_rows:
            return _within(keyed, keys(wanted), on)
        cold = _without(keyed, F.broadcast(keys(is_hot)), on)
        return _within(cold, keys(wanted & ~is_hot), on).unionByName(
            _within(keyed, F.broadcast(keys(wanted & is_hot)), on)
        )

    fresh = size["once"] + size["more"]
    if dedupe:
        repeated = pick(is_fresh & ~once, size["more"])
        found = pick(is_fresh & once, size["once"]).unionByName(
            first_per_key(repeated, key, order_by)
        )
    else:
        found = pick(is_fresh, fresh)
    found = found.drop(KEY).unionByName(batch.filter(ref(key).isNull()))
    return found.hint("rebalance") if compact and fresh <= broadcast_bytes else found


def first_per_key(df: DataFrame, key: str, order_by: Sequence[str | Column] = ()) -> DataFrame:
    """One row per key, and every row without a key.

    Spark applies the rank limit in each map task before it shuffles, so a hot
    key sends one row per task.
    """
    window = Window.partitionBy(ref(key)).orderBy(*(order_by or [ref(key)]))
    rank = "__rank"
    first = (
        df.filter(ref(key).isNotNull())
        .withColumn(rank, F.row_number().over(window))
        .filter(ref(rank) == 1)
        .drop(rank)
    )
    if not df.schema[key].nullable:
        return first
    return first.unionByName(df.filter(ref(key).isNull()))
