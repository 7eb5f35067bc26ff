"""A full snapshot against what a target holds, both ways."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.names import ref
from ..sources.shared import use_checkpoints
from .changes import BROADCAST_BYTES, ROW_BYTES, first_per_key

OFFERED, HELD, SURPLUS = "__offered", "__held", "__surplus"


def tally_both(snapshot: DataFrame, held: DataFrame, key: str) -> DataFrame:
    """Keys that the two sides do not hold equally often, with both counts.

    One aggregation over the keys of both, which collapses a hot key within each map
    task. NULL is a key like any other.
    """
    mine = snapshot.select(ref(key), F.lit(1).alias(OFFERED), F.lit(0).alias(HELD))
    theirs = held.select(ref(key), F.lit(0), F.lit(1))
    counts = mine.union(theirs).groupBy(ref(key)).agg(F.sum(OFFERED).alias(OFFERED), F.sum(HELD).alias(HELD))
    return counts.filter(ref(OFFERED) != ref(HELD))


def changed_rows(
    snapshot: DataFrame,
    held: DataFrame,
    key: str,
    *,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> tuple[DataFrame, DataFrame]:
    """The rows a target lacks, and the rows it holds that the snapshot no longer has.

    As ``EXCEPT ALL`` both ways: a row that is there more often on one side comes as
    often as it is too many. Equal keys have to mean equal rows, as under the strict
    encoding. The keys that differ are written down once; if few, they are sent to the
    rows, which are then not shuffled.
    """
    use_checkpoints(snapshot.sparkSession)
    tally = tally_both(snapshot, held, key).checkpoint()
    size = F.coalesce(F.octet_length(ref(key).cast("string")), F.lit(0)) + ROW_BYTES
    few = (tally.agg(F.sum(size)).first()[0] or 0) <= broadcast_bytes

    def side(rows: DataFrame, surplus: Column) -> DataFrame:
        wanted = tally.select(ref(key).alias(OFFERED), surplus.alias(SURPLUS)).filter(ref(SURPLUS) > 0)
        same = ref(key).eqNullSafe(ref(OFFERED))
        found = rows.join(F.broadcast(wanted) if few else wanted, same)
        one = first_per_key(found.filter(ref(key).isNotNull()), key)
        one = one.unionByName(found.filter(ref(key).isNull()).limit(1))
        times = F.explode(F.sequence(F.lit(1), ref(SURPLUS)))
        return one.withColumn(HELD, times).select(*map(ref, rows.columns))

    return side(snapshot, ref(OFFERED) - ref(HELD)), side(held, ref(HELD) - ref(OFFERED))
