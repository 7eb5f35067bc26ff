"""Kept key filters: which keys a target holds, asked without reading all of them.

Beside a target lie its keys, in files by the first digits of the key, and a Bloom filter
for each longer prefix and append. A batch's keys are tested against the filters of their
prefixes; only those that may be held are looked up, in the few files of their digits.
What comes out is exact, as a filter has no false "no" and every "maybe" is looked up.

Each append is a run of its own: keys, then filters, then one line that makes the run
count. A run without that line is not looked at. The lines' rows are held against the
rows of the target: where they differ, as after a load that broke off, the filter knows
that it is out of step, and is made anew from the target.

Filters that fit a broadcast are sent to the batch, which is then tested where it is read.
Keys that must be shuffled travel as bytes, half as long, if they are hex digits.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.names import ref
from ..sources.shared import _hadoop, path_exists, use_checkpoints
from .changes import BROADCAST_BYTES, ROW_BYTES, key_cost

# Bits of a filter, hash functions, digits of the key files, most files named one by one.
BITS = 1 << 15
HASHES = 4
FILE_DIGITS = 2
MOST_FILES = 10_000

PREFIX, FILTER, MISTAKEN = "__prefix", "__bits", "__mistaken"
PACKED, DIGITS = "__packed", "__digits"


@dataclass(frozen=True)
class KeyFilter:
    """The filter kept in a folder; a prefix of ``digits`` should have some 3,000 keys a run."""

    folder: str
    digits: int = 3

    def _prefix(self, key: str, digits: int) -> Column:
        return F.substring(ref(key), 1, digits)

    def _runs(self, spark: SparkSession) -> DataFrame | None:
        path = f"{self.folder}/runs"
        return spark.read.parquet(path) if path_exists(spark, path) else None

    def rows(self, spark: SparkSession) -> int:
        """Rows of the target that the runs account for."""
        runs = self._runs(spark)
        return 0 if runs is None else runs.agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0]

    def clear(self, spark: SparkSession) -> None:
        files, place = _hadoop(spark, self.folder)
        files.delete(place, True)

    def add(self, keys: DataFrame, key: str, rows: int) -> None:
        """Take in the keys of ``rows`` appended rows; NULL keys only count."""
        spark, run = keys.sparkSession, uuid.uuid4().hex
        held = keys.filter(ref(key).isNotNull()).select(ref(key).alias("key"))
        place = held.select(*_packed("key"), self._prefix("key", FILE_DIGITS).alias("digits"))
        place = place.repartition("digits").select(_unpacked().alias("key"), "digits")
        place = place.sortWithinPartitions("digits", "key")
        place.write.partitionBy("digits").parquet(f"{self.folder}/keys/run={run}")
        kept = spark.read.schema("key string").parquet(f"{self.folder}/keys/run={run}")
        bits = kept.select(self._prefix("key", self.digits).alias("prefix"), F.explode(_places("key")).alias("at"))
        bits = bits.groupBy("prefix").agg(F.bitmap_construct_agg("at").alias("bits"))
        bits.write.parquet(f"{self.folder}/filters/run={run}")
        line = spark.createDataFrame([(run, rows)], "run string, rows long")
        line.coalesce(1).write.mode("append").parquet(f"{self.folder}/runs")

    def _filters(self, spark: SparkSession) -> DataFrame:
        """`__prefix`, `__bits`, `run`: the filters of all runs."""
        filters = None
        for run in (r.run for r in self._runs(spark).collect()):
            own = spark.read.schema("prefix string, bits binary").parquet(f"{self.folder}/filters/run={run}")
            own = own.select(F.col("prefix").alias(PREFIX), F.col("bits").alias(FILTER), F.lit(run).alias("run"))
            filters = own if filters is None else filters.unionByName(own)
        return filters

    def _sent(self, filters: DataFrame) -> DataFrame | None:
        """The filters to be broadcast, if they are few enough; of files a count reads footers only."""
        fits = filters.count() * (BITS // 8 + ROW_BYTES) <= BROADCAST_BYTES
        return F.broadcast(filters) if fits else None

    def maybe(self, keys: DataFrame, key: str) -> DataFrame:
        """`key`, `run`: the keys that the filter of a run does not rule out.

        A key offered several times may come as often, if the filters are broadcast.
        """
        offered = keys.filter(ref(key).isNotNull()).select(ref(key).alias("key"))
        filters = self._filters(keys.sparkSession)
        sent = self._sent(filters)
        if sent is None:
            offered = offered.distinct()
        offered = offered.select("key", self._prefix("key", self.digits).alias(PREFIX))
        tested = offered.join(filters if sent is None else sent, PREFIX)
        return tested.filter(_may_hold("key")).select("key", "run")

    def known(self, keys: DataFrame, key: str, mistaken: bool = False) -> DataFrame:
        """Those of the keys that the target holds, under the name ``key``.

        With ``mistaken`` those that only seem held come too, and ``__mistaken`` tells.
        """
        use_checkpoints(keys.sparkSession)
        maybe = self.maybe(keys, key).checkpoint()
        found, asked = self.lookup(maybe), maybe.select("key")
        if _few(asked, "key"):
            found = found.join(F.broadcast(asked), "key", "left_semi")
        sides = asked.select(*_packed("key"), F.lit(True).alias("asked"), F.lit(False).alias("held"))
        sides = sides.union(found.select(*_packed("key"), F.lit(False), F.lit(True)))
        sides = sides.groupBy(PACKED, DIGITS).agg(F.max("asked").alias("asked"), F.max("held").alias("held"))
        sides = sides.filter("asked").select(_unpacked().alias(key), (~F.col("held")).alias(MISTAKEN))
        return sides if mistaken else sides.filter(~ref(MISTAKEN)).select(ref(key))

    def sift(
        self, batch: DataFrame, key: str, *, compact: bool = False
    ) -> tuple[DataFrame, DataFrame | None]:
        """The batch, and those of its keys that the target holds: ``None`` if their rows are left out.

        Rows of many held keys are left out where the batch is read: they are those the
        filters do not rule out, but for the few keys that only seem held. ``compact`` brings
        the rest together in few partitions if it is small.
        """
        asked = self.known(batch, key, True).checkpoint()
        held = asked.filter(~ref(MISTAKEN)).select(ref(key))
        mistaken = asked.filter(ref(MISTAKEN))
        if _few(held, key) or not _few(mistaken, key):
            return batch, held
        filters = self._sent(self._filters(batch.sparkSession).drop("run"))
        if filters is None:
            return batch, held
        rows = batch.join(F.broadcast(mistaken), key, "left")
        seems = (self._prefix(key, self.digits) == ref(PREFIX)) & _may_hold(key)
        rows = rows.join(filters, seems & ref(MISTAKEN).isNull(), "left_anti")
        rows = rows.select(*map(ref, batch.columns))
        return rows.hint("rebalance") if compact and _few(rows, key) else rows, None

    def lookup(self, maybe: DataFrame) -> DataFrame:
        """The key files in which these keys would be."""
        spark = maybe.sparkSession
        files = maybe.select("run", self._prefix("key", FILE_DIGITS).alias("digits")).distinct()
        named = files.limit(MOST_FILES + 1).collect()
        if len(named) > MOST_FILES:
            paths = [f"{self.folder}/keys/run={r.run}" for r in self._runs(spark).collect()]
        else:
            paths = [f"{self.folder}/keys/run={f.run}/digits={f.digits}" for f in named]
        # a run without keys has no files, and a key that seems held may have none either
        paths = [p for p in paths if path_exists(spark, p)]
        if not paths:
            return spark.createDataFrame([], "key string")
        return self._keys_in(spark, paths)

    def _keys_in(self, spark: SparkSession, paths: list[str]) -> DataFrame:
        reader = spark.read.schema("key string").option("basePath", f"{self.folder}/keys")
        return reader.parquet(*paths).select("key")

    def compact(self, spark: SparkSession) -> None:
        """Bring all runs into one, so that a key is tested against one filter."""
        runs = [r.run for r in self._runs(spark).collect()]
        paths = [f"{self.folder}/keys/run={run}" for run in runs]
        fresh = KeyFilter(f"{self.folder}-{uuid.uuid4().hex}", self.digits)
        keys = self._keys_in(spark, paths)
        fresh.add(keys, "key", self.rows(spark))
        self.clear(spark)
        files, place = _hadoop(spark, fresh.folder)
        files.rename(place, _hadoop(spark, self.folder)[1])


def _few(keys: DataFrame, key: str) -> bool:
    """Whether the keys may be broadcast."""
    return (keys.agg(F.sum(key_cost(keys, key))).first()[0] or 0) <= BROADCAST_BYTES


def _packed(key: str) -> tuple[Column, Column]:
    """A key as bytes, and whether they are those its lower-case hex digits stand for."""
    digits = (F.length(ref(key)) % 2 == 0) & ref(key).rlike("^[0-9a-f]+$")
    packed = F.when(digits, F.unhex(ref(key))).otherwise(ref(key).cast("binary"))
    return packed.alias(PACKED), digits.alias(DIGITS)


def _unpacked() -> Column:
    return F.when(ref(DIGITS), F.lower(F.hex(ref(PACKED)))).otherwise(ref(PACKED).cast("string"))


def _place(key: str, at: int) -> Column:
    return F.pmod(F.xxhash64(ref(key), F.lit(at)), F.lit(BITS))


def _places(key: str) -> Column:
    return F.array(*(_place(key, at) for at in range(HASHES)))


def _may_hold(key: str) -> Column:
    """Whether a filter, ``__bits``, does not rule a key out."""
    places = [_is_set(_place(key, at)) for at in range(HASHES)]
    return reduce(Column.__and__, places)


def _is_set(place: Column) -> Column:
    byte = F.substring(FILTER, F.floor(place / 8).cast("int") + 1, F.lit(1))
    value = F.conv(F.hex(byte), 16, 10).cast("int")
    return F.getbit(value, (place % 8).cast("int")) == 1
