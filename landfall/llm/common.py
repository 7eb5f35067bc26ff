"""What several operators of this package share: tables, saved frames, arrays."""

from __future__ import annotations

import atexit
import os
from collections.abc import Iterator
from functools import reduce

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..sources.shared import _hadoop, new_folder

BLANK = b" \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ship(spark: SparkSession) -> None:
    """Let Python workers import this library from where the driver has it, as far as they see it."""
    home = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    spark.sparkContext.environment.setdefault("PYTHONPATH", home)


# Rows that a Python worker and its executor hold at a time; texts are wide.
BATCH_ROWS = 1_000
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def small_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    """Let the session send no more than so many rows at a time to Python; a lower number stays."""
    if not 0 < int(spark.conf.get(_BATCH)) <= rows:
        spark.conf.set(_BATCH, str(rows))


# Spark drops a query's shuffle files when it ends, not when the driver collects its garbage.
_TIDY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def saved(df: DataFrame, purpose: str) -> DataFrame:
    """The frame as a table in the shared folder, which outlives any executor.

    The shuffle files behind it go at once, the table when the driver's process ends.
    """
    spark = df.sparkSession
    path = new_folder(spark, purpose)
    before = spark.conf.get(_TIDY, None)
    spark.conf.set(_TIDY, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        if before is None:
            spark.conf.unset(_TIDY)
        else:
            spark.conf.set(_TIDY, before)
    atexit.register(_remove, spark, path)
    return spark.read.schema(df.schema).parquet(path)


def _remove(spark: SparkSession, path: str) -> None:
    if spark.sparkContext._jsc is not None:
        files, place = _hadoop(spark, path)
        files.delete(place, True)


# Buckets of numbers whose bits are broadcast at a time; a bucket has 4 KiB for 32,768 numbers.
BUCKETS = 8192


def within(rows: DataFrame, picked: DataFrame, buckets: int | None = None) -> DataFrame:
    """The rows whose `uid` is among those of `picked`, without a shuffle of the rows.

    One bit a number travels, in bitmaps of a bounded number of buckets at a time, each
    time joined to the rows of that range alone; files of rising numbers are read once.
    """
    found = [rows.limit(0)]
    for first, bits in _bit_ranges(picked, buckets):
        some = rows.filter(first).withColumn("bucket", F.bitmap_bucket_number("uid"))
        some = some.join(F.broadcast(bits), "bucket").filter(F.expr(_IS_SET))
        found.append(some.select(*rows.columns))
    return reduce(DataFrame.unionByName, found[1:] or found)


def without(rows: DataFrame, picked: DataFrame, buckets: int | None = None) -> DataFrame:
    """The other rows, in the same way."""
    found = [rows]
    for first, bits in _bit_ranges(picked, buckets, whole=True):
        some = rows.filter(first).withColumn("bucket", F.bitmap_bucket_number("uid"))
        some = some.join(F.broadcast(bits), "bucket", "left")
        some = some.filter(F.coalesce(~F.expr(_IS_SET), F.lit(True)))
        found.append(some.select(*rows.columns))
    return reduce(DataFrame.unionByName, found[1:] or found)


_BYTE = "conv(hex(substring(bits, int(bitmap_bit_position(uid) div 8) + 1, 1)), 16, 10)"
_IS_SET = f"shiftright(int({_BYTE}), int(bitmap_bit_position(uid) % 8)) % 2 = 1"


def _bit_ranges(
    picked: DataFrame, buckets: int | None, whole: bool = False
) -> Iterator[tuple[Column, DataFrame]]:
    """Ranges of `uid`, and the bitmaps of the numbers picked in each.

    Ranges that are `whole` leave no number out, also where none is picked.
    """
    buckets = buckets or BUCKETS
    place = F.bitmap_bit_position("uid")
    bits = picked.groupBy(F.bitmap_bucket_number("uid").alias("bucket"))
    bits = saved(bits.agg(F.bitmap_construct_agg(place).alias("bits")), "bits")
    rank = F.row_number().over(Window.orderBy("bucket")) % buckets
    starts = bits.select("bucket", rank.alias("rank")).filter(F.col("rank") == 1 % buckets)
    starts = sorted(r["bucket"] for r in starts.select("bucket").collect())
    if whole and starts:
        starts[0] = 0
    ends = [*(s - 1 for s in starts[1:]), None][: len(starts)]
    for start, end in zip(starts, ends, strict=True):
        inside = F.col("bucket") >= start
        first = F.col("uid") > (start - 1) * (1 << 15) if start else F.col("uid") >= 0
        if end is not None:
            inside &= F.col("bucket") <= end
            first &= F.col("uid") <= end * (1 << 15)
        yield first, bits.filter(inside)


def drawn(rows: DataFrame, most: int, *order: str) -> DataFrame:
    """At most so many rows, drawn by a hash of the columns named, the same ones every time.

    A threshold on the hash thins the rows where they lie, so that little more than
    the sample itself travels.
    """
    grid = 1 << 30
    share = min(1.0, 1.2 * most / max(1, rows.count()))
    at = F.pmod(F.xxhash64(*order), F.lit(grid))
    return rows.filter(at < int(share * grid)).orderBy(at, *order).limit(most)


def text_of(name: str = "text") -> Column:
    """A text column with NULL as the empty text."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def words_of(text: str) -> list[bytes]:
    """Words between ASCII blanks, as UTF-8; these are the words of `[^\\x20\\x09-\\x0D]+`."""
    return text.encode().split()


def numbered(words: list, known: dict | None = None) -> np.ndarray:
    """Each word's number in order of first appearance."""
    known = {} if known is None else known
    return np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, len(words))


def word_hashes(words: list[bytes]) -> np.ndarray:
    """A 64-bit hash of each word. Nothing is remembered: a look-up takes as long as the hash."""
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def joined(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Hashes of runs of words out of the hashes of their two parts."""
    return mix(a * np.uint64(0x9E3779B97F4A7C15) + b)


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A 64-bit finalizer: distinct inputs stay distinct, bits become even."""
    x = x.astype(np.uint64) + np.uint64((seed * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) & (2**64 - 1))
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))
