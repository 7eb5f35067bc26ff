"""Reading a source from its last successful load on (K7, R2)."""

from __future__ import annotations

from dataclasses import dataclass, replace
from datetime import timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.names import ref
from .tables import TableSource


@dataclass(frozen=True)
class HighWater:
    """What tells later rows of a source.

    With a ``column`` (date or timestamp) rows count as later from the time of the last
    successful load less the ``overlap``; the filter goes to the files or the database.
    Rows whose column is NULL are always read. Without one, files changed since then are.
    The mark is when that load began, not the greatest value read, so a row dated far
    ahead hides nothing. The overlap must cover what comes late, and the difference of
    clocks; rows read again are found by their key.
    """

    column: str | None = None
    overlap: timedelta = timedelta(hours=1)

    def __post_init__(self):
        if self.overlap < timedelta(0):
            raise ValueError("an overlap cannot be negative")

    def later(self, source, micros: int):
        """The source without what is older than the mark (microseconds since 1970)."""
        return LaterRows(source, self, micros - self.overlap // timedelta(microseconds=1))


@dataclass(frozen=True)
class LaterRows:
    """A source's rows from a mark on."""

    source: object
    water: HighWater
    micros: int

    def __post_init__(self):
        by_files = self.water.column is None
        if by_files and not (isinstance(self.source, TableSource) and self.source.path):
            raise ValueError("only files can be told apart without a column")

    @property
    def repeatable(self) -> bool:
        return self.source.repeatable

    def scan(self, spark: SparkSession) -> DataFrame:
        if self.water.column is None:
            return self._later_files(spark).scan(spark)
        rows = self.source.scan(spark)
        column = ref(self.water.column)
        return rows.filter(column.isNull() | (column >= self._mark(rows)))

    def count(self, spark: SparkSession) -> int:
        return self.scan(spark).count()

    def _mark(self, rows: DataFrame) -> Column:
        """The mark in the column's own type, so that no cast keeps the filter from the scan."""
        kind = rows.schema[self.water.column].dataType
        if not isinstance(kind, T.DateType | T.TimestampType | T.TimestampNTZType):
            raise TypeError(f"{self.water.column}: {kind.simpleString()} has no time to tell later rows by")
        return F.timestamp_micros(F.lit(self.micros)).cast(kind)

    def _later_files(self, spark: SparkSession) -> TableSource:
        """Spark takes whole seconds, and files strictly after them."""
        second = F.timestamp_micros(F.lit(self.micros - 1_000_000))
        shown = F.date_format(second, "yyyy-MM-dd'T'HH:mm:ss")
        after = spark.range(1).select(shown.alias("after")).first().after
        schema = self.source.schema or self.source.scan(spark).schema
        options = {**self.source.options, "modifiedAfter": after}
        return replace(self.source, options=options, schema=schema)
