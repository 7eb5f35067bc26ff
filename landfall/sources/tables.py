"""Tables in files, in Spark's catalog or behind a connector: S7, S10-S13."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from .shared import path_exists

# Error conditions that mean "nothing is there", as opposed to "cannot tell".
ABSENT = {
    "PATH_NOT_FOUND",
    "TABLE_OR_VIEW_NOT_FOUND",
    "UNABLE_TO_INFER_SCHEMA",
    "DELTA_TABLE_NOT_FOUND",
    "DELTA_PATH_DOES_NOT_EXIST",
    "DELTA_MISSING_DELTA_TABLE",
}


@dataclass(frozen=True)
class FrameSource:
    """A frame the caller has built, as the source of a load."""

    frame: DataFrame
    repeatable: bool = True

    def scan(self, spark: SparkSession) -> DataFrame:
        return self.frame


@dataclass(frozen=True)
class TableSource:
    """A stored table, by path or by options its connector knows."""

    path: str | None = None
    format: str = "parquet"
    options: Mapping[str, str] = field(default_factory=dict)
    schema: T.StructType | str | None = None
    # Whether a second read gives the same rows; files are taken to, others not.
    repeatable: bool | None = None

    def __post_init__(self):
        if self.repeatable is None:
            object.__setattr__(self, "repeatable", self.path is not None)

    def scan(self, spark: SparkSession) -> DataFrame:
        reader = spark.read.format(self.format).options(**self.options)
        if self.schema is not None:
            reader = reader.schema(self.schema)
        return reader.load(self.path) if self.path else reader.load()


def absent(error: AnalysisException) -> bool:
    return (error.getCondition() or "").split(".")[0] in ABSENT


def read_if_present(spark: SparkSession, source: TableSource) -> DataFrame | None:
    """The frame, or ``None`` if there is no such table; other errors stand."""
    if source.path and not path_exists(spark, source.path):
        return None
    try:
        return source.scan(spark)
    except AnalysisException as error:
        if absent(error):
            return None
        raise


def empty_frame(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """A frame without rows."""
    return spark.createDataFrame([], schema)


def landing_path(base: str, stage: str, database: str, table: str) -> str:
    """Where a landed table lies."""
    return "/".join((base.rstrip("/"), stage, database, table))
