"""Where queries and the SQL that states the same result are put down."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.names import ref

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

# The load time of every query, on the clock of the session's time zone.
AS_OF = "2024-01-15 12:00:00"
# Orders placed before this day count as already loaded.
LOADED_UNTIL = "1998-01-01"

ORDERS = (
    "o_orderkey",
    "o_custkey",
    "o_orderstatus",
    "o_totalprice",
    "o_orderdate",
    "o_orderpriority",
)
PART = ("p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice")


def query(oracle: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its own name, with its SQL if there is one."""

    def register(run: Query) -> Query:
        QUERIES[run.__name__] = run
        if oracle is not None:
            ORACLES[run.__name__] = oracle
        return run

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def load_time(spark: SparkSession) -> datetime:
    """``AS_OF`` as an instant."""
    return spark.sql(f"SELECT TIMESTAMP '{AS_OF}' AS now").first().now.astimezone()


def wall_clock(df: DataFrame) -> DataFrame:
    """Zoned timestamps as the session's clock shows them, to compare with SQL."""

    def shown(field: T.StructField) -> Column:
        zoned = isinstance(field.dataType, T.TimestampType)
        column = ref(field.name)
        return column.cast("timestamp_ntz").alias(field.name) if zoned else column

    return df.select(*(shown(f) for f in df.schema.fields))


def compat_text(*columns: str) -> str:
    """The compat encoding in SQL."""
    return f"concat_ws('||', {', '.join(f'CAST({c} AS VARCHAR)' for c in columns)})"


def strict_text(*columns: str) -> str:
    """The strict encoding in SQL."""
    parts = []
    for column in sorted(columns):
        text = f"CAST({column} AS VARCHAR)"
        parts.append(f"'{len(column)}|{column}|' || CAST(strlen({text}) AS VARCHAR) || '|' || {text}")
    return f"concat_ws('|', {', '.join(parts)})"


def audit_sql(system: str) -> str:
    return (
        f"TIMESTAMP '{AS_OF}' AS \"ETL_CREATED_DATE\","
        f" TIMESTAMP '{AS_OF}' AS \"ETL_LAST_UPDATE_DATE\","
        f" 'ETL_PROCESS' AS \"CREATED_BY\", TRUE AS \"TO_PROCESS\","
        f" '{system}' AS \"EDW_EXTERNAL_SOURCE_SYSTEM\""
    )
