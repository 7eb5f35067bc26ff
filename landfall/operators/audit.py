"""Audit columns: P7 and C13."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.moments import Moment, moment

# Names, types and default creator of the audit columns.
AUDIT_SCHEMA = T.StructType(
    [
        T.StructField("ETL_CREATED_DATE", T.TimestampType(), False),
        T.StructField("ETL_LAST_UPDATE_DATE", T.TimestampType(), False),
        T.StructField("CREATED_BY", T.StringType(), False),
        T.StructField("TO_PROCESS", T.BooleanType(), False),
        T.StructField("EDW_EXTERNAL_SOURCE_SYSTEM", T.StringType(), False),
    ]
)
AUDIT_COLUMNS = tuple(AUDIT_SCHEMA.names)
CREATOR = "ETL_PROCESS"


def stamp(
    df: DataFrame,
    system: str,
    as_of: Moment = None,
    *,
    creator: str = CREATOR,
    to_process: bool = True,
) -> DataFrame:
    """Append the audit columns, replacing any that are there."""
    now = moment(as_of)
    values = (now, now, F.lit(creator), F.lit(to_process), F.lit(system))
    return df.withColumns(
        {f.name: v.cast(f.dataType) for f, v in zip(AUDIT_SCHEMA.fields, values, strict=True)}
    )
