"""The load's own "now", so that a load can be replayed and checked."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

Moment = datetime | str | Column | None


def moment(as_of: Moment) -> Column:
    """``as_of`` as a timestamp column; ``None`` is the time of the query.

    Text and naive datetimes are read in the session time zone.
    """
    if as_of is None:
        return F.current_timestamp()
    if isinstance(as_of, Column):
        return as_of
    if isinstance(as_of, datetime) and as_of.tzinfo is not None:
        return F.lit(as_of)
    return F.lit(str(as_of)).cast("timestamp")
