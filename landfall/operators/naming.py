"""Safe column names for a whole frame: P1, P2."""

from __future__ import annotations

from collections import defaultdict

from pyspark.sql import DataFrame

from ..functions.names import light_name, strict_name

POLICIES = {"strict": strict_name, "light": light_name}


class NameCollision(ValueError):
    """Several columns would get one name."""


def clean_names(df: DataFrame, policy: str = "strict") -> DataFrame:
    """Rename every column by the policy; raise if two names fall together.

    Names that differ only in case count as one unless the session is case
    sensitive, as Spark could not tell them apart afterwards.
    """
    rename = POLICIES[policy]
    cleaned = [rename(name) for name in df.columns]
    exact = df.sparkSession.conf.get("spark.sql.caseSensitive") == "true"
    sources = defaultdict(list)
    for raw, name in zip(df.columns, cleaned, strict=True):
        sources[name if exact else name.lower()].append(raw)
    clashes = [raws for raws in sources.values() if len(raws) > 1]
    if clashes:
        raise NameCollision(f"columns fall together under the {policy} policy: {clashes}")
    return df.toDF(*cleaned)
