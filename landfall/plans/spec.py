"""What to load: one spec per table, and the choice among them."""

from __future__ import annotations

from collections.abc import Collection, Iterable, Mapping
from dataclasses import dataclass
from typing import Protocol

from pyspark.sql import DataFrame, SparkSession

from ..contracts import Contract
from ..functions.digest import KeyMaking
from ..operators.audit import CREATOR
from ..sinks.targets import Target
from ..sources.high_water import HighWater

MODES = ("historical", "incremental", "append", "truncate_append", "incremental_insert")


class Source(Protocol):
    # Whether reading it again gives the same rows.
    repeatable: bool

    def scan(self, spark: SparkSession) -> DataFrame: ...


@dataclass(frozen=True)
class TableSpec:
    """One table's load.

    ``mode`` says what happens to the targets:

    ``historical``          replace them;
    ``incremental``         append rows whose key they lack, create them if absent;
    ``incremental_insert``  the same, but a target must be there already;
    ``append``              append everything, a target must be there already;
    ``truncate_append``     the same after dropping the rows it holds.

    Without a key every load of the first two kinds replaces. ``dedupe`` keeps
    one row per new key; by default only under the strict encoding, where equal
    keys mean equal rows.
    """

    name: str
    source: Source
    system: str
    mode: str = "incremental"
    contract: Contract | None = None
    key: str | None = None
    names: str | None = "strict"
    # Of the key; by default the contract's, without one "strict" and "sha3_512".
    key_encoding: str | None = None
    key_digest: str | None = None
    # Of the encoding; the present one unless an older one is named.
    key_version: int | None = None
    nested: str = "reject"
    dedupe: bool | None = None
    landing: Target | None = None
    warehouse: Target | None = None
    creator: str = CREATOR
    # Ask the source for its own row count and hold the rows read against it.
    count_source: bool = False
    # Count the values that cleaning made NULL, column by column.
    count_losses: bool = False
    # Hold the content of what the targets then have against what was written.
    check_content: bool = False
    # Read the source from the last success in the run log on (see HighWater).
    high_water: HighWater | None = None

    def __post_init__(self):
        if self.mode not in MODES:
            raise ValueError(f"unknown load mode: {self.mode!r}, expected one of {MODES}")
        if not (self.landing or self.warehouse):
            raise ValueError(f"{self.name}: no target to load into")
        if self.count_source and not hasattr(self.source, "count"):
            raise ValueError(f"{self.name}: the source cannot count its rows")
        if self.count_losses and not self.contract:
            raise ValueError(f"{self.name}: nothing is cleaned without a contract")
        if self.mode == "incremental_insert" and not self.key_column:
            raise ValueError(f"{self.name}: incremental_insert needs a key column")
        if self.high_water and not (
            self.mode in ("incremental", "incremental_insert") and self.key_column
        ):
            raise ValueError(f"{self.name}: a high-water mark needs a load by key")
        for target in filter(None, (self.landing, self.warehouse)):
            by_key = self.mode in ("incremental", "incremental_insert") and self.key_column
            if target.buckets and not (by_key and self.one_per_key):
                raise ValueError(f"{self.name}: buckets need a load by key, with dedupe")

    @property
    def key_column(self) -> str | None:
        return self.key or (self.contract.key if self.contract else None)

    @property
    def encoding(self) -> str:
        return self.key_encoding or (self.contract.key_encoding if self.contract else "strict")

    @property
    def digest(self) -> str:
        return self.key_digest or (self.contract.key_digest if self.contract else "sha3_512")

    @property
    def making(self) -> KeyMaking:
        return KeyMaking(self.encoding, self.digest, self.nested, self.key_version)

    @property
    def one_per_key(self) -> bool:
        return self.encoding == "strict" if self.dedupe is None else self.dedupe

    @property
    def replaces(self) -> bool:
        return self.mode == "historical" or (self.mode == "incremental" and not self.key_column)


def select_specs(
    specs: Iterable[TableSpec],
    *,
    exclude: Collection[str] = (),
    allow: Collection[str] | None = None,
    enabled: Mapping[str, bool] | None = None,
) -> tuple[list[TableSpec], dict[str, str]]:
    """The specs to run, and why each of the others is left out."""
    chosen, left_out = [], {}
    for spec in specs:
        if spec.name in exclude:
            left_out[spec.name] = "excluded"
        elif allow is not None and spec.name not in allow:
            left_out[spec.name] = "not on the list"
        elif enabled is not None and not enabled.get(spec.name, False):
            left_out[spec.name] = "switched off"
        else:
            chosen.append(spec)
    return chosen, left_out


def missing_tables(
    spark: SparkSession, expected: Collection[str], discovered: DataFrame
) -> DataFrame:
    """Expected tables the source does not list: column ``table_name``."""
    wanted = spark.createDataFrame([(name,) for name in expected], "table_name string")
    return wanted.join(discovered.select("table_name").distinct(), "table_name", "left_anti")

