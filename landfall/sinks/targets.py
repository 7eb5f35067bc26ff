"""Where rows go: lakehouse folders, catalog tables, warehouse tables."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.digest import KeyMaking
from ..functions.names import quoted, ref
from ..operators.conform import ContractViolation, Violation
from ..operators.key_filter import KeyFilter
from ..operators.keys import RECORD, making_of
from ..operators.widening import wider_schema, widened_to
from ..sources.tables import TableSource, empty_frame, read_if_present
from .publish import ordered_as, recover, replace_folder, replace_table
from .schema_note import note_schema, noted_schema

# Reader options that go with a table, not with a query.
_SCAN_OPTIONS = {"dbtable", "partitioncolumn", "lowerbound", "upperbound", "numpartitions"}


@dataclass(frozen=True)
class Target:
    """A table rows are written to, by path, catalog name or connector options.

    ``format`` is any format Spark has a connector for, and ``options`` are what
    the connector needs to find the table. Further options go with one kind of
    write only, as ``overwriteSchema`` with ``on_overwrite`` and ``mergeSchema``
    with ``on_append`` (K3).

    ``exists_sql`` asks a connector that has no other way to tell whether the
    table is there: the query yields a row if it is.

    ``buckets`` (catalog tables only) keeps the table hashed by its key, so that
    finding new rows never shuffles it; it asks for loads that keep one row per
    key.

    ``publish`` says how the table is replaced: ``direct`` by Spark's overwrite, or
    ``switch``, beside the table and then in one step (see :mod:`.publish`).

    ``widen`` lets appended rows bring wider types and more columns than the table holds
    (see :mod:`..operators.widening`): Parquet folders, which then note their schema, and
    catalog tables, whose columns can be added to but keep their types.

    ``key_filter`` is kept beside the table, so that loads of small batches by key do
    not read all keys held.
    """

    path: str | None = None
    table: str | None = None
    format: str = "parquet"
    options: Mapping[str, str] = field(default_factory=dict)
    on_overwrite: Mapping[str, str] = field(default_factory=dict)
    on_append: Mapping[str, str] = field(default_factory=dict)
    on_truncate: Mapping[str, str] = field(default_factory=lambda: {"truncate": "true"})
    exists_sql: str | None = None
    buckets: int | None = None
    publish: str = "direct"
    key_filter: KeyFilter | None = None
    widen: bool = False

    def __post_init__(self):
        if self.path and self.table:
            raise ValueError("a target has a path or a table name, not both")
        if self.publish not in ("direct", "switch"):
            raise ValueError("publish must be 'direct' or 'switch'")
        if self.publish == "switch" and not (self.path or self.table):
            raise ValueError("only folders and catalog tables can be switched")
        if self.buckets and not self.table:
            raise ValueError("only catalog tables have buckets")
        if self.widen and (self.format != "parquet" or not (self.path or self.table)):
            raise ValueError("only Parquet folders and catalog tables are widened")

    def read(self, spark: SparkSession) -> DataFrame | None:
        """The whole table, or ``None`` if it does not exist."""
        if self.table:
            return spark.read.table(self.table) if spark.catalog.tableExists(self.table) else None
        if self.path and self.publish == "switch":
            recover(spark, self.path)
        if self.exists_sql and not self._ask(spark, self.exists_sql).take(1):
            return None
        schema = noted_schema(spark, self.path) if self.widen else None
        return read_if_present(spark, TableSource(self.path, self.format, self.options, schema))

    def exists(self, spark: SparkSession) -> bool:
        return self.read(spark) is not None

    def keys(self, spark: SparkSession, key: str) -> DataFrame | None:
        """The key column alone."""
        held = self.read(spark)
        return None if held is None else held.select(ref(key))

    def count(self, spark: SparkSession, held: DataFrame | None = None) -> int:
        """Rows held, 0 if the table does not exist.

        A database counts by itself; of files only footers are read. ``held`` is
        the table if it was just read.
        """
        if held is None:
            held = self.read(spark)
        if held is None:
            return 0
        name = self.options.get("dbtable")
        if name and not self.path:
            return int(self._ask(spark, f"SELECT COUNT(*) AS total FROM {name}").first()[0])
        return held.count()

    def making(self, held: DataFrame, key: str) -> KeyMaking | None:
        """How the table says its keys were made; connectors that keep no notes say nothing.

        Files have a note on the column. A catalog table's columns keep their first notes,
        so it has one of its own.
        """
        if key not in held.columns:
            return None
        if self.table:
            notes = held.sparkSession.sql(f"SHOW TBLPROPERTIES {self.table}")
            note = notes.filter(F.col("key") == RECORD).first()
            return KeyMaking.named(note["value"]) if note else None
        return making_of(held, key)

    def _note(self, df: DataFrame, key: str | None) -> None:
        if self.table and key and RECORD in df.schema[key].metadata:
            note = df.schema[key].metadata[RECORD]
            df.sparkSession.sql(f"ALTER TABLE {self.table} SET TBLPROPERTIES ('{RECORD}' = '{note}')")

    def _ask(self, spark: SparkSession, sql: str) -> DataFrame:
        """Result of a query the connector passes on."""
        options = {k: v for k, v in self.options.items() if k.lower() not in _SCAN_OPTIONS}
        return spark.read.format(self.format).options(**options).option("query", sql).load()

    def widened(
        self, held: DataFrame, batch: DataFrame, *, keyed: bool
    ) -> tuple[DataFrame, DataFrame]:
        """The table as wide as it must be to take the batch, and the batch as wide (K3)."""
        spark = held.sparkSession
        schema = wider_schema(held.schema, batch.schema, keyed=keyed)
        shape = [(f.name, f.dataType) for f in schema.fields]
        if shape != [(f.name, f.dataType) for f in held.schema.fields]:
            if self.table:
                self._add_columns(held, schema)
            else:
                note_schema(spark, self.path, schema)
            held = self.read(spark)
        return held, widened_to(batch, schema)

    def _add_columns(self, held: DataFrame, schema: T.StructType) -> None:
        kinds = {f.name: f.dataType for f in held.schema.fields}
        faults = [
            Violation(f.name, "type", kinds[f.name].simpleString(), f.dataType.simpleString())
            for f in schema.fields
            if f.name in kinds and kinds[f.name] != f.dataType
        ]
        if faults:
            raise ContractViolation(faults)
        added = ", ".join(
            f"{quoted(f.name)} {f.dataType.simpleString()}" for f in schema.fields if f.name not in kinds
        )
        held.sparkSession.sql(f"ALTER TABLE {self.table} ADD COLUMNS ({added})")

    def overwrite(self, df: DataFrame, key: str | None = None) -> int:
        """Replace the table (K1, K4); rows written."""
        if self.publish == "switch":
            return self._switch(df, key)
        return self._write(df, "overwrite", key, self.on_overwrite)

    def append(self, df: DataFrame, key: str | None = None) -> int:
        """Add rows (K2, K4, K6); rows written."""
        return self._write(df, "append", key, self.on_append)

    def truncate(self, spark: SparkSession, schema: T.StructType, key: str | None = None) -> None:
        """Drop all rows, keep the table (K5)."""
        self._write(empty_frame(spark, schema), "overwrite", key, self.on_truncate)

    def _write(self, df: DataFrame, mode: str, key: str | None, more: Mapping[str, str]) -> int:
        writer, seen = self._writer(df, mode, key, more)
        if self.table:
            writer.saveAsTable(self.table)
        elif self.path:
            writer.save(self.path)
        else:
            writer.save()
        self._note(df, key)
        return seen.get["rows"]

    def _writer(self, df: DataFrame, mode: str, key: str | None, more: Mapping[str, str]):
        if self.buckets:
            df = df.repartition(self.buckets, ref(key))
        # Counted in the tasks that write, as rows of a task that is run again
        # count once only there.
        seen = Observation()
        df = df.observe(seen, F.count(F.lit(1)).alias("rows"))
        writer = df.write.format(self.format).options(**{**self.options, **more}).mode(mode)
        if self.buckets:
            writer = writer.bucketBy(self.buckets, key).sortBy(key)
        return writer, seen

    def _switch(self, df: DataFrame, key: str | None) -> int:
        spark = df.sparkSession
        if self.table and not spark.catalog.tableExists(self.table):
            return self._write(df, "overwrite", key, self.on_overwrite)
        if self.table:
            df = ordered_as(df, spark.read.table(self.table))
        writer, seen = self._writer(df, "errorifexists", key, self.on_overwrite)
        if self.path:
            replace_folder(spark, self.path, writer.save)
        else:
            replace_table(
                spark,
                self.table,
                df,
                lambda name, place: writer.option("path", place).saveAsTable(name),
            )
            self._note(df, key)
        return seen.get["rows"]
