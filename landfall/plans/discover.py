"""Specs for every table a database lists: S3, S6 and the naming rules."""

from __future__ import annotations

from collections.abc import Callable, Collection, Mapping

from pyspark.sql import SparkSession

from ..functions.names import QualifiedName, key_name
from ..sinks.targets import Target
from ..sources.jdbc import Database, JdbcTable, Split
from .spec import TableSpec


def discover(
    spark: SparkSession,
    database: Database,
    schema: str,
    system: str,
    *,
    landing: Callable[[str], Target] | None = None,
    warehouse: Callable[[str], Target | None] | None = None,
    any_case: bool = False,
    typed: bool = False,
    exclude: Collection[str] = (),
    keys: Mapping[str, str] | None = None,
    splits: Mapping[str, Split] | None = None,
    **options,
) -> list[TableSpec]:
    """One spec per table of the schema, in name order.

    ``landing`` and ``warehouse`` say where a table of that name goes. Keys are
    named by rule unless ``keys`` names them; then a table it leaves out has no
    key. ``typed`` asks the catalog for each table's columns and replaces types
    Spark cannot read. ``options`` go to every spec.
    """
    listed = database.tables(spark, schema, any_case=any_case).collect()
    specs = []
    for name in sorted(row.table_name for row in listed if row.table_name not in exclude):
        source = JdbcTable(database, QualifiedName(schema, name), (splits or {}).get(name, Split()))
        specs.append(
            TableSpec(
                name=name,
                source=source.typed(spark) if typed else source,
                system=system,
                key=key_name(system, name) if keys is None else keys.get(name),
                landing=landing(name) if landing else None,
                warehouse=warehouse(name) if warehouse else None,
                **options,
            )
        )
    return specs
