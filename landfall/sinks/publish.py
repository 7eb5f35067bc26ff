"""Replacing a table by one switch: rows are written beside it, then take its place (K1, K5).

Until the switch readers see the old rows, after it the new ones. A run that dies before
it leaves the old table as it was, and a folder beside it that the next replacement
removes. One writer a table at a time is taken for granted, as everywhere in loads.

* A catalog table gets another location: one change in the catalog, on any store.
* A folder is renamed away and the new one renamed into its place. A run that dies
  between the two renames leaves no table for a moment; whoever reads it through a
  target next finishes the switch first. The file system's renames must be whole, as
  HDFS's and local ones are; on object stores use catalog tables.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..functions.names import ref
from ..sources.shared import _hadoop

SUCCESS = "_SUCCESS"


class SwitchFailed(RuntimeError):
    """The new rows are written but could not take the table's place."""


def _siblings(spark: SparkSession, path: str, kind: str) -> dict[str, str]:
    """Folders beside the table that a replacement has made: its id -> path."""
    files, place = _hadoop(spark, path)
    prefix = f".{place.getName()}.{kind}-"
    if place.getParent() is None or not files.exists(place.getParent()):
        return {}
    found = [s.getPath() for s in files.listStatus(place.getParent())]
    return {
        p.getName().removeprefix(prefix): p.toString()
        for p in found
        if p.getName().startswith(prefix)
    }


def _beside(spark: SparkSession, path: str, kind: str, run: str) -> str:
    _, place = _hadoop(spark, path)
    return f"{place.getParent().toString().rstrip('/')}/.{place.getName()}.{kind}-{run}"


def _rename(spark: SparkSession, source: str, to: str) -> None:
    files, place = _hadoop(spark, source)
    if not files.rename(place, _hadoop(spark, to)[1]):
        raise SwitchFailed(f"cannot rename {source} to {to}")


def _delete(spark: SparkSession, path: str) -> None:
    files, place = _hadoop(spark, path)
    files.delete(place, True)


def recover(spark: SparkSession, path: str) -> None:
    """Finish or undo a switch of a folder that broke off between its two renames."""
    files, place = _hadoop(spark, path)
    if files.exists(place):
        return
    new = _siblings(spark, path, "new")
    for run, old in _siblings(spark, path, "old").items():
        whole = run in new and files.exists(_hadoop(spark, f"{new[run]}/{SUCCESS}")[1])
        _rename(spark, new[run] if whole else old, path)
        return


def replace_folder(spark: SparkSession, path: str, write: Callable[[str], None]) -> None:
    """``write`` makes the new folder, which then takes the place of ``path``."""
    recover(spark, path)
    for kind in ("new", "old"):
        for left in _siblings(spark, path, kind).values():
            _delete(spark, left)
    run = uuid.uuid4().hex
    new, old = (_beside(spark, path, kind, run) for kind in ("new", "old"))
    write(new)
    switch_folder(spark, path, new, old)
    _delete(spark, old)


def switch_folder(spark: SparkSession, path: str, new: str, old: str) -> None:
    files, place = _hadoop(spark, path)
    if files.exists(place):
        _rename(spark, path, old)
    _rename(spark, new, path)


def location(spark: SparkSession, table: str) -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").filter("col_name = 'Location'")
    return rows.first().data_type


def replace_table(
    spark: SparkSession, table: str, df: DataFrame, write: Callable[[str, str], None]
) -> None:
    """``write`` makes a table of another name at a location; the table then moves there.

    The table keeps its columns; a frame of others is refused before anything is written.
    """
    held = spark.read.table(table)
    shape = lambda f: [(c.name, c.dataType.simpleString()) for c in f.schema.fields]
    if shape(held) != shape(df):
        raise ValueError(f"{table}: a switch keeps the table's columns {shape(held)}, got {shape(df)}")
    run = uuid.uuid4().hex
    old = location(spark, table)
    new = f"{old.rstrip('/').partition('__at_')[0]}__at_{run}"
    beside = f"{table}__at_{run}"
    try:
        write(beside, new)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {beside}")  # at a location of its own: its files stay
    switch_table(spark, table, new)
    _delete(spark, old)


def switch_table(spark: SparkSession, table: str, new: str) -> None:
    spark.sql(f"ALTER TABLE {table} SET LOCATION '{new}'")
    spark.catalog.refreshTable(table)


def ordered_as(df: DataFrame, held: DataFrame) -> DataFrame:
    """The frame's columns in the order of the table's, if they are the same ones."""
    same = sorted(df.columns) == sorted(held.columns)
    return df.select(*map(ref, held.columns)) if same else df
