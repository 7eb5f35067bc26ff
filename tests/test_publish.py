"""Replacing a table by a switch, and runs that die on the way."""

from datetime import UTC, datetime

import pytest
from pyspark.sql import functions as F

from landfall.plans.load import load_table
from landfall.plans.spec import TableSpec
from landfall.sinks import publish
from landfall.sinks.targets import Target
from landfall.sources.tables import FrameSource

NOW = datetime(2024, 1, 15, 12, tzinfo=UTC)


class Died(Exception):
    pass


def spec(frame, **options):
    return TableSpec(**{"name": "t", "source": FrameSource(frame), "system": "S", "key": "K"} | options)


def load(spark, target, first, end, mode="historical"):
    return load_table(spark, spec(spark.range(first, end), landing=target, mode=mode), NOW)


def ids(spark, target):
    return sorted(r.id for r in target.read(spark).collect())


def leftovers(folder):
    return sorted(p.name for p in folder.iterdir() if p.name.startswith("."))


@pytest.mark.parametrize("mode", ["historical", "truncate_append"])
def test_folder(spark, tmp_path, monkeypatch, mode):
    target = Target(str(tmp_path / "t"), publish="switch")
    load(spark, target, 0, 3)

    def die(*_):
        raise Died

    with monkeypatch.context() as patch:
        patch.setattr(publish, "switch_folder", die)
        with pytest.raises(Died):
            load(spark, target, 5, 9, mode)
    assert ids(spark, target) == [0, 1, 2]
    assert len(leftovers(tmp_path)) == 1
    load(spark, target, 5, 9, mode)
    assert ids(spark, target) == [5, 6, 7, 8]
    assert leftovers(tmp_path) == []


@pytest.mark.parametrize("whole", [True, False])
def test_death_between_the_renames(spark, tmp_path, monkeypatch, whole):
    target = Target(str(tmp_path / "t"), publish="switch")
    load(spark, target, 0, 3)
    rename, calls = publish._rename, []

    def once(spark, source, to):
        if calls:
            raise Died
        calls.append(source)
        rename(spark, source, to)

    with monkeypatch.context() as patch:
        patch.setattr(publish, "_rename", once)
        with pytest.raises(Died):
            load(spark, target, 5, 9)
    assert not (tmp_path / "t").exists()
    if not whole:
        next(p for p in tmp_path.glob(".t.new-*")).joinpath("_SUCCESS").unlink()
    assert ids(spark, target) == ([5, 6, 7, 8] if whole else [0, 1, 2])
    load(spark, target, 1, 2)
    assert ids(spark, target) == [1] and leftovers(tmp_path) == []


def test_write_that_fails_leaves_the_table(spark, tmp_path):
    target = Target(str(tmp_path / "t"), publish="switch")
    load(spark, target, 0, 3)
    bad = spark.range(5).withColumn("id", F.when(F.col("id") == 4, F.raise_error(F.lit("no"))).otherwise(F.col("id")))
    with pytest.raises(Exception, match="no"):
        target.overwrite(bad)
    assert ids(spark, target) == [0, 1, 2]


@pytest.mark.parametrize("buckets", [None, 4])
def test_catalog_table(spark, monkeypatch, buckets):
    target = Target(table=f"switched_{buckets}", publish="switch", buckets=buckets)
    frame = spark.range(3).select(F.col("id").cast("string").alias("K"), "id")
    target.overwrite(frame, "K")

    def die(*_):
        raise Died

    with monkeypatch.context() as patch:
        patch.setattr(publish, "switch_table", die)
        with pytest.raises(Died):
            target.overwrite(frame.withColumn("id", F.col("id") + 10), "K")
    assert ids(spark, target) == [0, 1, 2]
    for more in (10, 20):
        assert target.overwrite(frame.select((F.col("id") + more).alias("id"), "K"), "K") == 3
        assert ids(spark, target) == [more, more + 1, more + 2]
    assert target.append(frame, "K") == 3 and len(ids(spark, target)) == 6
    with pytest.raises(ValueError, match="keeps the table's columns"):
        target.overwrite(frame.withColumn("more", F.lit(1)), "K")
    assert [t.name for t in spark.catalog.listTables() if "__at_" in t.name] == []


def test_only_what_can_be_switched(tmp_path):
    for wrong in ({"format": "jdbc"}, {}):
        with pytest.raises(ValueError, match="switched"):
            Target(publish="switch", **wrong)
    with pytest.raises(ValueError, match="publish"):
        Target(str(tmp_path), publish="soon")
