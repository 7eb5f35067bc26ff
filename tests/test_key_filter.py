"""Kept key filters against the exact join, and how little they read."""

from datetime import UTC, datetime
from functools import partial

import pytest
from pyspark.sql import functions as F

from landfall.operators import key_filter
from landfall.operators.changes import new_rows
from landfall.operators.key_filter import KeyFilter
from landfall.operators.snapshots import changed_rows
from landfall.plans import load
from landfall.plans.load import load_table, prepare
from landfall.plans.spec import TableSpec
from landfall.sinks.targets import Target
from landfall.sources.tables import FrameSource

NOW = datetime(2024, 1, 15, 12, tzinfo=UTC)


def keys(spark, first, end):
    return spark.range(first, end).select(F.sha2(F.col("id").cast("string"), 256).alias("K"))


def spec(frame, target, **options):
    return TableSpec("t", FrameSource(frame), "S", key="K", key_digest="sha2_256", landing=target, **options)


def test_small_batches_read_few_key_files(spark, tmp_path):
    held = KeyFilter(str(tmp_path / "f"))
    held.add(keys(spark, 0, 20_000), "K", 20_000)
    held.add(keys(spark, 20_000, 30_000).union(spark.sql("SELECT CAST(NULL AS STRING)")), "K", 10_001)
    assert held.rows(spark) == 30_001
    batch = keys(spark, 29_990, 30_040)
    maybe = held.maybe(batch, "K").select("key").distinct().count()
    assert 10 <= maybe <= 13
    files = held.lookup(held.maybe(batch, "K")).inputFiles()
    assert len(files) <= 13 and len(list(tmp_path.glob("f/keys/*/*/*.parquet"))) == 512
    expected = {r.K for r in keys(spark, 29_990, 30_000).collect()}
    assert {r.K for r in held.known(batch, "K").collect()} == expected
    fresh = keys(spark, 50_000, 50_050)
    assert len(held.lookup(held.maybe(fresh, "K").limit(0)).inputFiles()) == 0
    assert held.known(fresh, "K").collect() == []
    both = keys(spark, 19_990, 20_010)
    assert held.known(both, "K").count() == 20
    assert held.known(spark.sql("SELECT CAST(NULL AS STRING) AS K"), "K").collect() == []


def test_full_filters_and_many_files_stay_exact(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(key_filter, "MOST_FILES", 3)
    held = KeyFilter(str(tmp_path / "f"), digits=1)
    held.add(keys(spark, 0, 200_000), "K", 200_000)
    batch = keys(spark, 199_000, 201_000)
    assert held.maybe(batch, "K").count() > 1200
    assert held.known(batch, "K").count() == 1000
    held.add(keys(spark, 200_000, 200_500), "K", 500)
    held.compact(spark)
    assert held.rows(spark) == 200_500 and held.known(batch, "K").count() == 1500


def test_run_without_its_line_does_not_count(spark, tmp_path, monkeypatch):
    held = KeyFilter(str(tmp_path / "f"))
    held.add(keys(spark, 0, 10), "K", 10)

    def die(*_, **__):
        raise RuntimeError("died")

    with monkeypatch.context() as patch:
        patch.setattr(type(spark), "createDataFrame", die)
        with pytest.raises(RuntimeError):
            held.add(keys(spark, 10, 20), "K", 10)
    assert held.rows(spark) == 10
    assert held.known(keys(spark, 0, 20), "K").count() == 10


def test_loads(spark, tmp_path, monkeypatch):
    asked = []
    known = KeyFilter.known
    monkeypatch.setattr(KeyFilter, "known", lambda self, *a: asked.append(1) or known(self, *a))
    target = Target(str(tmp_path / "t"), key_filter=KeyFilter(str(tmp_path / "f")))
    rows = spark.range(100).withColumn("note", F.lit("x"))
    assert load_table(spark, spec(rows.limit(40), target), NOW).landed == 40
    assert target.key_filter.rows(spark) == 40 and asked == []
    assert load_table(spark, spec(rows, target), NOW).landed == 60
    assert load_table(spark, spec(rows, target), NOW).landed == 0
    assert target.key_filter.rows(spark) == 100 and len(asked) == 2
    # rows that came past the filter: it sees that it is out of step, and is made anew
    plain = Target(target.path)
    more = spark.range(200).withColumn("note", F.lit("x"))
    assert load_table(spark, spec(more, plain), NOW).landed == 100
    assert load_table(spark, spec(more.union(more), target), NOW).landed == 0
    assert len(asked) == 2 and target.key_filter.rows(spark) == 200
    last = spark.range(205).withColumn("note", F.lit("x"))
    assert load_table(spark, spec(last, target), NOW).landed == 5
    assert len(asked) == 3 and target.key_filter.rows(spark) == 205
    load_table(spark, spec(rows.limit(3), target, mode="historical"), NOW)
    assert target.key_filter.rows(spark) == 3
    assert load_table(spark, spec(rows, target), NOW).landed == 97


def test_filter_that_dies_after_the_rows(spark, tmp_path, monkeypatch):
    target = Target(str(tmp_path / "t"), key_filter=KeyFilter(str(tmp_path / "f")))
    load_table(spark, spec(spark.range(10), target), NOW)

    def die(*_):
        raise RuntimeError("died")

    with monkeypatch.context() as patch:
        patch.setattr(KeyFilter, "add", die)
        with pytest.raises(RuntimeError):
            load_table(spark, spec(spark.range(15), target), NOW)
    assert load_table(spark, spec(spark.range(15), target), NOW).landed == 0
    assert target.count(spark) == target.key_filter.rows(spark) == 15


def test_plain_keys_and_digits_are_told_apart(spark, tmp_path):
    held, rest = ["a", "6162", "AB", "\u00e9", "0" * 63], ["61", "ab", "c3a9", "6", None]
    kept, schema = KeyFilter(str(tmp_path / "f"), digits=1), "K string"
    kept.add(spark.createDataFrame([(k,) for k in held], schema), "K", len(held))
    batch = spark.createDataFrame([(k,) for k in held * 2 + rest], schema)
    assert sorted(r.K for r in kept.known(batch, "K").collect()) == sorted(held)


@pytest.mark.parametrize("limit, dedupe", [(1, True), (100_000, True), (100_000, False)])
def test_rows_of_many_held_keys_are_not_shuffled(spark, tmp_path, monkeypatch, limit, dedupe):
    monkeypatch.setattr(key_filter, "BROADCAST_BYTES", limit, raising=False)
    monkeypatch.setattr(load, "new_rows", partial(new_rows, broadcast_bytes=limit))
    plans, sifted, append = [], [], Target.append
    sift = KeyFilter.sift

    def appended(self, df, key=None):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return append(self, df, key)

    def watched(self, *args, **options):
        sifted.append(sift(self, *args, **options))
        return sifted[-1]

    monkeypatch.setattr(Target, "append", appended)
    monkeypatch.setattr(KeyFilter, "sift", watched)
    target = Target(str(tmp_path / "t"), key_filter=KeyFilter(str(tmp_path / "f"), digits=1))
    rows = spark.range(40_000).select("id", F.lit("x").alias("bits"), F.lit("y").alias("run"))
    load_table(spark, spec(rows.limit(20_000), target), NOW)
    maybe = target.key_filter.maybe(keyed(rows, target), "K").select("key").distinct().count()
    assert 20_000 < maybe < 21_000
    again = rows.union(rows.filter("id % 100 = 7"))
    result = load_table(spark, spec(again, target, dedupe=dedupe), NOW)
    held = target.read(spark)
    assert held.select("id").distinct().count() == 40_000
    assert result.landed == held.count() - 20_000 == (20_000 if dedupe else 20_200)
    if limit == 100_000:
        assert sifted[0][1] is None
        assert not any("SortMergeJoin" in p or "ShuffledHashJoin" in p for p in plans)
        # only rows of keys that come twice are shuffled
        exchanges = [x for p in plans for x in p.splitlines() if " Exchange hashpartitioning" in x]
        assert len(exchanges) <= 1
    else:
        assert sifted[0][1] is not None
    assert load_table(spark, spec(again, target, dedupe=dedupe), NOW).landed == 0


def keyed(rows, target):
    return prepare(rows.sparkSession, spec(rows, target), NOW)


@pytest.mark.parametrize("limit", [1 << 20, 1])
def test_snapshot_both_ways(spark, limit):
    frame = lambda *rows: spark.createDataFrame(rows, "K string, v int")
    snapshot = frame(("a", 1), ("a", 1), ("a", 1), ("b", 2), (None, 9), ("d", 4))
    held = frame(("a", 1), ("b", 2), ("b", 2), ("c", 3), (None, 9), (None, 9), ("d", 4))
    new, gone = changed_rows(snapshot, held, "K", broadcast_bytes=limit)
    assert sorted(map(tuple, new.collect())) == [("a", 1), ("a", 1)]
    assert sorted(map(tuple, gone.collect()), key=repr) == [("b", 2), ("c", 3), (None, 9)]
    assert all(side.count() == 0 for side in changed_rows(held, held, "K"))
