import os
from collections import Counter
from datetime import UTC, datetime, timedelta
from threading import Barrier

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from landfall.contracts import Contract
from landfall.operators.changes import new_rows
from landfall.operators.conform import ContractViolation, validate
from landfall.plans.load import CountMismatch, load_table
from landfall.plans.run import last_success, load_all, totals
from landfall.plans.spec import TableSpec, missing_tables, select_specs
from landfall.sinks.targets import Target
from landfall.sources.shared import SETTING, new_folder, shared_folder, staged
from landfall.sources.tables import (
    FrameSource,
    TableSource,
    empty_frame,
    landing_path,
    read_if_present,
)

NOW = datetime(2024, 1, 15, 12, tzinfo=UTC)
SHAPE = "id int, note string"


def frame(spark, *records):
    return spark.createDataFrame(records, SHAPE)


def spec(source, **options):
    if not isinstance(source, TableSource | FrameSource | Once):
        source = FrameSource(source)
    return TableSpec(**{"name": "t", "source": source, "system": "S", "key": "K"} | options)


def held(spark, target):
    return Counter((r.id, r.note) for r in target.read(spark).collect())


class Once:
    """A source that gives other rows when it is read again."""

    repeatable = False

    def __init__(self, frames):
        self.frames = iter(frames)

    def scan(self, spark):
        return next(self.frames)


@pytest.fixture
def target(tmp_path):
    return Target(str(tmp_path / "target"))


def test_incremental(spark, target):
    first = load_table(spark, spec(frame(spark, (1, "a"), (2, "b")), landing=target), NOW)
    assert (first.offered, first.landing_before, first.landed, first.landing_after) == (2, 0, 2, 2)
    more = spec(frame(spark, (2, "b"), (2, "changed"), (3, "c"), (3, "c")), landing=target)
    second = load_table(spark, more, NOW)
    assert (second.offered, second.landed, second.landing_after) == (4, 2, 4)
    assert held(spark, target) == Counter([(1, "a"), (2, "b"), (2, "changed"), (3, "c")])
    third = load_table(spark, more, NOW)
    assert (third.status, third.reason, third.landed) == ("success", "no new rows", 0)


def test_other_file_formats(spark, tmp_path):
    orc = Target(str(tmp_path / "orc"), format="orc")
    for records in ([(1, "a")], [(1, "a"), (2, "b")]):
        load_table(spark, spec(frame(spark, *records), landing=orc), NOW)
    assert held(spark, orc) == Counter([(1, "a"), (2, "b")])
    copied = Target(str(tmp_path / "copy"))
    load_table(spark, spec(TableSource(orc.path, format="orc"), landing=copied, mode="historical"))
    assert held(spark, copied) == held(spark, orc)


def test_batch_duplicates_stay_without_dedupe(spark, target):
    twice = spec(frame(spark, (1, "a"), (1, "a")), landing=target, dedupe=False)
    assert load_table(spark, twice).landed == 2
    assert load_table(spark, twice).landed == 0


def test_rows_that_share_a_compat_key_stay(spark, target):
    """(1, NULL) and (NULL, "1") have one compat key, but are two rows."""
    rows = spec(frame(spark, (1, None), (None, "1")), landing=target, key_encoding="compat")
    assert load_table(spark, rows).landed == 2
    assert load_table(spark, rows).landed == 0


def test_what_can_be_read_twice(spark):
    assert TableSource("some/path").repeatable
    assert not TableSource(format="jdbc", options={"dbtable": "T"}).repeatable
    assert TableSource(format="jdbc", repeatable=True).repeatable


def test_historical_replaces(spark, target):
    load_table(spark, spec(frame(spark, (1, "a"), (1, "a")), landing=target, mode="historical"))
    result = load_table(spark, spec(frame(spark, (2, "b")), landing=target, mode="historical"))
    assert (result.landing_before, result.landed, result.landing_after) == (0, 1, 1)
    assert held(spark, target) == Counter([(2, "b")])


def test_without_a_key_every_load_replaces(spark, target):
    for note in "ab":
        load_table(spark, spec(frame(spark, (1, note)), landing=target, key=None))
    assert held(spark, target) == Counter([(1, "b")])
    assert "K" not in target.read(spark).columns


@pytest.mark.parametrize("mode", ["append", "truncate_append", "incremental_insert"])
def test_modes_that_need_a_target(spark, target, mode):
    rows = spec(frame(spark, (1, "a")), warehouse=target, mode=mode)
    result = load_table(spark, rows)
    assert (result.status, result.reason) == ("skipped", "target does not exist")
    assert not target.exists(spark)


@pytest.mark.parametrize(
    "mode, expected",
    [("append", [1, 1, 2]), ("truncate_append", [1, 2]), ("incremental_insert", [1, 2])],
)
def test_modes_on_a_target(spark, target, mode, expected):
    load_table(spark, spec(frame(spark, (1, "x")), warehouse=target, mode="historical"))
    load_table(spark, spec(frame(spark, (1, "x"), (2, "x")), warehouse=target, mode=mode))
    assert sorted(i for i, _ in held(spark, target).elements()) == expected


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.lists(st.integers(0, 9), max_size=8), min_size=1, max_size=3))
def test_target_is_the_union_of_what_was_loaded(spark, tmp_path_factory, batches):
    target = Target(str(tmp_path_factory.mktemp("union") / "t"))
    for batch in batches:
        for _again in range(2):
            rows = empty_frame(spark, frame(spark, (0, "")).schema).union(
                spark.createDataFrame([(i, "n") for i in batch], SHAPE)
            )
            load_table(spark, spec(rows, landing=target), NOW)
    expected = Counter({(i, "n"): 1 for batch in batches for i in batch})
    assert (held(spark, target) if target.exists(spark) else Counter()) == expected


def test_empty_source_is_skipped(spark, target):
    result = load_table(spark, spec(frame(spark, (1, "a")).limit(0), landing=target))
    assert (result.status, result.reason) == ("skipped", "empty")
    assert not target.exists(spark)


def test_source_is_read_once(spark, target, tmp_path):
    """Both targets get the first state of a source that changes."""
    source = Once([frame(spark, (1, "a"))])
    warehouse = Target(str(tmp_path / "warehouse"))
    load_table(spark, spec(source, landing=target, warehouse=warehouse))
    assert held(spark, target) == held(spark, warehouse) == Counter([(1, "a")])


def test_warehouse_makes_up_for_a_lost_load(spark, target, tmp_path):
    warehouse = Target(str(tmp_path / "warehouse"))
    load_table(spark, spec(frame(spark, (1, "a")), landing=target))
    both = spec(frame(spark, (2, "b")), landing=target, warehouse=warehouse)
    result = load_table(spark, both)
    assert (result.landed, result.loaded, result.warehouse_after) == (1, 2, 2)
    # In step again: the next batch alone is looked at.
    result = load_table(spark, spec(frame(spark, (3, "c")), landing=target, warehouse=warehouse))
    assert (result.landed, result.loaded, result.warehouse_after) == (1, 1, 3)


def test_count_mismatch_is_an_error(spark, target, monkeypatch):
    monkeypatch.setattr(Target, "count", lambda self, spark, held=None: 7)
    with pytest.raises(CountMismatch, match="offered 1, wrote 1, holds 7"):
        load_table(spark, spec(frame(spark, (1, "a")), landing=target, mode="historical"))


def test_broken_off_append_is_made_good(spark, target, monkeypatch):
    load_table(spark, spec(frame(spark, (1, "a")), landing=target), NOW)
    rows = spec(frame(spark, (1, "a"), (2, "b")), landing=target)
    write = Target.append

    def lost_answer(self, df, key=None):
        write(self, df, key)
        raise ConnectionError("no answer")

    monkeypatch.setattr(Target, "append", lost_answer)
    with pytest.raises(ConnectionError):
        load_table(spark, rows, NOW)
    monkeypatch.undo()
    assert load_table(spark, rows, NOW).landed == 0
    assert held(spark, target) == Counter([(1, "a"), (2, "b")])


def test_errors_reading_a_target_are_not_taken_for_absence(spark, tmp_path):
    (tmp_path / "bad").mkdir()
    (tmp_path / "bad" / "part-0.parquet").write_text("not parquet")
    with pytest.raises(Exception, match="(?i)parquet|footer"):
        load_table(spark, spec(frame(spark, (1, "a")), landing=Target(str(tmp_path / "bad"))))


def test_target_without_the_key_is_an_error(spark, target):
    target.overwrite(frame(spark, (1, "a")))
    with pytest.raises(Exception, match="K"):
        load_table(spark, spec(frame(spark, (1, "a")), landing=target))


def test_large_sides_go_by_tally(spark, target, monkeypatch):
    small = {**new_rows.__kwdefaults__, "broadcast_bytes": 1}
    monkeypatch.setattr(new_rows, "__kwdefaults__", small)
    load_table(spark, spec(frame(spark, (1, "a"), (1, "a"), (2, "b")), landing=target), NOW)
    result = load_table(
        spark, spec(frame(spark, (2, "b"), (3, "c"), (3, "c"), (4, "d")), landing=target), NOW
    )
    assert result.landed == 2
    assert held(spark, target) == Counter([(1, "a"), (2, "b"), (3, "c"), (4, "d")])


def test_small_appends_make_few_files(spark, target):
    many = spark.range(2000, numPartitions=8).selectExpr("CAST(id AS int) AS id", "'n' AS note")
    load_table(spark, spec(many, landing=target))
    before = len([f for f in os.listdir(target.path) if f.endswith(".parquet")])
    load_table(spark, spec(many.limit(1999).union(frame(spark, (5000, "n"))), landing=target))
    after = len([f for f in os.listdir(target.path) if f.endswith(".parquet")])
    assert after == before + 1


def test_catalog_table(spark):
    target = Target(table="landed_orders")
    assert not target.exists(spark)
    for records in ([(1, "a")], [(1, "a"), (2, "b")]):
        load_table(spark, spec(frame(spark, *records), landing=target))
    assert held(spark, target) == Counter([(1, "a"), (2, "b")])
    assert target.keys(spark, "K").columns == ["K"]


def test_bucketed_table(spark, monkeypatch):
    """Large sides, so that the keys are looked up in the buckets."""
    small = {**new_rows.__kwdefaults__, "broadcast_bytes": 1}
    monkeypatch.setattr(new_rows, "__kwdefaults__", small)
    target = Target(table="bucketed_orders", buckets=4)
    rows = spark.range(100).selectExpr("CAST(id AS int) AS id", "'n' AS note")
    load_table(spark, spec(rows.limit(50), landing=target))
    result = load_table(spark, spec(rows.union(rows), landing=target))
    assert (result.landed, result.landing_after) == (50, 100)
    assert load_table(spark, spec(rows, landing=target)).landed == 0


def test_bucketed_keys_are_not_shuffled(spark, monkeypatch):
    spark.range(1000).selectExpr("CAST(id AS string) AS K").write.bucketBy(4, "K").saveAsTable("held")
    plans = []

    def checkpoint(self, *_):
        plans.append(self._jdf.queryExecution().executedPlan().toString())
        return self

    monkeypatch.setattr(type(spark.range(1)), "checkpoint", checkpoint)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        batch = spark.range(900, 1100).selectExpr("CAST(id AS string) AS K", "id AS v")
        fresh = new_rows(
            batch, spark.read.table("held"), "K", existing_buckets=4, broadcast_bytes=1
        )
        assert fresh.count() == 100
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    held_side = plans[0][plans[0].index("FileScan") - 400 :]
    assert "Bucketed: true" in held_side
    # Two shuffles, both of the batch: to count its keys and to send them.
    assert plans[0].count("Exchange hashpartitioning") == 2


def test_schema_may_grow(spark, tmp_path):
    target = Target(str(tmp_path / "t"), options={"mergeSchema": "true"})
    load_table(spark, spec(frame(spark, (1, "a")), landing=target))
    wider = spark.createDataFrame([(2, "b", "new")], SHAPE + ", more string")
    load_table(spark, spec(wider, landing=target))
    found = {(r.id, r.more) for r in target.read(spark).collect()}
    assert found == {(1, None), (2, "new")}


def test_types_must_not_change(spark, target):
    load_table(spark, spec(frame(spark, (1, "a")), landing=target))
    other = spark.createDataFrame([("2", "b")], "id string, note string")
    for mode in ("incremental", "append"):
        with pytest.raises(ContractViolation, match="id: type, expected int, found string"):
            load_table(spark, spec(other, landing=target, mode=mode))
    load_table(spark, spec(other, landing=target, mode="historical"))
    assert held(spark, target) == Counter([("2", "b")])


def test_contract_load(spark, target):
    shape = Contract(
        name="t", columns="ID decimal(38,0), SEEN timestamp", key="K", future={"SEEN": "clamp"}
    )
    rows = spark.createDataFrame(
        [("1", "1/2/2024"), ("x", "2025-05-05 00:00:00")], "id string, seen string"
    )
    for later in range(3):
        loaded = spec(rows, contract=shape, key=None, landing=target)
        load_table(spark, loaded, NOW + timedelta(days=later))
    assert target.read(spark).count() == 2
    validate(target.read(spark), shape.schema)


class Broken:
    repeatable = True

    def scan(self, spark):
        raise ContractViolation([])


def report_rows(report):
    return {r.table: r for r in report.collect()}


@pytest.mark.parametrize("workers", [1, 4])
def test_one_failure_does_not_stop_the_others(spark, tmp_path, workers):
    def to(name):
        return Target(str(tmp_path / name))

    specs = [
        spec(frame(spark, (1, "a")), name="good", landing=to("good")),
        TableSpec("bad", Broken(), "S", landing=to("bad")),
        spec(frame(spark, (1, "a")).limit(0), name="none", landing=to("none")),
        spec(frame(spark, (1, "a")), name="fine", landing=to("fine")),
    ]
    log = to("log")
    report = load_all(
        spark,
        specs,
        NOW,
        workers=workers,
        left_out={"off": "switched off"},
        expected=["good", "off", "lost"],
        run_log=log,
    )
    found = report_rows(report)
    assert {n: r.status for n, r in found.items()} == {
        "good": "success", "bad": "failed", "none": "skipped", "fine": "success",
        "off": "skipped", "lost": "missing",
    }
    assert found["bad"].reason.startswith("ContractViolation")
    counts = {r.status: r.tables for r in totals(report).collect()}
    assert counts == {"success": 2, "failed": 1, "skipped": 2, "missing": 1}
    load_all(spark, specs[:1], NOW + timedelta(days=1), run_log=log)
    last = {r.table: r.as_of for r in last_success(spark, log).collect()}
    assert last == {"good": datetime(2024, 1, 16, 12), "fine": datetime(2024, 1, 15, 12)}


def test_fail_fast(spark, target):
    specs = [TableSpec("bad", Broken(), "S", landing=target)]
    for workers in (1, 2):
        with pytest.raises(ContractViolation):
            load_all(spark, specs, workers=workers, policy="fail_fast")
    with pytest.raises(ValueError, match="failure policy"):
        load_all(spark, specs, policy="hope")


@pytest.mark.parametrize("mode, status", [("incremental", "success"), ("append", "failed")])
def test_a_table_is_tried_again(spark, target, monkeypatch, mode, status):
    load_table(spark, spec(frame(spark, (1, "a")), landing=target), NOW)
    write, calls = Target.append, []

    def flaky(self, df, key=None):
        calls.append(1)
        rows = write(self, df, key)
        if len(calls) == 1:
            raise ConnectionError("no answer")
        return rows

    monkeypatch.setattr(Target, "append", flaky)
    rows = spec(frame(spark, (1, "a"), (2, "b")), landing=target, mode=mode)
    report = load_all(spark, [rows], NOW, attempts=3)
    assert report.first().status == status
    assert len(calls) == (2 if status == "success" else 1)
    if status == "success":
        assert held(spark, target) == Counter([(1, "a"), (2, "b")])


def test_source_count_is_held_against_the_rows_read(spark, target):
    class Counted(FrameSource):
        def count(self, spark):
            return 2

    good = spec(Counted(frame(spark, (1, "a"), (2, "b"))), landing=target, count_source=True)
    assert load_table(spark, good).source_rows == 2
    with pytest.raises(CountMismatch, match="counted 2, read 1"):
        load_table(
            spark, spec(Counted(frame(spark, (1, "a"))), landing=target, count_source=True)
        )
    with pytest.raises(ValueError, match="cannot count"):
        spec(frame(spark, (1, "a")), landing=target, count_source=True)


def test_tables_load_side_by_side(spark, tmp_path):
    barrier = Barrier(3, timeout=60)

    class Meeting(FrameSource):
        def scan(self, spark):
            barrier.wait()
            return super().scan(spark)

    specs = [
        TableSpec(f"t{i}", Meeting(frame(spark, (i, "a"))), "S", landing=Target(str(tmp_path / str(i))))
        for i in range(3)
    ]
    report = load_all(spark, specs, workers=3)
    assert [r.status for r in report.collect()] == ["success"] * 3


def test_no_run_log_yet(spark, target):
    assert last_success(spark, target) is None


def test_select_specs(spark):
    specs = [spec(frame(spark, (1, "a")), name=n, landing=Target("x")) for n in "abcd"]
    chosen, left_out = select_specs(
        specs, exclude={"a"}, allow={"a", "b", "c"}, enabled={"a": True, "b": True}
    )
    assert [s.name for s in chosen] == ["b"]
    assert left_out == {"a": "excluded", "c": "switched off", "d": "not on the list"}


def test_missing_tables(spark):
    listed = spark.createDataFrame([("a",), ("b",)], "table_name string")
    assert [r.table_name for r in missing_tables(spark, ["b", "c"], listed).collect()] == ["c"]


@pytest.mark.parametrize(
    "options, message",
    [
        ({"mode": "weekly", "landing": Target("x")}, "unknown load mode"),
        ({}, "no target"),
        ({"mode": "incremental_insert", "key": None, "landing": Target("x")}, "needs a key"),
        ({"dedupe": False, "landing": Target(table="x", buckets=2)}, "buckets need"),
        ({"mode": "historical", "landing": Target(table="x", buckets=2)}, "buckets need"),
    ],
)
def test_specs_are_checked(spark, options, message):
    with pytest.raises(ValueError, match=message):
        spec(frame(spark, (1, "a")), **options)


def test_targets_are_checked():
    with pytest.raises(ValueError):
        Target(path="x", table="y")
    with pytest.raises(ValueError):
        Target(path="x", buckets=2)


def test_read_if_present(spark, tmp_path):
    assert read_if_present(spark, TableSource(str(tmp_path / "no"))) is None
    (tmp_path / "empty").mkdir()
    assert read_if_present(spark, TableSource(str(tmp_path / "empty"))) is None
    shaped = TableSource(str(tmp_path / "empty"), schema=SHAPE)
    assert read_if_present(spark, shaped).count() == 0
    with pytest.raises(Exception, match="DATA_SOURCE_NOT_FOUND"):
        read_if_present(spark, TableSource(str(tmp_path), format="no.such.format"))


def test_landing_path():
    assert landing_path("base/", "RAW", "db", "t") == "base/RAW/db/t"


def test_staged_copy_goes_away(spark):
    with staged(frame(spark, (1, "a"))) as copy:
        files = copy.inputFiles()
        assert copy.collect() == [(1, "a")]
    assert files and not any(os.path.exists(f.removeprefix("file://")) for f in files)


def test_shared_folder_is_the_one_the_session_names(spark):
    assert shared_folder(spark) == spark.conf.get(SETTING)
    one, two = new_folder(spark, "x"), new_folder(spark, "x")
    assert one != two and one.startswith(spark.conf.get(SETTING))


def test_keys_read_one_column(spark, target):
    target.overwrite(frame(spark, (1, "a")).withColumn("K", F.lit("k")))
    text = target.keys(spark, "K")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<K:string>" in text
