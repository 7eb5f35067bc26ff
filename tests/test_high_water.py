import os
from collections import Counter
from datetime import UTC, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from databases import embedded, put
from landfall.plans.run import load_all
from landfall.plans.spec import TableSpec
from landfall.sinks.targets import Target
from landfall.sources.high_water import HighWater, LaterRows
from landfall.sources.jdbc import JdbcTable
from landfall.sources.tables import FrameSource, TableSource

FIRST = datetime(2024, 1, 10, 12, tzinfo=UTC)
SECOND = FIRST + timedelta(days=1)


def rows(spark, *records):
    return spark.createDataFrame(records, "id int, seen string").select(
        "id", F.col("seen").cast("timestamp").alias("seen")
    )


def spec(source, target, **options):
    water = HighWater("seen", timedelta(hours=2))
    return TableSpec(
        **{"name": "t", "source": source, "system": "S", "key": "K", "landing": target, "high_water": water} | options
    )


def ids(spark, target):
    return Counter(r.id for r in target.read(spark).collect())


def test_second_run_reads_later_rows_only(spark, tmp_path):
    target, log = Target(str(tmp_path / "t")), Target(str(tmp_path / "log"))
    first = rows(spark, (1, "2024-01-09"), (2, "2024-01-10 11:30:00"), (3, None))
    load_all(spark, [spec(FrameSource(first), target)], FIRST, run_log=log)
    # 4 is too old to be looked at, 5 came late within the overlap, 6 is new, 3 and 2 are held.
    second = first.union(rows(spark, (4, "2024-01-09"), (5, "2024-01-10 10:00:00"), (6, "2024-01-11")))
    report = load_all(spark, [spec(FrameSource(second), target)], SECOND, run_log=log).first()
    assert (report.offered, report.landed) == (4, 2)
    assert ids(spark, target) == Counter([1, 2, 3, 5, 6])


def test_failed_and_empty_runs_leave_the_mark(spark, tmp_path):
    class Broken:
        repeatable = True

        def scan(self, spark):
            raise RuntimeError("away")

    target, log = Target(str(tmp_path / "t")), Target(str(tmp_path / "log"))
    load_all(spark, [spec(FrameSource(rows(spark, (1, "2024-01-09"))), target)], FIRST, run_log=log)
    for source, status in ((Broken(), "failed"), (FrameSource(rows(spark, (1, "2024-01-09"))), "skipped")):
        report = load_all(spark, [spec(source, target)], SECOND, run_log=log).first()
        assert report.status == status
    third = FrameSource(rows(spark, (2, "2024-01-10 13:00:00")))
    load_all(spark, [spec(third, target)], SECOND + timedelta(days=1), run_log=log)
    assert ids(spark, target) == Counter([1, 2])


def test_a_target_that_is_gone_is_filled_whole(spark, tmp_path):
    log, source = Target(str(tmp_path / "log")), FrameSource(rows(spark, (1, "2024-01-01")))
    load_all(spark, [spec(source, Target(str(tmp_path / "a")))], FIRST, run_log=log)
    fresh = Target(str(tmp_path / "b"))
    load_all(spark, [spec(source, fresh)], SECOND, run_log=log)
    assert ids(spark, fresh) == Counter([1])


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz", "date"])
def test_filter_reaches_the_files(spark, tmp_path, kind):
    path = str(tmp_path / kind)
    frame = rows(spark, (1, "2024-01-09"), (2, "2024-01-11")).withColumn("seen", F.col("seen").cast(kind))
    frame.write.parquet(path)
    later = HighWater("seen", timedelta(0)).later(TableSource(path), int(FIRST.timestamp() * 1e6))
    scan = later.scan(spark)
    plan = scan._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(seen," in plan and "cast(seen" not in plan
    assert [r.id for r in scan.collect()] == [2] and later.count(spark) == 1


def test_filter_reaches_the_database(spark, tmp_path):
    database = embedded()
    name = put(database, rows(spark, (1, "2024-01-09"), (2, "2024-01-11"), (3, None)), "later")
    scan = HighWater("seen").later(JdbcTable(database, name), int(FIRST.timestamp() * 1e6)).scan(spark)
    assert "GreaterThanOrEqual(seen," in scan._jdf.queryExecution().executedPlan().toString()
    assert sorted(r.id for r in scan.collect()) == [2, 3]


def test_later_files(spark, tmp_path):
    path, target, log = str(tmp_path / "s"), Target(str(tmp_path / "t")), Target(str(tmp_path / "log"))
    water = HighWater(overlap=timedelta(minutes=1))

    def add(n, when):
        rows(spark, (n, "2024-01-01")).coalesce(1).write.mode("append").parquet(path)
        for file in os.listdir(path):
            place = os.path.join(path, file)
            if os.path.getmtime(place) > SECOND.timestamp() + 3600:
                os.utime(place, (when.timestamp(), when.timestamp()))

    add(1, FIRST - timedelta(hours=1))
    load_all(spark, [spec(TableSource(path), target, high_water=water)], FIRST, run_log=log)
    add(2, FIRST - timedelta(hours=1))  # as old as what was read: not looked at
    add(3, FIRST - timedelta(seconds=60))  # within the overlap
    add(4, FIRST + timedelta(seconds=5))
    report = load_all(
        spark, [spec(TableSource(path), target, high_water=water)], SECOND, run_log=log
    ).first()
    assert report.offered == 2
    assert ids(spark, target) == Counter([1, 3, 4])
    # No later files at all is an empty source, not an error.
    later = water.later(TableSource(path), int((SECOND + timedelta(days=1)).timestamp() * 1e6))
    assert later.scan(spark).isEmpty()


def test_what_cannot_work_is_refused(spark, tmp_path):
    source, target = FrameSource(rows(spark, (1, None))), Target(str(tmp_path / "t"))
    with pytest.raises(ValueError, match="load by key"):
        spec(source, target, mode="append")
    with pytest.raises(ValueError, match="only files"):
        LaterRows(source, HighWater(), 0)
    with pytest.raises(TypeError, match="no time"):
        HighWater("id").later(source, 0).scan(spark)
    with pytest.raises(ValueError, match="negative"):
        HighWater("seen", timedelta(hours=-1))
