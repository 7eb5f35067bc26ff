"""Counted losses of cleaning, and content held against what was written."""

from datetime import UTC, datetime

import pytest
from pyspark.sql import functions as F

from landfall.contracts import Contract
from landfall.plans import load
from landfall.plans.load import ContentMismatch, load_table
from landfall.plans.run import load_all
from landfall.plans.spec import TableSpec
from landfall.sinks.targets import Target
from landfall.sources.tables import FrameSource

NOW = datetime(2024, 1, 15, 12, tzinfo=UTC)
CONTRACT = Contract(
    "t", "ID string, PRICE decimal(10,2), SEEN timestamp, PAID boolean, NOTE string", key="K", json=["NOTE"]
)
RAW = [
    ("1", "1,5", "2023-01-01 00:00:00", "yes", "{}"),
    ("2", "abc", "1700-01-01 00:00:00", "maybe", "{bad"),
    ("3", None, None, None, None),
    (None, "x", "soon", "no", "[1]"),
]


def spec(spark, target, rows=RAW, repeatable=True, **options):
    frame = spark.createDataFrame(rows, "id string, price string, seen string, paid string, note string")
    base = {"contract": CONTRACT, "landing": target, "count_losses": True, "check_content": True}
    return TableSpec("t", FrameSource(frame, repeatable), "S", **base | options)


@pytest.mark.parametrize("repeatable", [True, False])
@pytest.mark.parametrize("mode", ["historical", "incremental"])
def test_losses_ride_on_the_load(spark, tmp_path, repeatable, mode):
    target = Target(str(tmp_path / "t"))
    for _ in range(2):
        result = load_table(spark, spec(spark, target, repeatable=repeatable, mode=mode), NOW)
        assert result.lost == {"PRICE": 2, "SEEN": 2, "PAID": 1, "NOTE": 1}
    assert target.count(spark) == 4
    assert load_table(spark, spec(spark, target, RAW[:1], mode=mode), NOW).lost == {}
    report = load_all(spark, [spec(spark, target, count_losses=False, mode=mode)], NOW)
    assert report.first().lost is None


def test_no_job_is_added(spark, tmp_path, monkeypatch):
    def jobs(name, **options):
        spark.sparkContext.setJobGroup(name, name)
        load_table(spark, spec(spark, Target(str(tmp_path / name)), mode="historical", **options), NOW)
        found = len(spark.sparkContext.statusTracker().getJobIdsForGroup(name))
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        return found

    assert jobs("a", check_content=False) == jobs("b", check_content=False, count_losses=False)


def test_skipped_loads_count_nothing(spark, tmp_path):
    target = Target(str(tmp_path / "t"))
    assert load_table(spark, spec(spark, target, RAW[:0]), NOW).lost is None
    assert load_table(spark, spec(spark, target, mode="incremental_insert"), NOW).status == "skipped"
    with pytest.raises(ValueError, match="without a contract"):
        spec(spark, target, contract=None)


@pytest.mark.parametrize("mode", ["historical", "incremental", "append", "truncate_append"])
def test_swapped_row_fails_the_table(spark, tmp_path, monkeypatch, mode):
    target = Target(str(tmp_path / "t"))
    load_table(spark, spec(spark, target, RAW[:2]), NOW)
    more = spec(spark, target, mode=mode)
    count = Target.count
    swapped = []

    def swap(self, spark, held=None):
        if held is None and not swapped:
            swapped.append(1)
            rows = [r.asDict() for r in self.read(spark).collect()]
            rows[0]["ID"] = "other"
            schema = self.read(spark).schema
            spark.createDataFrame([tuple(r.values()) for r in rows], schema).write.mode("overwrite").parquet(self.path)
        return count(self, spark, held)

    with monkeypatch.context() as patch:
        patch.setattr(Target, "count", swap)
        with pytest.raises(ContentMismatch):
            load_table(spark, more, NOW)
    assert swapped


def test_multiset_is_free_of_order_and_counts_copies(spark):
    rows = spark.range(50).withColumn("x", F.col("id") % 7)
    turned = rows.orderBy(F.desc("id")).select("x", "id")
    assert load.multiset(rows) == load.multiset(turned) != load.multiset(rows.union(rows.limit(1)))
    assert load.multiset(rows.limit(0)) == 0
