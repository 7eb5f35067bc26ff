"""How keys were made: versions, refusal, re-keying."""

from datetime import UTC, datetime

import pytest
from pyspark.sql import functions as F

from landfall.contracts import Contract
from landfall.functions.digest import KeyMaking
from landfall.operators.keys import KeyMismatch, add_key, making_of, recognised
from landfall.plans.load import load_table, rekey
from landfall.plans.spec import TableSpec
from landfall.sinks.targets import Target
from landfall.sources.tables import FrameSource

NOW = datetime(2024, 1, 15, 12, tzinfo=UTC)
SHAPE = "id int, note string"


def spec(frame, **options):
    base = {"name": "t", "source": FrameSource(frame), "system": "S", "key": "K", "key_digest": "sha2_256"}
    return TableSpec(**base | options)


def frame(spark, *records):
    return spark.createDataFrame(records, SHAPE)


def test_versions(spark):
    row = frame(spark, (1, None))
    made = lambda v: add_key(row.withColumn("a", F.array("id")), "K", digest="sha2_256", nested="json", version=v)
    sha = lambda text: spark.range(1).select(F.sha2(F.lit(text), 256)).first()[0]
    assert made(1).first().K == sha("3|[1]|1|1|-1")
    assert made(2).first().K == made(None).first().K == sha("1|a|5|1[1|1|2|id|1|1")
    for wrong in ({"version": 3}, {"encoding": "compat", "version": 2}, {"digest": "md5"}, {"encoding": "x"}):
        with pytest.raises(ValueError):
            KeyMaking(**wrong)
    making = KeyMaking("compat", "sha2_512", "json")
    assert KeyMaking.named(making.name) == making


@pytest.mark.parametrize("format_", ["parquet", "orc"])
@pytest.mark.parametrize("publish", ["direct", "switch"])
def test_other_making_is_refused_then_rekeyed(spark, tmp_path, format_, publish):
    target = Target(str(tmp_path / "t"), format=format_, publish=publish)
    old, new = frame(spark, (1, "a"), (2, None)), frame(spark, (1, "a"), (2, None), (3, "c"))
    load_table(spark, spec(old, landing=target, key_version=1), NOW)
    if format_ == "parquet":
        assert making_of(target.read(spark), "K") == KeyMaking(digest="sha2_256", version=1)
    for mode in ("incremental", "append"):
        with pytest.raises(KeyMismatch, match="re-key"):
            load_table(spark, spec(new, landing=target, mode=mode), NOW)
    assert target.count(spark) == 2
    assert rekey(spark, spec(new, landing=target), target, NOW) == 2
    assert rekey(spark, spec(new, landing=target), target, NOW) == 0
    assert load_table(spark, spec(new, landing=target), NOW).landed == 1
    expected = {r.K for r in add_key(new, "K", digest="sha2_256").collect()}
    assert {r.K for r in target.read(spark).collect()} == expected


def test_replacing_needs_no_rekeying(spark, tmp_path):
    target = Target(str(tmp_path / "t"))
    rows = frame(spark, (1, "a"))
    load_table(spark, spec(rows, landing=target, key_version=1), NOW)
    assert load_table(spark, spec(rows, landing=target, mode="truncate_append"), NOW).landed == 1
    assert load_table(spark, spec(rows, landing=target), NOW).landed == 0


def test_catalog_table(spark):
    target = Target(table="made_otherwise", publish="switch")
    load_table(spark, spec(frame(spark, (1, "a"), (2, None)), landing=target, key_version=1), NOW)
    new = spec(frame(spark, (1, "a"), (3, "c")), landing=target)
    with pytest.raises(KeyMismatch):
        load_table(spark, new, NOW)
    assert rekey(spark, new, target, NOW) == 2
    # a column's note stays what it was when the table was made; the table's own says otherwise
    assert load_table(spark, new, NOW).landed == 1


def test_settled_values_are_found_in_the_source(spark, tmp_path):
    contract = Contract("t", "ID string, SEEN timestamp", key="K", future={"SEEN": "clamp"}, key_digest="sha2_256")
    raw = spark.createDataFrame([("1", "2023-01-01 00:00:00"), ("2", "2024-09-09 00:00:00"), ("2", None)], "id string, seen string")
    base = {"contract": contract, "key": None, "key_digest": None}
    target = Target(str(tmp_path / "t"))
    load_table(spark, spec(raw, landing=target, key_version=1, **base), NOW)
    with pytest.raises(Exception, match="no row explains"):
        rekey(spark, spec(raw.limit(1), landing=target, **base), target, NOW)
    assert target.count(spark) == 3
    assert rekey(spark, spec(raw, landing=target, **base), target, NOW) == 3
    assert load_table(spark, spec(raw, landing=target, **base), NOW).landed == 0


def test_unknown_keys_are_left_to_the_user(spark, tmp_path):
    target = Target(str(tmp_path / "t"))
    add_key(frame(spark, (1, "a")), "K", digest="sha2_256").withColumn("K", F.sha2("K", 256)).write.parquet(target.path)
    held = target.read(spark)
    assert recognised(held, "K", KeyMaking(digest="sha2_256")) is None
    with pytest.raises(KeyMismatch, match="cannot tell"):
        rekey(spark, spec(frame(spark, (1, "a")), landing=target), target, NOW)


def test_compat_is_told_from_strict(spark):
    held = add_key(frame(spark, (1, "a"), (2, "b")), "K", encoding="compat", digest="sha2_256")
    found = recognised(held, "K", KeyMaking(digest="sha2_256"))
    assert found == KeyMaking("compat", "sha2_256")
    assert recognised(held.limit(0), "K", KeyMaking(digest="sha2_256")) is None
    assert recognised(add_key(frame(spark, (1, "a")), "K"), "K", KeyMaking(version=1)) == KeyMaking()
