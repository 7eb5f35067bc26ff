import hashlib
from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from landfall.operators.changes import first_per_key, new_rows

KEY = st.one_of(st.none(), st.sampled_from("abcdefgh"))
SHAPE = "k string, v int"
# Sizes that lead down each way, for the same small data; a key takes 129 bytes.
BOTH_LARGE = {"batch_rows": 1 << 40, "existing_rows": 1 << 40}
WAYS = {
    "few existing": {},
    "few existing, large batch": {"batch_rows": 1 << 40},
    "small batch": {"existing_rows": 1 << 40},
    "both large, few keys": {**BOTH_LARGE, "broadcast_bytes": 800},
    "both large, many keys": {**BOTH_LARGE, "broadcast_bytes": 1},
    "both large, hot keys": {**BOTH_LARGE, "broadcast_bytes": 400, "hot_rows": 2},
}


def brute_force(batch, held, dedupe):
    known = {k for k in held if k is not None}
    fresh = [r for r in batch if r[0] is None or r[0] not in known]
    if not dedupe:
        return Counter(fresh)
    best = {}
    for key, value in fresh:
        if key is not None:
            best[key] = min(value, best.get(key, value))
    return Counter([r for r in fresh if r[0] is None] + list(best.items()))


def found(frame):
    return Counter((r.k, r.v) for r in frame.collect())


@pytest.mark.parametrize("dedupe", [False, True])
@pytest.mark.parametrize("way", WAYS)
@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    batch=st.lists(st.tuples(KEY, st.integers(0, 3)), max_size=25),
    held=st.lists(KEY, max_size=12),
)
def test_every_way_is_right(spark, way, dedupe, batch, held):
    rows = new_rows(
        spark.createDataFrame(batch, SHAPE),
        spark.createDataFrame([(k,) for k in held], "k string"),
        "k",
        dedupe=dedupe,
        order_by=["v"],
        **WAYS[way],
    )
    assert found(rows) == brute_force(batch, held, dedupe)
    assert rows.columns == ["k", "v"]


BATCH = [("k1", 1), ("k1", 2), ("k2", 3), (None, 4)]


def test_fixture(spark):
    batch = spark.createDataFrame(BATCH, SHAPE)
    held = spark.createDataFrame([("k2",), (None,)], "k string")
    assert found(new_rows(batch, held, "k")) == Counter([BATCH[0], BATCH[1], BATCH[3]])
    assert found(new_rows(batch, held, "k", dedupe=True, order_by=["v"])) == Counter(
        [BATCH[0], BATCH[3]]
    )


@pytest.mark.parametrize("held", [None, []])
@pytest.mark.parametrize("sizes", [{}, {"broadcast_bytes": 1}, {"broadcast_bytes": 150, "hot_rows": 1}])
def test_nothing_held(spark, held, sizes):
    batch = spark.createDataFrame(BATCH, SHAPE)
    existing = None if held is None else spark.createDataFrame([], "k string")
    assert found(new_rows(batch, existing, "k", **sizes)) == Counter(BATCH)
    deduped = new_rows(batch, existing, "k", dedupe=True, order_by=["v"], **sizes)
    assert found(deduped) == Counter([BATCH[0], BATCH[2], BATCH[3]])


def test_everything_held(spark):
    batch = spark.createDataFrame(BATCH[:3], SHAPE)
    for sizes in WAYS.values():
        assert new_rows(batch, batch, "k", **sizes).isEmpty()


def test_key_column_stays_in_place(spark):
    batch = spark.createDataFrame([(1, "a", 2)], "x int, k string, y int")
    held = spark.createDataFrame([("b",)], "k string")
    for sizes in WAYS.values():
        assert new_rows(batch, held, "k", **sizes).columns == ["x", "k", "y"]


def test_a_third_of_all_rows_on_one_key(spark):
    """Neither side's hot key ever meets the other's in one task."""
    rows = spark.range(300_000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"),
        F.col("id").alias("v"),
    )
    held = rows.filter("id < 30000").select("k")
    fresh = new_rows(rows, held, "k", broadcast_bytes=200_000, hot_rows=1000)
    assert fresh.count() == 180_000
    once = new_rows(rows, held.filter("k <> 'hot'"), "k", dedupe=True, broadcast_bytes=200_000)
    assert once.count() == 180_001
    assert once.filter("k = 'hot'").count() == 1


def test_first_per_key_keeps_rows_without_key(spark):
    df = spark.createDataFrame([("a", 2), ("a", 1), (None, 5), (None, 5)], SHAPE)
    assert found(first_per_key(df, "k", ["v"])) == Counter([("a", 1), (None, 5), (None, 5)])
    assert found(first_per_key(df, "k", [F.desc("v")]))[("a", 2)] == 1


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_large_target_is_not_shuffled_for_a_small_batch(spark, tmp_path):
    spark.range(1000).selectExpr("CAST(id AS string) AS k", "id AS v").write.parquet(str(tmp_path / "t"))
    target = spark.read.parquet(str(tmp_path / "t"))
    batch = spark.createDataFrame([("5", 1), ("x", 2)], SHAPE)
    fresh = new_rows(batch, target, "k", broadcast_bytes=1000)
    text = plan(fresh)
    assert "SortMergeJoin" not in text
    assert text.count("BroadcastHashJoin") == 2
    # The one shuffle is of the keys both sides hold.
    assert text.count("Exchange hashpartitioning") == 1
    assert found(fresh) == Counter([("x", 2)])


def test_batch_is_not_shuffled_for_few_existing_keys(spark):
    batch = spark.range(1000).selectExpr("CAST(id AS string) AS k", "id AS v")
    fresh = new_rows(batch, batch.limit(10).select("k"), "k")
    assert "BroadcastHashJoin" in plan(fresh)
    assert "hashpartitioning" not in plan(fresh)


def test_dedupe_limits_ranks_before_the_shuffle(spark):
    df = spark.range(100).selectExpr("CAST(id % 3 AS string) AS k", "id AS v")
    text = plan(first_per_key(df, "k", ["v"]))
    assert "Partial" in text and text.index("Exchange hashpartitioning") < text.index("Partial")


@pytest.mark.parametrize("dedupe", [False, True])
@pytest.mark.parametrize("way", WAYS)
@settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    batch=st.lists(st.tuples(KEY, st.integers(0, 3)), max_size=25),
    held=st.lists(KEY, max_size=12),
)
def test_every_way_is_right_for_digests(spark, way, dedupe, batch, held):
    def digested(key):
        return key and hashlib.sha256(key.encode()).hexdigest()

    batch = [(digested(k), v) for k, v in batch]
    # Keys of another making in the target match nothing.
    held = [digested(k) for k in held] + ["no digest", "", "0A", "z" * 64]
    held[::2] = [k and k.upper() for k in held[::2]]  # case does not matter
    rows = new_rows(
        spark.createDataFrame(batch, SHAPE),
        spark.createDataFrame([(k,) for k in held], "k string"),
        "k",
        dedupe=dedupe,
        order_by=["v"],
        hex_digits=64,
        **WAYS[way],
    )
    assert found(rows) == brute_force(batch, [k and k.lower() for k in held], dedupe)
    assert rows.columns == ["k", "v"]


@pytest.mark.parametrize("way", WAYS)
@pytest.mark.parametrize("key", ["abcd", "z" * 64, "A" * 63, "A" * 64])
def test_keys_that_are_no_digests_stop_the_job(spark, way, key):
    batch = spark.createDataFrame([(key, 1)], SHAPE)
    held = spark.createDataFrame([("x",)], "k string")
    with pytest.raises(Exception, match="a key is not 64 hex digits"):
        new_rows(batch, held, "k", hex_digits=64, **WAYS[way]).collect()


def test_long_keys_are_not_broadcast_for_being_few(spark):
    batch = spark.createDataFrame([("x" * 5000, 1), ("y" * 5000, 2)], SHAPE)
    held = batch.limit(1).select("k")
    fresh = new_rows(batch, held, "k", broadcast_bytes=4000)
    assert [r.v for r in fresh.collect()] == [2]
    assert "LeftAnti, BuildRight" not in plan(fresh)


def test_long_foreign_keys_are_left_out_of_a_broadcast_of_digests(spark):
    key = hashlib.sha256(b"a").hexdigest()
    batch = spark.createDataFrame([(key, 1)], SHAPE)
    held = spark.createDataFrame([("x" * 100_000,), (key,)], "k string")
    fresh = new_rows(batch, held, "k", hex_digits=64, broadcast_bytes=1000)
    assert "length(k" in plan(fresh) and "BroadcastHashJoin" in plan(fresh)
    assert fresh.isEmpty()


def test_number_keys(spark):
    batch = spark.range(10).selectExpr("id AS k", "id AS v")
    for sizes in WAYS.values():
        fresh = new_rows(batch, spark.range(3, 7).selectExpr("CAST(id AS int) AS k"), "k", **sizes)
        assert sorted(r.k for r in fresh.collect()) == [0, 1, 2, 7, 8, 9]
