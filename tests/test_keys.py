import hashlib

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from landfall.functions.digest import content_key, row_text, sha3_512
from landfall.operators.keys import add_key, key_sample

TEXT = st.one_of(st.none(), st.text(alphabet="ab|-1:é😀 ", max_size=4))


def keys(df, **options):
    return [r.k for r in add_key(df, "k", **options).collect()]


def test_sha3_is_hashlib(spark):
    values = ["", "abc", "ä€😀", "x" * 5000, None]
    df = spark.createDataFrame([(v,) for v in values], "v string")
    found = [r[0] for r in df.select(sha3_512(F.col("v"))).collect()]
    assert found == [None if v is None else hashlib.sha3_512(v.encode()).hexdigest() for v in values]


def test_compat_on_a_whole_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    for row in add_key(df, "k", encoding="compat").collect():
        text = "||".join([str(row.doc_id), row.text, row.lang, row.source, str(row.n_chars)])
        assert row.k == hashlib.sha3_512(text.encode()).hexdigest()


def test_compat_is_blind_to_where_a_null_stands(spark):
    df = spark.createDataFrame([("a", None, "b"), ("a", "b", None)], "x string, y string, z string")
    first, second = keys(df, encoding="compat")
    assert first == second
    first, second = keys(df)
    assert first != second


def test_compat_all_null_and_no_columns(spark):
    empty = hashlib.sha3_512(b"").hexdigest()
    assert keys(spark.createDataFrame([(None,)], "x string"), encoding="compat") == [empty]
    none = spark.createDataFrame([("EDW",)], "CREATED_BY string")
    assert keys(none, encoding="compat") == [empty]


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(TEXT, TEXT, TEXT), min_size=2, max_size=30))
def test_strict_tells_all_rows_apart(spark, records):
    df = spark.createDataFrame(records, "x string, y string, z string")
    found = keys(df, digest="sha2_256")
    assert len(set(found)) == len(set(records))


def test_strict_text(spark):
    df = spark.createDataFrame([("é", None)], "y string, x string")
    assert df.select(row_text(df.schema.fields)).first()[0] == "1|y|2|é"


def test_a_new_null_column_changes_no_strict_key(spark):
    df = spark.createDataFrame([("a", 1), (None, 2)], "x string, y int")
    assert keys(df) == keys(df.selectExpr("*", "CAST(NULL AS string) AS later"))


def test_strict_tells_nested_rows_apart(spark):
    rows = ["TIMESTAMP '2024-01-01 00:00:00.000001Z'", "TIMESTAMP '2024-01-01 00:00:00.000002Z'", "NULL"]
    union = " UNION ALL ".join(f"SELECT named_struct('t', {r}, 'a', array('x', NULL)) AS s" for r in rows)
    union += " UNION ALL SELECT named_struct('t', NULL, 'a', array('x')) UNION ALL SELECT NULL"
    found = spark.sql(union).select(content_key(spark.sql(union).schema.fields, nested="json")).collect()
    assert len({r[0] for r in found}) == 5


def test_strict_ignores_column_order_and_zone(spark):
    df = spark.sql("SELECT 1 AS a, TIMESTAMP '2024-01-01 00:00:00Z' AS t, 'x' AS b")
    before = keys(df)
    assert keys(df.select("b", "t", "a")) == before
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        assert keys(df) == before
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_key_comes_first_and_leaves_out_itself_and_audit(spark):
    df = spark.createDataFrame([("a", "old", "me")], "v string, k string, CREATED_BY string")
    keyed = add_key(df, "k")
    assert keyed.columns == ["k", "v", "CREATED_BY"]
    assert not keyed.schema["k"].nullable
    assert keyed.first().k == keys(df.select("v"))[0]


def test_no_key_no_change(spark):
    df = spark.range(1)
    assert add_key(df, None) is df


def test_nested_columns(spark):
    df = spark.sql("SELECT array(1, 2) AS a, named_struct('x', 1) AS s")
    with pytest.raises(TypeError, match="does not hash"):
        add_key(df, "k")
    assert len(keys(df, nested="json")) == 1
    with pytest.raises(TypeError, match="no stable text"):
        add_key(spark.sql("SELECT array(map('a', 1)) AS m"), "k", nested="json")


def test_odd_column_names(spark):
    df = spark.createDataFrame([("a",)], T.StructType([T.StructField("x.y `z", T.StringType())]))
    assert len(keys(df)) == 1


def test_unknown_options(spark):
    with pytest.raises(ValueError, match="unknown digest"):
        add_key(spark.range(1), "k", digest="crc")
    with pytest.raises(ValueError, match="unknown key encoding"):
        add_key(spark.range(1), "k", encoding="loose")


def test_key_sample(spark):
    sample = key_sample(add_key(spark.range(100), "k", digest="sha2_256"), "k")
    assert sample.columns == ["k"] and sample.count() == 5
