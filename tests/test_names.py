import pytest

from landfall.functions.names import (
    key_name,
    light_name,
    qualified_name,
    squashed,
    strict_name,
)
from landfall.operators.naming import NameCollision, clean_names


@pytest.mark.parametrize(
    "raw, clean",
    [("x  y.z", "x_y_z"), ("a-b", "a_b"), ("plain_1", "plain_1"), ("ä ö", "ä_ö"), ("$a$", "_a_")],
)
def test_strict_name(raw, clean):
    assert strict_name(raw) == clean


@pytest.mark.parametrize("raw, clean", [("a b", "a_b"), ("a-b", "a-b"), ("a  b.c", "a__b_c")])
def test_light_name(raw, clean):
    assert light_name(raw) == clean


def frame(spark, *names):
    return spark.createDataFrame([tuple("v" for _ in names)], list(names))


def test_strict_collision_names_all(spark):
    with pytest.raises(NameCollision, match=r"\['a b', 'a-b'\]"):
        clean_names(frame(spark, "a b", "a-b", "c"))


def test_light_collision(spark):
    assert clean_names(frame(spark, "a b", "a-b"), "light").columns == ["a_b", "a-b"]
    with pytest.raises(NameCollision):
        clean_names(frame(spark, "a b", "a.b"), "light")


def test_case_collision_follows_session(spark):
    with pytest.raises(NameCollision):
        clean_names(frame(spark, "a b", "A-B"))
    spark.conf.set("spark.sql.caseSensitive", "true")
    try:
        assert clean_names(frame(spark, "a b", "A-B")).columns == ["a_b", "A_B"]
    finally:
        spark.conf.unset("spark.sql.caseSensitive")


@pytest.mark.parametrize(
    "text, schema, table",
    [('public."lead"', "public", "lead"), ("orders", "public", "orders"), ("s.t", "s", "t"), ('"a.b".c', "a.b", "c"), ('"q""x"', "public", 'q"x')],
)
def test_qualified_name(text, schema, table):
    assert qualified_name(text) == (schema, table)


@pytest.mark.parametrize("text", ["a;b", "a b", "", "a'--", ".", "s.", "a.b\n", "a.b.c", '"a', 'a"b"'])
def test_no_table_name(text):
    with pytest.raises(ValueError, match="not a table name"):
        qualified_name(text)


def test_quoted_name():
    assert qualified_name("s.t").quote() == '"s"."t"'
    assert qualified_name("s.t").quote("[", "]") == "[s].[t]"


def test_key_names():
    assert key_name("crm", "orders") == "STG_CRM_ORDERS_KEY"
    assert squashed("LEAD_TYPE_ID") == "leadtypeid"
