from datetime import datetime, UTC

import pytest
from pyspark.sql import types as T

from landfall.operators.conform import ContractViolation
from landfall.operators.widening import same_text, wider_schema, wider_type
from landfall.plans.load import load_table
from landfall.plans.spec import TableSpec
from landfall.sinks.schema_note import note_schema, noted_schema
from landfall.sinks.targets import Target
from landfall.sources.tables import FrameSource

NOW = datetime(2024, 1, 15, 12, tzinfo=UTC)


def kind(text):
    return T._parse_datatype_string(text)


@pytest.mark.parametrize(
    "held, new, wide",
    [
        ("int", "int", "int"),
        ("int", "bigint", "bigint"),
        ("tinyint", "smallint", "smallint"),
        ("int", "decimal(5,2)", "decimal(12,2)"),
        ("decimal(10,2)", "decimal(8,4)", "decimal(12,4)"),
        ("float", "double", "double"),
        ("int", "float", "double"),
        ("date", "timestamp_ntz", "timestamp_ntz"),
        ("void", "string", "string"),
        ("bigint", "double", None),
        ("int", "string", None),
        ("date", "timestamp", None),
        ("decimal(38,0)", "decimal(10,5)", None),
        ("array<int>", "array<bigint>", None),
        ("boolean", "int", None),
    ],
)
def test_wider_type(spark, held, new, wide):
    expected = kind(wide) if wide else None
    assert wider_type(kind(held), kind(new)) == expected
    assert wider_type(kind(new), kind(held)) == expected


def test_the_order_is_one(spark):
    """Joining is associative where it is defined, so files may come in any order."""
    kinds = [kind(t) for t in ("tinyint", "int", "bigint", "decimal(9,3)", "decimal(25,1)")]
    for a in kinds:
        for b in kinds:
            for c in kinds:
                assert wider_type(wider_type(a, b), c) == wider_type(a, wider_type(b, c))


def test_same_text(spark):
    assert same_text(kind("int"), kind("bigint")) and same_text(kind("int"), kind("decimal(20,0)"))
    assert not same_text(kind("int"), kind("decimal(20,1)"))
    assert not same_text(kind("float"), kind("double"))


def test_schema_names_every_fault(spark):
    with pytest.raises(ContractViolation) as error:
        wider_schema(kind("a int, b string, C int"), kind("a string, b int, c int"))
    assert [(v.column, v.problem) for v in error.value.violations] == [
        ("a", "type"), ("b", "type"), ("c", "case"),
    ]


def load(spark, target, rows, shape, **options):
    source = FrameSource(spark.createDataFrame(rows, shape))
    spec = TableSpec(**{"name": "t", "source": source, "system": "S", "key": "K", "landing": target} | options)
    return load_table(spark, spec, NOW)


def rows(spark, target, *names):
    return sorted(map(tuple, target.read(spark).select(*names).collect()), key=str)


def test_wider_rows_are_appended_and_read_back(spark, tmp_path):
    target = Target(str(tmp_path / "t"), widen=True)
    load(spark, target, [(1, "a"), (2, "b")], "id int, note string")
    assert noted_schema(spark, target.path) is None
    result = load(spark, target, [(2, "b", None), (5_000_000_000, "c", 1.5)], "id bigint, note string, more double")
    # Row 2 is held already: its key says so although its type has grown.
    assert (result.landing_before, result.landed, result.landing_after) == (2, 1, 3)
    assert target.read(spark).schema["id"].dataType == T.LongType()
    assert rows(spark, target, "id", "note", "more") == [
        (1, "a", None), (2, "b", None), (5_000_000_000, "c", 1.5),
    ]
    read = target.read(spark)
    assert [r.id for r in read.filter("id > 1").orderBy("id").collect()] == [2, 5_000_000_000]
    assert read.filter("more IS NULL").count() == 2


def test_narrower_rows_are_widened_to_what_is_held(spark, tmp_path):
    target = Target(str(tmp_path / "t"), widen=True)
    load(spark, target, [(1, "a")], "id bigint, note string")
    load(spark, target, [(1,), (2,)], "id int", mode="append")
    load(spark, target, [(1, "a"), (3, "z")], "id smallint, note string")
    assert rows(spark, target, "id", "note") == [(1, "a"), (1, None), (2, None), (3, "z")]
    assert noted_schema(spark, target.path) is None


def test_everything_else_is_refused_before_a_note_or_row_is_written(spark, tmp_path):
    target = Target(str(tmp_path / "t"), widen=True)
    load(spark, target, [(1, 1.0)], "id int, share float")
    for shape, record in {
        "id string, share float": ("2", 1.0),
        "id int, share double": (2, 1.0),  # by key: equal values would read otherwise
        "ID int, share float": (2, 1.0),
    }.items():
        with pytest.raises(ContractViolation):
            load(spark, target, [record], shape)
    assert rows(spark, target, "id", "share") == [(1, 1.0)]
    assert noted_schema(spark, target.path) is None
    load(spark, target, [(2, 0.5)], "id int, share double", mode="append")
    assert rows(spark, target, "id", "share") == [(1, 1.0), (2, 0.5)]


def test_a_load_that_died_after_the_note(spark, tmp_path):
    target = Target(str(tmp_path / "t"), widen=True)
    load(spark, target, [(1, "a")], "id int, note string")
    note_schema(spark, target.path, wider_schema(target.read(spark).schema, kind("id bigint, more date")))
    assert rows(spark, target, "id", "more") == [(1, None)]
    load(spark, target, [(2, "b")], "id int, note string")
    assert rows(spark, target, "id", "note") == [(1, "a"), (2, "b")]


def test_replacing_drops_the_note(spark, tmp_path):
    for publish in ("direct", "switch"):
        target = Target(str(tmp_path / publish), widen=True, publish=publish)
        load(spark, target, [(1,)], "id int")
        load(spark, target, [(2,)], "id bigint")
        assert noted_schema(spark, target.path) is not None
        load(spark, target, [(3,)], "id int", mode="historical")
        assert noted_schema(spark, target.path) is None
        assert target.read(spark).schema["id"].dataType == T.IntegerType()


def test_catalog_tables_are_added_to(spark):
    target = Target(table="widened_table", widen=True)
    load(spark, target, [(1, "a")], "id int, note string")
    load(spark, target, [(1, "a", None), (2, "b", "x")], "id int, note string, more string")
    assert rows(spark, target, "id", "more") == [(1, None), (2, "x")]
    with pytest.raises(ContractViolation):
        load(spark, target, [(3, "c", "y")], "id bigint, note string, more string")


def test_only_parquet_is_widened(tmp_path):
    with pytest.raises(ValueError, match="widened"):
        Target(str(tmp_path), format="orc", widen=True)
