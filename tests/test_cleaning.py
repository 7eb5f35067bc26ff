import json
from datetime import UTC, date, datetime
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from landfall.functions import cleaning, lenient
from landfall.functions.moments import moment

from conftest import AS_OF

DECIMAL = T.DecimalType(38, 0)
NOW = datetime(2024, 1, 15, 12, tzinfo=UTC)


def apply(spark, rule, values, kind="string"):
    """The rule over the values, in order."""
    rows = list(enumerate(values))
    df = spark.createDataFrame(rows, f"i int, v {kind}").select("i", rule(F.col("v")).alias("r"))
    return [r.r for r in df.orderBy("i").collect()]


def check(spark, rule, table, kind="string"):
    assert apply(spark, rule, list(table), kind) == list(table.values())


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_decimal(spark, ansi):
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        check(
            spark,
            lambda c: cleaning.number(c, DECIMAL),
            {
                "1,234": Decimal(1234),
                " 12.5 ": Decimal(13),
                "-12.5": Decimal(-13),
                "007": Decimal(7),
                "5\n": Decimal(5),
                "": None,
                "abc": None,
                "1e5": None,
                "+5": None,
                ".5": None,
                "5.": None,
                "$5": None,
                "(5)": None,
                "1 2": None,
                "--1": None,
                "9" * 40: None,
                None: None,
            },
        )
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")


def test_double(spark):
    table = {"1,234.50": 1234.5, "-0": -0.0, "1.0E10": None, "NaN": None, "": None, None: None}
    check(spark, lambda c: cleaning.number(c, T.DoubleType()), table)


def test_number_from_a_double_goes_by_its_text(spark):
    table = {1.5: 1.5, 1e10: None, None: None}
    check(spark, lambda c: cleaning.number(c, T.DoubleType()), table, "double")


def test_boolean(spark):
    table = dict.fromkeys(["true", "TRUE", "1", "yes", "Yes", "t", "T"], True)
    table |= dict.fromkeys(["false", "0", "No", "F", "f"], False)
    table |= dict.fromkeys(["y", "2", "", "on", " true", None])
    check(spark, cleaning.truth, table)
    check(spark, cleaning.truth, {True: True, False: False, None: None}, "boolean")


def test_flag(spark):
    table = {"yes": "TRUE", "T": "TRUE", "f": "FALSE", "0": "FALSE", "maybe": "maybe", "": ""}
    check(spark, cleaning.flag, table | {None: None})


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_timestamp(spark, ansi):
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        check(
            spark,
            lambda c: cleaning.timestamp(c, as_of=AS_OF),
            {
                "N/A": None,
                "12": None,
                "abc": None,
                "pending": None,
                "abc\n": None,
                "": None,
                None: None,
                "2024-01-01 00:00:00": datetime(2024, 1, 1),
                "2024-01-01T05:06:07+02:00": datetime(2024, 1, 1, 3, 6, 7),
                "2024-01-01 01:02:03.456": datetime(2024, 1, 1, 1, 2, 3, 456000),
                "2024-13-01": None,
                "1/2/2024": datetime(2024, 1, 2),
                "1/2/2024 3:04 PM": datetime(2024, 1, 2, 15, 4),
                "13/2/2024": None,
                "Jan 5, 2024": datetime(2024, 1, 5),
                "January 5, 2024": datetime(2024, 1, 5),
                "5 Jan 2024 06:07:08": datetime(2024, 1, 5, 6, 7, 8),
                "20240103": datetime(2024, 1, 3),
                "20240103T040506": datetime(2024, 1, 3, 4, 5, 6),
                "2024/1/3": datetime(2024, 1, 3),
                "12:30:00": datetime(2024, 1, 15, 12, 30),
                "T7:05": datetime(2024, 1, 15, 7, 5),
                "March 2020": None,
            },
        )
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")


def test_date(spark):
    check(
        spark,
        cleaning.date,
        {
            "2023-12-31": date(2023, 12, 31),
            "2023-13-45": None,
            "2023-2-3 04:05:06": date(2023, 2, 3),
            "12/31/2023": date(2023, 12, 31),
            "20231231": date(2023, 12, 31),
            "soon": None,
            "99": None,
            "": None,
            None: None,
        },
    )


def test_shape_of_unknown_letters():
    assert cleaning.shape("yyyy-MM-dd'T'HH:mm:ssXXX") is None
    assert cleaning.shape("d.M.yyyy") == r"^\d+\.\d+\.\d{4,}$"


def test_shapes_lose_nothing(spark):
    """With and without the shape check, every pattern reads its own text."""
    moment_text = F.lit("2024-03-07 18:09:05").cast("timestamp")
    for pattern in cleaning.DATE_FORMATS:
        text = F.date_format(moment_text, pattern)
        gated = F.try_to_timestamp(cleaning._fitting(text, pattern), F.lit(pattern))
        row = spark.range(1).select(
            gated.alias("g"), F.try_to_timestamp(text, F.lit(pattern)).alias("u")
        ).first()
        assert row.g is not None and row.g == row.u, pattern


def test_future(spark):
    late, early = datetime(2030, 1, 1), datetime(2020, 1, 1)
    as_of = datetime(2024, 1, 15, 12)
    expected = {"clamp": as_of, "null": None, "keep": late}
    for policy, value in expected.items():
        table = {late: value, early: early, None: None}
        check(spark, lambda c, p=policy: cleaning.future(c, p, AS_OF), table, "timestamp")
    table = {date(2030, 1, 1): None, date(2024, 1, 15): date(2024, 1, 15), None: None}
    check(spark, lambda c: cleaning.future(c, "null", AS_OF, "date"), table, "date")
    with pytest.raises(ValueError, match="unknown future policy"):
        cleaning.future(F.col("v"), "drop")


def test_range(spark):
    table = {datetime(year, 6, 1): None for year in (1, 1899, 2026, 9999)}
    table |= {(kept := datetime(year, 6, 1)): kept for year in (1900, 2024, 2025)}
    check(spark, lambda c: cleaning.in_range(c, AS_OF), table | {None: None}, "timestamp")
    check(spark, lambda c: cleaning.in_range(c, AS_OF), table | {None: None}, "timestamp_ntz")


def test_audit_default(spark):
    kept = datetime(2020, 1, 1)
    table = {None: datetime(2024, 1, 15, 12), kept: kept}
    check(spark, lambda c: cleaning.audit_default(c, AS_OF), table, "timestamp")


JSON_TEXTS = [
    '{"a":1}', "[1]", "12", '"x"', "null", ' {"a": [1, {"b": null}]} ', "[]", "{}", "-0",
    "", "{bad", "{'a':1}", "1][2", "1,2", '"k": 89}', '{"a":1}{"b":2}', '{"a":1} x', "[1,]",
    "01", "tru", "1.", '"a', "[1]]", '"a\tb"', None,
]


def python_takes(text):
    try:
        json.loads(text)
    except (TypeError, ValueError):
        return False
    return True


def test_json(spark):
    expected = [t if python_takes(t) else None for t in JSON_TEXTS]
    assert apply(spark, cleaning.valid_json, JSON_TEXTS) == expected
    assert apply(spark, lenient.python_json, JSON_TEXTS) == expected
    assert apply(spark, cleaning.json_by_outline, JSON_TEXTS) == expected


def test_json_where_the_checks_differ(spark):
    texts = ["NaN", '{"a":1,"a":2}']
    assert apply(spark, cleaning.valid_json, texts) == [None, None]
    assert apply(spark, lenient.python_json, texts) == texts
    assert apply(spark, cleaning.json_by_outline, texts) == texts


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.text(alphabet='[]{}",:1 a', max_size=8), min_size=1, max_size=60))
def test_json_on_scraps(spark, texts):
    expected = [t if python_takes(t) else None for t in texts]
    found = apply(spark, cleaning.valid_json, texts)
    for text, mine, theirs in zip(texts, found, expected, strict=True):
        # Objects with a repeated key are the one known difference.
        assert mine == theirs or (mine is None and text.count(":") > 1)
    assert apply(spark, cleaning.json_by_outline, texts) == expected


def test_free_form_timestamp(spark):
    check(
        spark,
        lambda c: lenient.free_form_timestamp(c, NOW, "America/New_York"),
        {
            "Mon Jan 8 10:11:12 2024": datetime(2024, 1, 8, 15, 11, 12),
            "2024-07-01 00:00": datetime(2024, 7, 1, 4),
            "2024-01-01T05:06:07+02:00": datetime(2024, 1, 1, 3, 6, 7),
            "March 2020": datetime(2020, 3, 15, 4),
            "no digits": None,
            "123": None,
            "32 January 2024 x": None,
            None: None,
        },
    )


def test_free_form_date(spark):
    check(
        spark,
        lambda c: lenient.free_form_date(c, NOW, "America/New_York"),
        {
            "8th of January 2024": date(2024, 1, 8),
            "2024-01-01T00:30:00+02:00": date(2024, 1, 1),
            "9999-12-31": date(9999, 12, 31),
            "never": None,
            None: None,
        },
    )


def test_moment(spark):
    forms = [AS_OF, datetime(2024, 1, 15, 12), NOW, F.lit(AS_OF).cast("timestamp")]
    row = spark.range(1).select(*(moment(m).alias(str(i)) for i, m in enumerate(forms))).first()
    assert set(row) == {datetime(2024, 1, 15, 12)}
