import hashlib
import itertools
import json
from datetime import UTC, date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import types as T

from landfall.contracts import Contract
from landfall.contracts.leads import lead_contracts
from landfall.functions.names import squashed
from landfall.operators.audit import AUDIT_COLUMNS, stamp
from landfall.operators.clean import clean, clean_timestamps, settle_future
from landfall.operators.conform import (
    ContractViolation,
    conform,
    null_unsupported,
    project,
    validate,
    violations,
    violations_frame,
)
from landfall.plans.load import prepare
from landfall.plans.spec import TableSpec
from landfall.sinks.targets import Target
from landfall.sources.tables import FrameSource

from conftest import AS_OF

NOW = datetime(2024, 1, 15, 12, tzinfo=UTC)


def contract(**options):
    return Contract(
        **{"name": "t", "columns": "LEAD_GUID string, AMOUNT decimal(10,2), SEEN timestamp"} | options
    )


def test_conform_renames_and_fills(spark):
    df = spark.createDataFrame([("x", 1, "1.5")], "note string, LeadGuid int, amount string")
    shaped = conform(df, contract())
    assert shaped.columns == ["LEAD_GUID", "AMOUNT", "SEEN"]
    assert shaped.schema["SEEN"].dataType == T.TimestampType()
    assert shaped.first() == (1, "1.5", None)


def test_conform_keeps_extras_in_frame_order_for_the_key(spark):
    df = spark.createDataFrame([("1.5", "x", "g")], "amount string, note string, leadguid string")
    shaped = conform(df, contract(extras="hash"))
    assert shaped.columns == ["AMOUNT", "note", "LEAD_GUID", "SEEN"]


def test_conform_takes_the_contract_name_as_it_is(spark):
    df = spark.createDataFrame([("g",)], "lead_guid string")
    assert conform(df, contract()).first().LEAD_GUID == "g"


def test_conform_last_of_names_equal_up_to_case(spark):
    spark.conf.set("spark.sql.caseSensitive", "true")
    try:
        df = spark.createDataFrame([("first", "last")], "LeadGuid string, leadguid string")
        assert conform(df, contract()).first().LEAD_GUID == "last"
    finally:
        spark.conf.unset("spark.sql.caseSensitive")


def test_conform_rejects_two_sources_for_one_column(spark):
    df = spark.createDataFrame([("a", "b")], "leadguid string, lead_guid string")
    with pytest.raises(ValueError, match="both 'leadguid' and 'lead_guid' are LEAD_GUID"):
        conform(df, contract())


def test_conform_drops_raw_audit_and_key(spark):
    df = spark.createDataFrame(
        [("g", "me", "old")], "leadguid string, created_by string, K string"
    )
    assert conform(df, contract(key="K", extras="hash")).columns == ["LEAD_GUID", "AMOUNT", "SEEN"]


def test_violations(spark):
    df = spark.createDataFrame([(Decimal(1),)], "AMOUNT decimal(12,2)")
    shape = contract().business
    faults = violations(df, shape)
    assert [tuple(f) for f in faults] == [
        ("LEAD_GUID", "missing", "string", None),
        ("AMOUNT", "type", "decimal(10,2)", "decimal(12,2)"),
        ("SEEN", "missing", "timestamp", None),
    ]
    assert [f.column for f in violations(df, shape, types=False)] == ["LEAD_GUID", "SEEN"]
    assert violations_frame(spark, faults).count() == 3
    with pytest.raises(ContractViolation, match="LEAD_GUID.*AMOUNT.*SEEN") as caught:
        validate(df, shape)
    assert caught.value.violations == faults


def test_contract_from_json(spark):
    made = Contract.from_json(
        json.dumps({"name": "t", "columns": "A_B string, C int", "renames": {"see": "C"}, "key": "K"})
    )
    assert made.raw_names == {"ab": "A_B", "see": "C"}
    assert made.schema.names == ["K", "A_B", "C", *AUDIT_COLUMNS]
    with pytest.raises(ValueError, match="not part of a contract"):
        Contract.from_dict({"name": "t", "columns": "A int", "keys": "K"})


@pytest.mark.parametrize("bad", [{"json": ["NO"]}, {"flags": ["NO"]}, {"future": {"NO": "keep"}}])
def test_contract_checks_roles(spark, bad):
    with pytest.raises(ValueError, match="no such contract column"):
        contract(**bad).business


def test_contract_checks_options():
    for bad in ({"future": {"SEEN": "drop"}}, {"extras": "keep"}, {"json_check": "loose"}):
        with pytest.raises(ValueError):
            contract(**bad)


def test_lead_contracts(spark):
    contracts = lead_contracts("crm")
    count = {}
    for name, made in contracts.items():
        kinds = [type(f.dataType).__name__ for f in made.schema.fields]
        count[name] = {k: kinds.count(k) for k in sorted(set(kinds))}
        assert len(made.raw_names) == len(made.business)
    assert count == {
        "lead": {
            "BooleanType": 2, "DateType": 1, "DecimalType": 9, "DoubleType": 2,
            "StringType": 80, "TimestampType": 7,
        },
        "lead_xref": {"BooleanType": 1, "StringType": 12, "TimestampType": 5},
        "lead_assignment": {
            "BooleanType": 2, "DoubleType": 2, "StringType": 29, "TimestampType": 8,
        },
    }
    assert contracts["lead"].raw_names["originsystem_orig"] == "ORIGIN_SYSTEM_ORIG"
    assert contracts["lead_assignment"].key == "STG_CRM_LEAD_ASSIGNMENT_KEY"


def test_one_row_through_the_widest_contract(spark):
    lead = lead_contracts("crm")["lead"]
    raw = {
        "leadguid": "g1", "leadtypeid": "1,234", "coborrowerage": "41.5", "subsourceid": "Yes",
        "isdeletedsource": "f", "loandate": "2023-12-31", "leadcreatedate": "1/2/2024 03:04",
        "leadattributes": "{bad", "createdate": "1850-01-01", "modifydate": "2030-01-01 00:00:00",
        "extra": "hashed",
    }
    df = spark.createDataFrame([tuple(raw.values())], ", ".join(f"{n} string" for n in raw))
    spec = TableSpec(
        "lead", FrameSource(df), "CRM", contract=lead, landing=Target("unused"), key_encoding="compat"
    )
    made = prepare(spark, spec, NOW)
    assert made.schema.names == lead.schema.names
    row = made.first()
    assert row.LEAD_TYPE_ID == Decimal(1234)
    assert row.COBORROWER_AGE == 41.5
    assert row.SUB_SOURCE_ID is True
    assert row.IS_DELETED_SOURCE == "FALSE"
    assert row.LOAN_DATE == date(2023, 12, 31)
    assert row.LEAD_CREATE_DATE == datetime(2024, 1, 2, 3, 4)
    assert row.LEAD_ATTRIBUTES is None
    assert row.CREATE_DATE is None
    assert row.MODIFY_DATE is None
    assert row.ETL_CREATED_DATE == datetime(2024, 1, 15, 12)
    assert (row.CREATED_BY, row.TO_PROCESS) == ("ETL_PROCESS", True)


def test_key_does_not_move_with_the_clamp(spark):
    shape = contract(key="K", future={"SEEN": "clamp"})
    df = spark.createDataFrame([("g", "2025-03-01 00:00:00")], "leadguid string, seen string")
    spec = TableSpec("t", FrameSource(df), "S", contract=shape, landing=Target("unused"))
    first = prepare(spark, spec, NOW).first()
    later = prepare(spark, spec, datetime(2024, 6, 1, tzinfo=UTC)).first()
    assert first.K == later.K
    assert (first.SEEN, later.SEEN) == (datetime(2024, 1, 15, 12), datetime(2024, 6, 1))


def test_roles_go_before_types(spark):
    shape = Contract(
        name="t",
        columns="J string, F string, B boolean, I decimal(38,0), N timestamp_ntz",
        json=["J"],
        flags=["F", "B"],
    )
    df = spark.sql(
        "SELECT 'x' AS J, 'no' AS F, 'no' AS B, 7L AS I, TIMESTAMP_NTZ '1800-01-01 00:00:00' AS N"
    )
    cleaned = clean(df, shape, AS_OF)
    assert cleaned.schema == validate(cleaned, shape.business).schema
    assert cleaned.first() == (None, "FALSE", False, Decimal(7), None)


def test_free_form_rest(spark):
    shape = contract(free_form_zone="America/New_York")
    df = spark.createDataFrame(
        [("Mon Jan 8 10:00:00 2024",), ("1/8/2024",), ("nothing at 1",)], "seen string"
    )
    found = [r.SEEN for r in clean(conform(df, shape), shape, NOW).collect()]
    assert found == [datetime(2024, 1, 8, 15), datetime(2024, 1, 8), None]
    with pytest.raises(TypeError, match="time zone"):
        clean(conform(df, shape), shape, AS_OF)


def test_python_json_check(spark):
    shape = Contract(name="t", columns="J string", json=["J"], json_check="python")
    df = spark.createDataFrame([("NaN",), ("{",), ("[1]",)], "j string")
    found = [r.J for r in clean(conform(df, shape), shape).collect()]
    assert found == ["NaN", None, "[1]"]


def test_cleaning_twice_changes_nothing(spark):
    shape = contract(future={"SEEN": "clamp"})
    df = spark.createDataFrame(
        [("g", " 1,5 ", "1/2/2024"), (None, "x", "2030-01-01"), ("h", "7.126", "1/1/25")],
        "leadguid string, amount string, seen string",
    )
    once = settle_future(clean(conform(df, shape), shape, AS_OF), shape, AS_OF)
    twice = settle_future(clean(once, shape, AS_OF), shape, AS_OF)
    assert twice.collect() == once.collect()


def test_clean_timestamps_of_any_frame(spark):
    df = spark.sql(
        "SELECT 1 AS i, TIMESTAMP '1800-01-01' AS a, CAST(NULL AS TIMESTAMP) AS ETL_CREATED_DATE"
    )
    assert clean_timestamps(df, AS_OF).first() == (1, None, datetime(2024, 1, 15, 12))


def test_stamp_replaces(spark):
    df = spark.createDataFrame([("v", "me")], "v string, CREATED_BY string")
    row = stamp(df, "S", AS_OF, creator="you", to_process=False).first()
    assert row.asDict() == {
        "v": "v",
        "CREATED_BY": "you",
        "ETL_CREATED_DATE": datetime(2024, 1, 15, 12),
        "ETL_LAST_UPDATE_DATE": datetime(2024, 1, 15, 12),
        "TO_PROCESS": False,
        "EDW_EXTERNAL_SOURCE_SYSTEM": "S",
    }


def test_project(spark):
    df = spark.createDataFrame([(1, 2, 3)], "a int, b int, c int")
    assert project(df, T.StructType.fromDDL("c int, a int")).columns == ["c", "a"]


def test_null_unsupported(spark):
    df = spark.createDataFrame([(1, 2.5)], "a int, b double")
    types = {"a": "int", "b": "Money"}
    assert null_unsupported(df, types).first() == (1, None)
    assert null_unsupported(df, types, keep_text=True).first() == (1, "2.5")


def test_raw_names_by_rule():
    assert squashed("ADDR_ID") == "addrid"


def test_raw_timestamps_are_range_checked_whatever_they_become(spark):
    shape = Contract(name="t", columns="BORN string", extras="hash")
    df = spark.sql("SELECT TIMESTAMP '1850-01-01' AS born, TIMESTAMP '3000-01-01' AS other")
    assert clean(conform(df, shape), shape, AS_OF).first() == (None, None)


def test_timestamp_from_seconds(spark):
    shape = Contract(name="t", columns="A timestamp, B timestamp, C date")
    df = spark.sql("SELECT 1704067200L AS a, 12 AS b, 20240103 AS c")
    found = clean(conform(df, shape), shape, AS_OF).first()
    assert found == (datetime(2024, 1, 1), None, date(2024, 1, 3))


def test_compat_key_of_a_contract_is_made_in_frame_order(spark):
    """Cleaned values and extras as they stand in the frame; filled columns do not count."""
    df = spark.createDataFrame(
        [("x", "1/2/2024", "1,000", "g", "me")],
        "extra string, seen string, amount string, leadguid string, created_by string",
    )
    shape = contract(key="K", extras="hash", columns="LEAD_GUID string, AMOUNT decimal(10,2),"
                     " SEEN timestamp, NEVER string")
    spec = TableSpec(
        "t", FrameSource(df), "S", contract=shape, landing=Target("unused"), key_encoding="compat"
    )
    text = "x||2024-01-02 00:00:00||1000.00||g"
    assert prepare(spark, spec, NOW).first().K == hashlib.sha3_512(text.encode()).hexdigest()


def test_long_json_is_kept_by_default(spark):
    shape = Contract(name="t", columns="J string", json=["J"])
    texts = ['"' + "x" * 21_000_000 + '"', "1" * 5001, '{"' + "n" * 50_001 + '": 1}', "{bad"]
    rows = spark.createDataFrame([(t,) for t in texts], "J string")
    kept = [r.n for r in clean(rows, shape, AS_OF).selectExpr("length(J) AS n").collect()]
    assert kept == [len(texts[0]), 5001, len(texts[2]), None]


def test_default_json_check_is_pythons_without_python(spark):
    shape = Contract(name="t", columns="J string", json=["J"])
    pieces = ["{", "}", "[", "]", ",", ":", '"a"', '"\\u00e9"', '"\\x"', "-1", "01", "1.", "1e5",
              "NaN", "-Infinity", "true", "tru", " ", "\t", '"', "\\", "'a'", "\x01", "-", "0", "é"]
    texts = ["".join(p) for n in (1, 2, 3) for p in itertools.product(pieces, repeat=n)]
    texts += ['{"a":1,"a":[NaN,{"a":"b\\"c"}]}', '{"a" : 1 , "b":[]}', '{"a":1,}', "1e51e5", '"\x01"']

    def read(text):
        try:
            json.loads(text)
        except ValueError:
            return None
        return text

    rows = clean(spark.createDataFrame([(t,) for t in texts], "J string"), shape, AS_OF)
    assert "Python" not in rows._jdf.queryExecution().executedPlan().toString()
    assert [r.J for r in rows.collect()] == [read(t) for t in texts]


def test_array_types_are_compared_without_nullability(spark):
    df = spark.sql("SELECT array(1L, 2L) AS a")
    assert violations(df, spark.createDataFrame([], "a array<bigint>").schema) == []
