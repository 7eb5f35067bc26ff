"""Dirty values into types, over whole tables made dirty by their own columns."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..contracts import Contract
from ..contracts.leads import LEAD_ASSIGNMENT, lead_contracts
from ..functions import cleaning
from ..functions.names import key_name
from ..operators.clean import clean, settle_future
from ..operators.conform import conform, project
from ..plans.load import prepare
from ..plans.run import load_all
from ..plans.spec import TableSpec
from ..sinks.targets import Target
from ..sources.shared import new_folder
from ..sources.tables import FrameSource
from .registry import AS_OF, audit_sql, compat_text, load_time, query, table, wall_clock

_NUMBER = """
    CASE l_linenumber
        WHEN 1 THEN CAST(l_extendedprice AS STRING)
        WHEN 2 THEN '  ' || CAST(l_quantity AS STRING) || ' '
        WHEN 3 THEN '1,' || CAST(l_partkey AS STRING)
        WHEN 4 THEN CASE l_returnflag WHEN 'A' THEN '' WHEN 'N' THEN 'n/a' ELSE '$5' END
        WHEN 5 THEN CASE l_returnflag WHEN 'A' THEN '1e5' WHEN 'N' THEN '.5' ELSE NULL END
        WHEN 6 THEN '-' || CAST(l_tax AS STRING)
        ELSE CASE l_linestatus WHEN 'F' THEN '+' ELSE '' END || CAST(l_quantity AS STRING)
    END
"""


def _number_sql(kind: str, shown: str) -> str:
    return f"""
        SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, raw,
               CAST(CASE WHEN regexp_full_match(bare, '-?\\d+(\\.\\d+)?')
                         THEN TRY_CAST(bare AS {kind}) END AS {shown}) AS value
        FROM (SELECT *, trim(replace(raw, ',', '')) AS bare
              FROM (SELECT *, {_NUMBER} AS raw FROM lineitem) r) b
    """


def _number(spark, folder, kind, shown):
    rows = table(spark, folder, "lineitem").withColumn("raw", F.expr(_NUMBER))
    kept = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "raw")
    return rows.select(*kept, cleaning.number(F.col("raw"), kind).cast(shown).alias("value"))


@query(_number_sql("DECIMAL(38,0)", "VARCHAR"))
def parse_decimal(spark, folder):
    return _number(spark, folder, T.DecimalType(38, 0), "string")


@query(_number_sql("DOUBLE", "DOUBLE"))
def parse_double(spark, folder):
    return _number(spark, folder, T.DoubleType(), "double")


_WORD = """
    CASE o_orderpriority
        WHEN '1-URGENT' THEN CASE o_orderstatus WHEN 'F' THEN 'YES' ELSE 'True' END
        WHEN '2-HIGH' THEN CASE o_orderstatus WHEN 'F' THEN 't' ELSE '1' END
        WHEN '3-MEDIUM' THEN CASE o_orderstatus WHEN 'F' THEN 'False' ELSE 'no' END
        WHEN '4-NOT SPECIFIED' THEN CASE o_orderstatus WHEN 'F' THEN '0' ELSE NULL END
        ELSE o_orderstatus
    END
"""
_TRUE, _FALSE = "('true', '1', 'yes', 't')", "('false', '0', 'no', 'f')"


@query(
    f"""
    SELECT o_orderkey, raw,
           CASE WHEN lower(raw) IN {_TRUE} THEN TRUE
                WHEN lower(raw) IN {_FALSE} THEN FALSE END AS value
    FROM (SELECT *, {_WORD} AS raw FROM orders) r
    """
)
def parse_boolean(spark, folder):
    rows = table(spark, folder, "orders").withColumn("raw", F.expr(_WORD))
    return rows.select("o_orderkey", "raw", cleaning.truth(F.col("raw")).alias("value"))


@query(
    f"""
    SELECT o_orderkey, raw,
           CASE WHEN lower(raw) IN {_TRUE} THEN 'TRUE'
                WHEN lower(raw) IN {_FALSE} THEN 'FALSE' ELSE raw END AS value
    FROM (SELECT *, {_WORD} AS raw FROM orders) r
    """
)
def canonical_flag(spark, folder):
    rows = table(spark, folder, "orders").withColumn("raw", F.expr(_WORD))
    return rows.select("o_orderkey", "raw", cleaning.flag(F.col("raw")).alias("value"))


_SLASHED = (
    "CAST(month(ts) AS STRING) || '/' || CAST(day(ts) AS STRING)"
    " || '/' || CAST(year(ts) AS STRING)"
)
_COMPACT = (
    "CAST(year(ts) AS STRING) || lpad(CAST(month(ts) AS STRING), 2, '0')"
    " || lpad(CAST(day(ts) AS STRING), 2, '0')"
)
_CLOCK = (
    "lpad(CAST(hour(ts) AS STRING), 2, '0') || ':' || lpad(CAST(minute(ts) AS STRING), 2, '0')"
)
_MOMENT = f"""
    CASE event_type
        WHEN 'click' THEN CAST(ts AS STRING)
        WHEN 'error' THEN CASE WHEN user_id > 500 THEN 'N/A' ELSE 'pending' END
        WHEN 'purchase' THEN {_SLASHED} || ' ' || {_CLOCK}
        WHEN 'signup' THEN {_COMPACT}
        ELSE {_SLASHED}
    END
"""


@query(
    f"""
    SELECT event_id, raw,
           coalesce(TRY_CAST(CASE WHEN raw LIKE '%-%' THEN raw END AS TIMESTAMP),
                    try_strptime(raw, ['%-m/%-d/%Y %H:%M', '%-m/%-d/%Y', '%Y%m%d'])) AS value
    FROM (SELECT *, {_MOMENT} AS raw FROM events) r
    """
)
def parse_timestamp(spark, folder):
    rows = table(spark, folder, "events").withColumn("raw", F.expr(_MOMENT))
    value = cleaning.timestamp(F.col("raw"), as_of=AS_OF)
    return wall_clock(rows.select("event_id", "raw", value.alias("value")))


_DAY = f"""
    CASE event_type
        WHEN 'click' THEN CAST(CAST(ts AS DATE) AS STRING)
        WHEN 'error' THEN CASE WHEN user_id > 500 THEN '2023-13-45' ELSE 'unknown' END
        WHEN 'purchase' THEN {_SLASHED}
        WHEN 'signup' THEN {_COMPACT}
        ELSE NULL
    END
"""


@query(
    f"""
    SELECT event_id, raw,
           CAST(CASE WHEN day > DATE '2024-01-15' THEN NULL ELSE day END AS VARCHAR) AS value
    FROM (SELECT *, coalesce(TRY_CAST(CASE WHEN raw LIKE '%-%' THEN raw END AS DATE),
                             CAST(try_strptime(raw, ['%-m/%-d/%Y', '%Y%m%d']) AS DATE)) AS day
          FROM (SELECT *, {_DAY} AS raw FROM events) r) v
    """
)
def parse_date(spark, folder):
    rows = table(spark, folder, "events").withColumn("raw", F.expr(_DAY))
    value = cleaning.future(cleaning.date(F.col("raw")), "null", AS_OF, "date")
    return rows.select("event_id", "raw", value.cast("string").alias("value"))


_SHIFTED = """
    CASE o_orderstatus
        WHEN 'F' THEN o_orderdate - INTERVAL '97' YEAR
        WHEN 'O' THEN o_orderdate + INTERVAL '27' YEAR
        ELSE o_orderdate
    END
"""


@query(
    f"""
    SELECT o_orderkey, CASE WHEN year(raw) BETWEEN 1900 AND 2025 THEN raw END AS value
    FROM (SELECT *, {_SHIFTED} AS raw FROM orders) r
    """
)
def range_clean_timestamp(spark, folder):
    rows = table(spark, folder, "orders").withColumn("raw", F.expr(_SHIFTED))
    return rows.select("o_orderkey", cleaning.in_range(F.col("raw"), AS_OF).alias("value"))


_GAPPED = "CASE WHEN event_type = 'view' THEN NULL ELSE ts END"


@query(
    f"""
    SELECT event_id,
           CASE WHEN raw > TIMESTAMP '{AS_OF}' THEN TIMESTAMP '{AS_OF}' ELSE raw END AS clamped,
           CASE WHEN raw > TIMESTAMP '{AS_OF}' THEN NULL ELSE raw END AS nulled,
           raw AS kept
    FROM (SELECT *, {_GAPPED} AS raw FROM events) r
    """
)
def clamp_future(spark, folder):
    rows = table(spark, folder, "events").withColumn("raw", F.expr(_GAPPED))
    settled = {"clamped": "clamp", "nulled": "null", "kept": "keep"}
    return rows.select(
        "event_id",
        *(
            cleaning.future(F.col("raw"), policy, AS_OF, "timestamp_ntz").alias(name)
            for name, policy in settled.items()
        ),
    )


@query(
    f"""
    SELECT event_id, coalesce(raw, TIMESTAMP '{AS_OF}') AS value
    FROM (SELECT *, {_GAPPED} AS raw FROM events) r
    """
)
def audit_ts_default(spark, folder):
    rows = table(spark, folder, "events").withColumn("raw", F.expr(_GAPPED))
    value = cleaning.audit_default(F.col("raw").cast("timestamp"), AS_OF)
    return wall_clock(rows.select("event_id", value.alias("value")))


_PROPS = """
    CASE event_type
        WHEN 'click' THEN substr(props, 2)
        WHEN 'error' THEN replace(props, '"', '''')
        WHEN 'purchase' THEN '[' || props || ']'
        WHEN 'signup' THEN CASE WHEN user_id > 500 THEN '' ELSE CAST(user_id AS STRING) END
        ELSE props
    END
"""


@query(
    f"""
    SELECT event_id, CASE WHEN json_valid(raw) THEN raw END AS value
    FROM (SELECT *, {_PROPS} AS raw FROM events) r
    """
)
def json_or_null(spark, folder):
    rows = table(spark, folder, "events").withColumn("raw", F.expr(_PROPS))
    return rows.select("event_id", cleaning.valid_json(F.col("raw")).alias("value"))


EVENT = Contract(
    name="event",
    columns="EVENT_ID decimal(38,0), OCCURRED_AT timestamp, USER_ID string, PAID boolean,"
    " KIND string, AMOUNT double, PROPS string, CAMPAIGN string",
    renames={"ts": "OCCURRED_AT", "value": "AMOUNT", "event_type": "KIND"},
    json=("PROPS",),
    future={"OCCURRED_AT": "clamp"},
)


@query(
    f"""
    SELECT CAST(event_id AS VARCHAR) AS "EVENT_ID",
           CASE WHEN ts > TIMESTAMP '{AS_OF}' THEN TIMESTAMP '{AS_OF}' ELSE ts END
               AS "OCCURRED_AT",
           CAST(user_id AS VARCHAR) AS "USER_ID",
           event_type IN ('purchase') AS "PAID",
           event_type AS "KIND", round(value, 2) AS "AMOUNT",
           CASE WHEN json_valid(props) THEN props END AS "PROPS",
           CAST(NULL AS VARCHAR) AS "CAMPAIGN"
    FROM (SELECT * REPLACE ({_PROPS} AS props) FROM events) r
    """
)
def clean_by_contract(spark, folder):
    raw = table(spark, folder, "events").select(
        "event_id",
        F.col("ts").cast("string").alias("TS"),
        "user_id",
        F.when(F.col("event_type") == "purchase", "yes").otherwise("no").alias("paid"),
        "event_type",
        F.round("value", 2).cast("string").alias("value"),
        F.expr(_PROPS).alias("props"),
        F.lit("not in the contract").alias("note"),
    )
    cleaned = clean(conform(raw, EVENT), EVENT, AS_OF)
    shaped = project(settle_future(cleaned, EVENT, AS_OF), EVENT.business)
    return wall_clock(shaped.withColumn("EVENT_ID", F.col("EVENT_ID").cast("string")))


# The widest ready contract that events can fill, as SQL.
_SQL_TYPES = {"string": "VARCHAR", "timestamp": "TIMESTAMP", "double": "DOUBLE", "boolean": "BOOLEAN"}
_ASSIGNMENT = [column.split() for column in LEAD_ASSIGNMENT.split(",")]
_ASSIGNMENT_KEY = key_name("shop", "lead_assignment")
_PRICE = "CASE event_type WHEN 'click' THEN 'n/a' ELSE CAST(round(value, 2) AS STRING) END"
_FILLED = {
    "LEAD_ASSIGNMENT_GUID": "guid",
    "AGENT_CODE": "agent",
    "PURCHASE_DATE": f"CASE WHEN bought > TIMESTAMP '{AS_OF}' THEN TIMESTAMP '{AS_OF}'"
    " ELSE bought END",
    "PURCHASE_PRICE": "price",
    "STATUS": "event_type",
    "METADATA": "props",
    "IS_DELETED_SOURCE": "deleted",
}


def _assignment_sql() -> str:
    columns = ", ".join(
        f'{_FILLED[name]} AS "{name}"'
        if name in _FILLED
        else f'CAST(NULL AS {_SQL_TYPES[kind]}) AS "{name}"'
        for name, kind in _ASSIGNMENT
    )
    key = compat_text("guid", "agent", "bought", "price", "event_type", "props", "deleted", "note")
    return f"""
        SELECT sha256({key}) AS "{_ASSIGNMENT_KEY}", {columns}, {audit_sql("SHOP")}
        FROM (
            SELECT CAST(event_id AS VARCHAR) AS guid, CAST(user_id AS VARCHAR) AS agent,
                   coalesce(TRY_CAST(CASE WHEN raw LIKE '%-%' THEN raw END AS TIMESTAMP),
                            try_strptime(raw, ['%-m/%-d/%Y %H:%M', '%-m/%-d/%Y', '%Y%m%d']))
                       AS bought,
                   TRY_CAST(paid AS DOUBLE) AS price, event_type,
                   CASE WHEN json_valid(broken) THEN broken END AS props,
                   event_type = 'error' AS deleted, event_type || ' note' AS note
            FROM (SELECT *, {_MOMENT} AS raw, {_PRICE} AS paid, {_PROPS} AS broken FROM events) r
        ) c
    """


def _assignments(spark, folder):
    """Events as raw assignments."""
    return table(spark, folder, "events").select(
        F.col("event_id").alias("LeadAssignmentGuid"),
        F.col("user_id").cast("string").alias("AgentCode"),
        F.expr(_MOMENT).alias("PurchaseDate"),
        F.expr(_PRICE).alias("PurchasePrice"),
        F.col("event_type").alias("Status"),
        F.expr(_PROPS).alias("Metadata"),
        F.when(F.col("event_type") == "error", "T").otherwise("no").alias("IsDeletedSource"),
        F.concat("event_type", F.lit(" note")).alias("Note"),
    )


@query(_assignment_sql())
def lead_assignment_contract(spark, folder):
    """Events through the ready contract: every step before a write."""
    spec = TableSpec(
        name="lead_assignment",
        source=FrameSource(_assignments(spark, folder)),
        system="SHOP",
        contract=lead_contracts("shop")["lead_assignment"],
        key_encoding="compat",
        key_digest="sha2_256",
        warehouse=Target(format="noop"),
    )
    return wall_clock(prepare(spark, spec, load_time(spark)))


@query(
    f"""
    SELECT column_name, lost FROM (
        SELECT count(*) FILTER (WHERE raw IS NOT NULL AND bought IS NULL) AS "PURCHASE_DATE",
               count(*) FILTER (WHERE paid IS NOT NULL AND price IS NULL) AS "PURCHASE_PRICE",
               count(*) FILTER (WHERE broken IS NOT NULL AND NOT json_valid(broken)) AS "METADATA"
        FROM (
            SELECT *, coalesce(TRY_CAST(CASE WHEN raw LIKE '%-%' THEN raw END AS TIMESTAMP),
                            try_strptime(raw, ['%-m/%-d/%Y %H:%M', '%-m/%-d/%Y', '%Y%m%d'])) AS bought,
                   TRY_CAST(paid AS DOUBLE) AS price
            FROM (SELECT *, {_MOMENT} AS raw, {_PRICE} AS paid, {_PROPS} AS broken FROM events) r
        ) c
    ) counts UNPIVOT (lost FOR column_name IN ("PURCHASE_DATE", "PURCHASE_PRICE", "METADATA"))
    WHERE lost > 0
    """
)
def loss_report(spark, folder):
    """How many values of each column cleaning made NULL, counted while the rows are landed."""
    spec = TableSpec(
        name="lead_assignment",
        source=FrameSource(_assignments(spark, folder)),
        system="SHOP",
        contract=lead_contracts("shop")["lead_assignment"],
        key_encoding="compat",
        landing=Target(new_folder(spark, "assignments")),
        count_losses=True,
        check_content=True,
    )
    report = load_all(spark, [spec], load_time(spark))
    return report.select(F.explode("lost").alias("column_name", "lost"))
