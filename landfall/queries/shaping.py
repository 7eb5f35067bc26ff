"""Names, contracts, audit columns."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..contracts import Contract
from ..operators.audit import stamp
from ..operators.conform import conform, null_unsupported, project, violations
from ..operators.naming import clean_names
from .registry import AS_OF, audit_sql, query, table, wall_clock


@query(
    "SELECT c_custkey AS customer_key, c_name AS full_name, c_nationkey AS nation_key_,"
    " c_acctbal AS acct_bal_usd, c_mktsegment AS segment FROM customer"
)
def clean_names_strict(spark, folder):
    odd = ("customer key", "full-name", "nation  key?", "acct.bal ($usd", "segment")
    return clean_names(table(spark, folder, "customer").toDF(*odd), "strict")


@query(
    'SELECT s_suppkey AS supplier_key, s_name AS "full-name", s_nationkey AS nation_key,'
    ' s_acctbal AS "acct_bal__$" FROM supplier'
)
def clean_names_light(spark, folder):
    odd = ("supplier key", "full-name", "nation.key", "acct.bal .$")
    return clean_names(table(spark, folder, "supplier").toDF(*odd), "light")


@query(
    'SELECT c_custkey AS "CUSTOMER_ID", c_name AS "FULL_NAME",'
    ' CAST(NULL AS DECIMAL(38,0)) AS "CREDIT_LIMIT", c_mktsegment AS "MARKET_SEGMENT",'
    ' CAST(NULL AS DATE) AS "SIGNUP_DATE", c_acctbal AS "BALANCE" FROM customer'
)
def conform_rename_fill(spark, folder):
    contract = Contract(
        name="customer",
        columns="CUSTOMER_ID bigint, FULL_NAME string, CREDIT_LIMIT decimal(38,0),"
        " MARKET_SEGMENT string, SIGNUP_DATE date, BALANCE double",
        renames={"c_acctbal": "BALANCE"},
    )
    raw = table(spark, folder, "customer").toDF(
        "CustomerId", "FullName", "NationKey", "C_ACCTBAL", "marketsegment"
    )
    return project(conform(raw, contract), contract.business)


@query(f"SELECT *, {audit_sql('SUPPLIES')} FROM supplier")
def audit_stamp(spark, folder):
    return wall_clock(stamp(table(spark, folder, "supplier"), "SUPPLIES", AS_OF))


@query(
    "SELECT p_partkey, p_name, p_brand, CAST(NULL AS VARCHAR) AS p_type, p_size,"
    " CAST(NULL AS VARCHAR) AS p_retailprice FROM part"
)
def unsupported_to_null(spark, folder):
    declared = {"p_partkey": "bigint", "p_type": "sql_variant", "p_retailprice": "MONEY"}
    return null_unsupported(table(spark, folder, "part"), declared)


@query(
    "SELECT p_partkey, p_name, p_brand, p_type, p_size,"
    " CAST(p_retailprice AS VARCHAR) AS p_retailprice FROM part"
)
def unsupported_as_text(spark, folder):
    declared = {"p_retailprice": "money"}
    return null_unsupported(table(spark, folder, "part"), declared, keep_text=True)


@query(
    """
    SELECT v.*, (SELECT count(*) FROM customer) AS row_count
    FROM (VALUES
        ('c_custkey', 'type', 'decimal(38,0)', 'bigint'),
        ('c_acctbal', 'type', 'decimal(12,2)', 'double'),
        ('c_phone', 'missing', 'string', NULL)
    ) v("column", problem, expected, found)
    """
)
def contract_violations(spark, folder):
    customer = table(spark, folder, "customer")
    contract = Contract(
        name="customer",
        columns="c_custkey decimal(38,0), c_name string, c_acctbal decimal(12,2), c_phone string",
    )
    faults = [
        F.struct(*(F.lit(v).cast("string").alias(n) for n, v in fault._asdict().items()))
        for fault in violations(customer, contract.business)
    ]
    counted = customer.agg(F.count(F.lit(1)).alias("row_count"))
    return counted.select(F.inline(F.array(*faults)), "row_count")
