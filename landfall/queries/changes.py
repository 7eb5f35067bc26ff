"""Rows a target does not hold yet."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.audit import AUDIT_COLUMNS, stamp
from ..operators.changes import new_rows
from ..operators.keys import add_key
from ..operators.naming import clean_names
from ..operators.snapshots import changed_rows, tally_both
from .registry import (
    AS_OF,
    LOADED_UNTIL,
    ORDERS,
    audit_sql,
    compat_text,
    query,
    table,
    wall_clock,
)

_KEYED = f"SELECT sha256({compat_text(*ORDERS)}) AS order_key, * FROM orders"


def _loaded(orders):
    return orders.filter(F.col("o_orderdate") < LOADED_UNTIL)


@query(
    f"""
    SELECT o.*, {audit_sql("ORDERS")} FROM ({_KEYED}) o
    WHERE NOT EXISTS (
        SELECT 1 FROM ({_KEYED}) held
        WHERE held.o_orderdate < TIMESTAMP '{LOADED_UNTIL}' AND held.order_key = o.order_key)
    """
)
def new_rows_by_content_key(spark, folder):
    """Name, key, stamp and sift the orders: a load without its writes."""
    orders = table(spark, folder, "orders")
    spaced = orders.toDF(*(c.replace("_", " ") for c in ORDERS))
    keyed = add_key(clean_names(spaced), "order_key", encoding="compat", digest="sha2_256")
    held = add_key(_loaded(orders), "order_key", encoding="compat", digest="sha2_256")
    stamped = stamp(keyed, "ORDERS", AS_OF)
    fresh = new_rows(stamped, held.select("order_key"), "order_key", hex_digits=64)
    return wall_clock(fresh.select("order_key", *ORDERS, *AUDIT_COLUMNS))


_CUSTOMER = "CASE WHEN o_orderstatus = 'P' THEN NULL ELSE CAST(o_custkey AS STRING) END"
_NULL_KEYS = f"""
    SELECT o.* FROM (SELECT * REPLACE ({_CUSTOMER} AS o_custkey) FROM orders) o
    WHERE NOT EXISTS (
        SELECT 1 FROM orders held
        WHERE held.o_orderdate < TIMESTAMP '1995-06-01'
          AND CAST(held.o_custkey AS STRING) = o.o_custkey)
"""


def _null_keys(spark, folder, **sizes):
    orders = table(spark, folder, "orders")
    held = orders.filter(F.col("o_orderdate") < "1995-06-01").select(
        F.col("o_custkey").cast("string").alias("o_custkey")
    )
    batch = orders.withColumn("o_custkey", F.expr(_CUSTOMER))
    return new_rows(batch, held, "o_custkey", **sizes)


@query(_NULL_KEYS)
def new_rows_null_keys(spark, folder):
    """A third of the rows have no key; all of them are new."""
    return _null_keys(spark, folder)


@query(_NULL_KEYS)
def new_rows_by_tally(spark, folder):
    """The same by the way that two large sides take."""
    return _null_keys(spark, folder, broadcast_bytes=1 << 12, hot_rows=20)


_DEDUPED = f"""
    SELECT l_orderkey, l_partkey, l_linenumber, l_quantity, l_shipdate FROM (
        SELECT *, row_number() OVER (
            PARTITION BY l_partkey
            ORDER BY l_shipdate DESC, l_orderkey, l_linenumber, l_quantity, l_extendedprice) AS n
        FROM lineitem l
        WHERE NOT EXISTS (
            SELECT 1 FROM lineitem held
            WHERE held.l_shipdate < TIMESTAMP '1995-03-01' AND held.l_partkey = l.l_partkey)) r
    WHERE n = 1
"""


def _deduped(spark, folder, **sizes):
    lines = table(spark, folder, "lineitem")
    held = lines.filter(F.col("l_shipdate") < "1995-03-01").select("l_partkey")
    order = (F.desc("l_shipdate"), "l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice")
    fresh = new_rows(lines, held, "l_partkey", dedupe=True, order_by=order, **sizes)
    return fresh.select("l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_shipdate")


@query(_DEDUPED)
def new_rows_deduped(spark, folder):
    return _deduped(spark, folder)


@query(_DEDUPED)
def new_rows_deduped_by_tally(spark, folder):
    return _deduped(spark, folder, broadcast_bytes=1 << 12, hot_rows=10)


@query(
    """
    SELECT p_partkey, p_name, p_brand, p_type, p_size, p_retailprice FROM part
    WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_quantity >= 45 AND l_partkey = p_partkey)
    """
)
def new_rows_small_batch(spark, folder):
    """Parts never sold in large lots; the fixed limit decides what is broadcast."""
    parts = table(spark, folder, "part")
    lots = table(spark, folder, "lineitem").filter(F.col("l_quantity") >= 45)
    sold = lots.select(F.col("l_partkey").alias("p_partkey"))
    return new_rows(parts, sold, "p_partkey")


# A later snapshot of the orders: some are gone, some cost more, some come twice.
_SNAPSHOT = f"""
    SELECT {", ".join(c for c in ORDERS if c != "o_totalprice")},
           CASE WHEN o_orderkey % 7 = 0 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice
    FROM orders WHERE o_orderkey % 5 <> 0
    UNION ALL SELECT {", ".join(c for c in ORDERS if c != "o_totalprice")}, o_totalprice
    FROM orders WHERE o_orderkey % 11 = 0
"""
_PLAIN = f"SELECT {', '.join(c for c in ORDERS if c != 'o_totalprice')}, o_totalprice FROM orders"


def _snapshot(spark, folder):
    orders = table(spark, folder, "orders").select(*ORDERS)
    price = F.when(F.col("o_orderkey") % 7 == 0, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice"))
    later = orders.filter(F.col("o_orderkey") % 5 != 0).withColumn("o_totalprice", price)
    later = later.unionByName(orders.filter(F.col("o_orderkey") % 11 == 0))
    keyed = lambda rows: add_key(rows, "order_key", digest="sha2_256")
    return keyed(later), keyed(orders)


@query(
    f"""
    SELECT 'new' AS change, * FROM (({_SNAPSHOT}) EXCEPT ALL ({_PLAIN})) n
    UNION ALL SELECT 'gone', * FROM (({_PLAIN}) EXCEPT ALL ({_SNAPSHOT})) g
    """
)
def snapshot_changes(spark, folder):
    """What a full snapshot adds to the orders held, and what it no longer has."""
    later, held = _snapshot(spark, folder)
    new, gone = changed_rows(later, held, "order_key")
    both = new.withColumn("change", F.lit("new")).unionByName(gone.withColumn("change", F.lit("gone")))
    return both.drop("order_key")


@query(
    f"""
    SELECT offered, held, count(*) AS row_count FROM (
        SELECT count(*) FILTER (WHERE side = 1) AS offered, count(*) FILTER (WHERE side = 2) AS held
        FROM (SELECT *, 1 AS side FROM ({_SNAPSHOT}) UNION ALL SELECT *, 2 FROM ({_PLAIN})) b
        GROUP BY {", ".join(ORDERS)}) c
    WHERE offered <> held GROUP BY offered, held
    """
)
def snapshot_tally(spark, folder):
    """How often rows occur in a snapshot and in what is held, where that differs."""
    later, held = _snapshot(spark, folder)
    tally = tally_both(later, held, "order_key").toDF("order_key", "offered", "held")
    return tally.groupBy("offered", "held").agg(F.count(F.lit(1)).alias("row_count"))
