"""Whole loads: written to fresh folders, then read back."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import functions as F

from ..operators.key_filter import KeyFilter
from ..plans.load import load_table, rekey
from ..plans.run import load_all
from ..plans.spec import TableSpec, missing_tables, select_specs
from ..sinks.targets import Target
from ..sources.high_water import HighWater
from ..sources.shared import new_folder
from ..sources.tables import FrameSource, TableSource, empty_frame
from .registry import (
    LOADED_UNTIL,
    ORDERS,
    audit_sql,
    load_time,
    query,
    strict_text,
    table,
    wall_clock,
)

_KEY = f"sha256({strict_text(*ORDERS)}) AS order_key"
_ALL = f"SELECT {_KEY}, *, {audit_sql('ORDERS')} FROM orders"
_OLD = f"o_orderdate < TIMESTAMP '{LOADED_UNTIL}'"


def _order_spec(frame, target, **options):
    options = {"mode": "incremental", **options}
    return TableSpec(
        name="orders",
        source=FrameSource(frame),
        system="ORDERS",
        key="order_key",
        key_digest="sha2_256",
        **options,
    )


def _target(spark, name="orders"):
    return Target(path=new_folder(spark, name))


def _halves(spark, folder):
    orders = table(spark, folder, "orders")
    return orders, orders.filter(F.col("o_orderdate") < LOADED_UNTIL)


def _load(spark, frame, target, **options):
    return load_table(spark, _order_spec(frame, target, landing=target, **options), load_time(spark))


@query(_ALL)
def append_result(spark, folder):
    """Old orders are there; a load of all orders appends the rest."""
    orders, old = _halves(spark, folder)
    target = _target(spark)
    _load(spark, old, target)
    _load(spark, orders, target)
    return wall_clock(target.read(spark))


@query(f"{_ALL} WHERE {_OLD}")
def overwrite_result(spark, folder):
    orders, old = _halves(spark, folder)
    target = _target(spark)
    _load(spark, orders, target, mode="historical")
    _load(spark, old, target, mode="historical")
    return wall_clock(target.read(spark))


@query(f"{_ALL} WHERE {_OLD}")
def truncate_append_result(spark, folder):
    orders, old = _halves(spark, folder)
    target = _target(spark)
    _load(spark, orders, target, mode="historical")
    _load(spark, old, target, mode="truncate_append")
    return wall_clock(target.read(spark))


@query(f"{_ALL} UNION ALL {_ALL} WHERE {_OLD}")
def plain_append_result(spark, folder):
    """``append`` asks no questions: the old orders are there twice."""
    orders, old = _halves(spark, folder)
    target = _target(spark)
    _load(spark, orders, target, mode="historical")
    _load(spark, old, target, mode="append")
    return wall_clock(target.read(spark))


@query(_ALL)
def idempotent_rerun(spark, folder):
    orders, _ = _halves(spark, folder)
    target = _target(spark)
    for _run in range(2):
        _load(spark, orders, target)
    return wall_clock(target.read(spark))


@query(_ALL)
def warehouse_follows_landing(spark, folder):
    """The warehouse missed the first load; the second makes up for it."""
    orders, old = _halves(spark, folder)
    landing, warehouse = _target(spark), _target(spark, "warehouse")
    _load(spark, old, landing)
    load_table(
        spark,
        _order_spec(orders, None, landing=landing, warehouse=warehouse),
        load_time(spark),
    )
    return wall_clock(warehouse.read(spark))


@query(_ALL)
def warehouse_catches_up(spark, folder):
    """Landing and warehouse hold equally many rows, other ones; keys tell what is missing."""
    orders, _ = _halves(spark, folder)
    landing, warehouse = _target(spark), _target(spark, "warehouse")
    third = F.pmod("o_orderkey", F.lit(4))
    _load(spark, orders.filter(third == 0), landing)
    _load(spark, orders.filter(third == 1), warehouse)
    load_table(
        spark,
        _order_spec(orders.filter(third != 1), None, landing=landing, warehouse=warehouse),
        load_time(spark),
    )
    return wall_clock(warehouse.read(spark))


@query(
    f"""
    SELECT 'orders' AS "table", 'success' AS status, count(*) AS offered,
           count(*) FILTER (WHERE {_OLD}) AS landing_before,
           count(*) FILTER (WHERE NOT ({_OLD})) AS landed, count(*) AS landing_after
    FROM orders
    """
)
def reconcile_counts(spark, folder):
    orders, old = _halves(spark, folder)
    target = _target(spark)
    _load(spark, old, target)
    report = load_all(spark, [_order_spec(orders, None, landing=target)], load_time(spark))
    counts = ("offered", "landing_before", "landed", "landing_after")
    return report.select("table", "status", *counts)


@query(
    """
    SELECT "table", status, reason, CAST(offered AS VARCHAR) AS offered,
           CAST(landed AS VARCHAR) AS landed FROM (
        SELECT 'customer' AS "table", 'success' AS status, CAST(NULL AS VARCHAR) AS reason,
               count(*) AS offered, count(*) AS landed FROM customer
        UNION ALL SELECT 'supplier', 'success', NULL, count(*), count(*) FROM supplier
        UNION ALL SELECT 'embeddings', 'failed', 'TypeError: embedding: nested=''reject'''
               || ' does not hash array<float>', NULL, NULL
        UNION ALL SELECT 'nobody', 'skipped', 'empty', 0, NULL
        UNION ALL SELECT 'labels', 'skipped', 'target does not exist', count(*), NULL FROM labels
        UNION ALL SELECT 'region', 'skipped', 'excluded', NULL, NULL
        UNION ALL SELECT 'partsupp', 'missing', 'expected, not found', NULL, NULL) r
    """
)
def run_report(spark, folder):
    """Seven tables with seven fates, four at a time."""
    home = new_folder(spark, "landing")

    def spec(name, **options):
        options = {"mode": "historical", "source": TableSource(f"{folder}/{name}.parquet")} | options
        return TableSpec(
            name=name, system="SHOP", key=f"{name}_key", landing=Target(f"{home}/{name}"), **options
        )

    nobody = empty_frame(spark, table(spark, folder, "customer").schema)
    specs = [
        spec("customer"),
        spec("supplier", mode="incremental"),
        # Arrays have no text to hash unless the spec says how.
        spec("embeddings"),
        spec("nobody", source=FrameSource(nobody)),
        spec("labels", mode="append"),
        spec("region"),
    ]
    chosen, left_out = select_specs(specs, exclude={"region"})
    report = load_all(
        spark,
        chosen,
        load_time(spark),
        workers=4,
        left_out=left_out,
        expected=("customer", "partsupp"),
    )
    counts = (F.col(c).cast("string").alias(c) for c in ("offered", "landed"))
    return report.select("table", "status", "reason", *counts)


@query(
    """
    SELECT table_name FROM (VALUES ('part'), ('building'), ('machinery')) wanted(table_name)
    WHERE NOT EXISTS (SELECT 1 FROM customer WHERE lower(c_mktsegment) = table_name)
    """
)
def expected_tables(spark, folder):
    """Which of the wanted names the market segments do not list."""
    segments = table(spark, folder, "customer").select(F.lower("c_mktsegment").alias("table_name"))
    return missing_tables(spark, ("part", "building", "machinery"), segments)


@query(_ALL)
def rekeyed_then_loaded(spark, folder):
    """Old orders were landed under the first version of the encoding; no order comes twice."""
    orders, old = _halves(spark, folder)
    target = Target(path=new_folder(spark, "orders"), publish="switch")
    _load(spark, old, target, key_version=1)
    rekey(spark, _order_spec(orders, None, landing=target), target)
    _load(spark, orders, target)
    return wall_clock(target.read(spark))


@query(
    f"""
    SELECT 'orders' AS "table", 'failed' AS status,
           'KeyMismatch: held keys are strict/1/sha2_256/reject, the load''s '
             || 'strict/2/sha2_256/reject: re-key the table' AS reason, count(*) AS held
    FROM orders WHERE {_OLD}
    """
)
def keys_of_another_making(spark, folder):
    """A load is refused where the target's keys were made in another way."""
    orders, old = _halves(spark, folder)
    target = _target(spark)
    _load(spark, old, target, key_version=1)
    report = load_all(spark, [_order_spec(orders, None, landing=target)], load_time(spark))
    held = target.read(spark).agg(F.count(F.lit(1)).alias("held"))
    return report.select("table", "status", "reason").join(held)


@query(f"{_ALL} WHERE {_OLD}")
def switched_result(spark, folder):
    """Replaced twice by a switch, once as a whole and once by dropping all rows first."""
    orders, old = _halves(spark, folder)
    target = Target(path=new_folder(spark, "orders"), publish="switch")
    _load(spark, orders, target, mode="historical")
    _load(spark, orders.limit(3), target, mode="historical")
    _load(spark, old, target, mode="truncate_append")
    return wall_clock(target.read(spark))


@query(_ALL)
def append_by_key_filter(spark, folder):
    """Three loads that ask a kept filter, the last two bringing rows that are held already."""
    orders, old = _halves(spark, folder)
    home = new_folder(spark, "orders")
    target = Target(path=f"{home}/rows", key_filter=KeyFilter(f"{home}/keys"))
    _load(spark, old.filter(F.pmod("o_orderkey", F.lit(2)) == 0), target)
    _load(spark, old, target)
    _load(spark, orders, target)
    return wall_clock(target.read(spark))


_NARROW = "SELECT o_orderkey, o_custkey, o_orderdate FROM orders WHERE o_custkey % 3 = 0"


@query(
    f"""
    SELECT sha256({strict_text("o_orderkey", "o_custkey", "o_orderdate")}) AS order_key,
           o_orderkey, o_custkey, o_orderdate, CAST(NULL AS VARCHAR) AS o_orderstatus,
           CAST(NULL AS DOUBLE) AS o_totalprice, CAST(NULL AS VARCHAR) AS o_orderpriority
    FROM ({_NARROW})
    UNION ALL
    SELECT {_KEY}, o_orderkey, o_custkey, o_orderdate, o_orderstatus, o_totalprice, o_orderpriority
    FROM orders
    """
)
def widened_append(spark, folder):
    """Some orders came with fewer columns and narrower customers; then all come whole."""
    orders = table(spark, folder, "orders")
    narrow = orders.filter("o_custkey % 3 = 0").select(
        "o_orderkey", F.col("o_custkey").cast("int"), "o_orderdate"
    )
    target = Target(path=new_folder(spark, "orders"), widen=True)
    _load(spark, narrow, target)
    _load(spark, narrow.withColumn("o_custkey", F.col("o_custkey").cast("bigint")), target)
    _load(spark, orders, target)
    return wall_clock(target.read(spark).select("order_key", *ORDERS))


@query(
    f"""
    WITH second AS (
        SELECT * REPLACE (o_totalprice + 1 AS o_totalprice) FROM orders
        WHERE o_orderdate >= TIMESTAMP '{LOADED_UNTIL}' - INTERVAL 30 DAY
    )
    SELECT {_KEY}, * FROM orders WHERE {_OLD}
    UNION ALL SELECT {_KEY}, * FROM second
    """
)
def high_water_rerun(spark, folder):
    """Every price has changed since the first load; the second reads the last month and later."""
    orders, old = _halves(spark, folder)
    target, log = _target(spark), _target(spark, "log")
    water = HighWater("o_orderdate", timedelta(days=30))
    first = spark.sql(f"SELECT TIMESTAMP '{LOADED_UNTIL}' AS t").first().t.astimezone()
    changed = orders.withColumn("o_totalprice", F.col("o_totalprice") + 1)
    for rows, now in ((old, first), (changed, load_time(spark))):
        spec = _order_spec(rows, target, landing=target, high_water=water)
        load_all(spark, [spec], now, policy="fail_fast", run_log=log)
    return wall_clock(target.read(spark).select("order_key", *ORDERS))
