import uuid
from collections import Counter

import pytest
from pyspark.sql.functions import spark_partition_id

from databases import embedded, put
from landfall.functions.names import QualifiedName
from landfall.plans.discover import discover
from landfall.plans.load import load_table
from landfall.plans.run import load_all
from landfall.plans.spec import TableSpec
from landfall.sinks.targets import Target
from landfall.sources.jdbc import DIALECTS, Database, JdbcTable, Split, typed_projection
from landfall.sources.tables import TableSource

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def database(spark):
    database = embedded()
    for name in ("nation", "customer"):
        put(database, spark.read.parquet(f"{FOLDER}/{name}.parquet"), name)
    return database


NATION = QualifiedName("APP", "NATION")
CUSTOMER = QualifiedName("APP", "CUSTOMER")


def test_tables(spark, database):
    assert {r.table_name for r in database.tables(spark, "APP").collect()} == {"NATION", "CUSTOMER"}
    assert database.tables(spark, "app").isEmpty()
    assert database.tables(spark, "app", any_case=True).count() == 2


def test_columns_in_order(spark, database):
    columns = database.columns(spark, CUSTOMER)
    assert [r.column_name for r in columns.collect()] == [
        "c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment",
    ]
    assert [r.data_type for r in columns.collect()][0] == "BIGINT"


def test_catalog_filters_reach_the_database(spark, database):
    text = database.columns(spark, NATION)._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(SCHEMA_NAME,APP)" in text and "EqualTo(TABLE_NAME," in text


def test_count(spark, database):
    assert database.count(spark, NATION) == 25
    assert JdbcTable(database, CUSTOMER).count(spark) == 150


def test_query(spark, database):
    found = database.query(spark, 'SELECT MAX("n_nationkey") AS m FROM APP.NATION')
    assert found.first()[0] == 24


def customers(spark):
    return Counter(map(tuple, spark.read.parquet(f"{FOLDER}/customer.parquet").collect()))


@pytest.mark.parametrize(
    "split, tasks",
    [
        (Split(), 1),
        (Split("c_custkey", 4), 4),
        (Split("c_custkey", 3, lower="1", upper="100"), 3),
        (Split(predicates=['"c_nationkey" < 10', '"c_nationkey" >= 10']), 2),
    ],
)
def test_scan(spark, database, split, tasks):
    scan = JdbcTable(database, CUSTOMER, split).scan(spark)
    assert scan.rdd.getNumPartitions() == tasks
    assert Counter(map(tuple, scan.collect())) == customers(spark)


@pytest.mark.parametrize("column", ["id", "amount", "share", "day", "seen"])
def test_split_by_any_ordered_column(spark, database, column):
    rows = spark.sql(
        "SELECT id, CAST(id / 3 AS decimal(10,2)) AS amount, id / 7 AS share,"
        " date_add(DATE '2024-01-01', CAST(id AS int)) AS day,"
        " TIMESTAMP '2024-01-01 00:00:00.5' + make_dt_interval(0, 0, CAST(id AS int)) AS seen"
        " FROM range(1, 50)"
    )
    name = put(database, rows, f"split_by_{column}")
    scan = JdbcTable(database, name, Split(column, 4)).scan(spark)
    assert scan.rdd.getNumPartitions() == 4
    assert sorted(r.id for r in scan.collect()) == list(range(1, 50))
    assert len(set(scan.select(spark_partition_id()).distinct().collect())) > 1


def test_bounds_of_an_empty_table(spark, database):
    put(database, spark.createDataFrame([], "n int"), "empty")
    scan = JdbcTable(database, QualifiedName("APP", "EMPTY"), Split("n", 4)).scan(spark)
    assert scan.count() == 0


def test_filters_and_columns_reach_the_database(spark, database):
    scan = JdbcTable(database, CUSTOMER, Split("c_custkey", 2)).scan(spark)
    text = scan.filter("c_nationkey = 3").select("c_name")._jdf.queryExecution().executedPlan()
    assert "EqualTo(c_nationkey,3)" in text.toString()
    assert "ReadSchema: struct<c_name:string>" in text.toString()


def test_typed_projection():
    columns = [("a]b", "int"), ("m", "money"), ("v", "SQL_VARIANT")]
    assert typed_projection(columns, DIALECTS["sqlserver"]) == (
        "[a]]b], CAST(NULL AS VARCHAR(50)) AS [m], CAST(NULL AS VARCHAR(50)) AS [v]"
    )
    assert typed_projection(columns[1:2], DIALECTS["postgresql"], keep_text=True) == (
        'CAST("m" AS VARCHAR(50)) AS "m"'
    )


def test_typed_scan(spark, database):
    typed = JdbcTable(database, CUSTOMER).typed(spark, unsupported={"double"})
    row = typed.scan(spark).filter("c_custkey = 1").first()
    assert row.c_acctbal is None and row.c_name
    with pytest.raises(LookupError):
        JdbcTable(database, QualifiedName("APP", "NOBODY")).typed(spark)


def test_dialects():
    assert Database("jdbc:sqlserver://host").dialect.quote("a") == "[a]"
    assert Database("jdbc:postgresql://host/db").dialect.quote('a"') == '"a"""'
    assert Database("jdbc:other:x").dialect == DIALECTS["postgresql"]


def test_from_database_to_files(spark, database, tmp_path):
    target = Target(str(tmp_path / "landed"))
    spec = TableSpec(
        "customer", JdbcTable(database, CUSTOMER, Split("c_custkey", 4)), "CRM", key="K", landing=target
    )
    assert load_table(spark, spec).landed == 150
    assert load_table(spark, spec).landed == 0


def test_discovered_tables(spark, tmp_path):
    database = embedded()
    for name in ("region", "nation", "supplier"):
        put(database, spark.read.parquet(f"{FOLDER}/{name}.parquet"), name)
    specs = discover(
        spark,
        database,
        "APP",
        "shop",
        landing=lambda name: Target(str(tmp_path / "landing" / name)),
        warehouse=lambda name: Target(str(tmp_path / "warehouse" / name)),
        typed=True,
        exclude={"NATION"},
        splits={"SUPPLIER": Split("s_suppkey", 2)},
        mode="historical",
    )
    assert [(s.name, s.key_column) for s in specs] == [
        ("REGION", "STG_SHOP_REGION_KEY"),
        ("SUPPLIER", "STG_SHOP_SUPPLIER_KEY"),
    ]
    report = load_all(spark, specs, workers=2).collect()
    assert [(r.status, r.offered, r.landed, r.loaded) for r in report] == [
        ("success", 5, 5, 5),
        ("success", 10, 10, 10),
    ]
    put(database, spark.createDataFrame([], "r_regionkey int, r_name string"), "region")
    empty = load_all(spark, specs[:1]).first()
    assert (empty.status, empty.reason) == ("skipped", "empty")
    assert specs[0].landing.count(spark) == 5


def warehouse(database, table):
    return Target(
        format="jdbc",
        options={"url": database.url, "dbtable": f"APP.{table}"},
        exists_sql=f"SELECT tablename FROM sys.systables WHERE tablename = '{table}'",
    )


def test_database_as_warehouse(spark, tmp_path):
    target = warehouse(Database(f"jdbc:derby:memory:w{uuid.uuid4().hex};create=true"), "CUSTOMER")
    source = TableSource(f"{FOLDER}/customer.parquet")

    def load(mode, rows=source):
        spec = TableSpec("customer", rows, "CRM", mode=mode, key="K", warehouse=target)
        return load_table(spark, spec)

    assert load("incremental_insert").reason == "target does not exist"
    assert load("incremental").loaded == 150
    again = load("incremental_insert")
    assert (again.warehouse_before, again.loaded, again.warehouse_after) == (150, 0, 150)
    assert load("append").warehouse_after == 300
    emptied = load("truncate_append")
    assert (emptied.warehouse_before, emptied.warehouse_after) == (0, 150)
    assert load("historical").warehouse_after == 150


def test_replacing_needs_no_way_to_ask_for_the_table(spark):
    url = f"jdbc:derby:memory:r{uuid.uuid4().hex};create=true"
    target = Target(format="jdbc", options={"url": url, "dbtable": "APP.NATION"})
    spec = TableSpec(
        "nation", TableSource(f"{FOLDER}/nation.parquet"), "CRM", mode="historical", warehouse=target
    )
    for _run in range(2):
        assert load_table(spark, spec).warehouse_after == 25


def parts_of(scan):
    return Counter(r.part for r in scan.select(spark_partition_id().alias("part")).collect())


def skewed(spark):
    """Most keys lie close together, a few far out, some are NULL; a third have one group."""
    return spark.sql(
        "SELECT id, IF(id % 50 = 7, NULL, CAST(pow(1.02, id) AS bigint)) AS far,"
        " IF(id % 3 = 0, 'hot', CONCAT('it''s ', id)) AS grp,"
        " CAST(IF(id % 3 = 0, 5, id) AS decimal(12,2)) / 4 AS amount,"
        " TIMESTAMP '2024-01-01 00:00:00.25' + make_dt_interval(0, 0, 0, pow(id, 2)) AS seen"
        " FROM range(1, 1201)"
    )


@pytest.mark.parametrize(
    "column, tie", [("far", None), ("seen", None), ("grp", "id"), ("amount", "seen")]
)
def test_parts_of_equal_depth(spark, database, column, tie):
    rows = skewed(spark)
    types = "grp VARCHAR(40)"  # text is a CLOB by default, which no database sorts
    rows.write.option("createTableColumnTypes", types).jdbc(database.url, f"depth_{column}")
    name = QualifiedName("APP", f"DEPTH_{column.upper()}")
    split = Split(column, 8, equal_depth=True, tie=tie)
    scan = JdbcTable(database, name, split).scan(spark)
    sizes = parts_of(scan)
    assert sorted(r.id for r in scan.collect()) == list(range(1, 1201))
    assert max(sizes.values()) <= 2 * 1200 / 8 and len(sizes) >= 8
    if column == "far":  # ranges of equal width put nearly all rows into one part
        assert max(parts_of(JdbcTable(database, name, Split(column, 8)).scan(spark)).values()) > 900


def test_equal_depth_of_one_value_and_of_none(spark, database):
    for label, rows in {
        "same": spark.sql("SELECT 3 AS n FROM range(20)"),
        "nulls": spark.sql("SELECT CAST(NULL AS int) AS n FROM range(20)"),
        "none": spark.createDataFrame([], "n int"),
        "single": spark.sql("SELECT 1 AS n"),
    }.items():
        name = put(database, rows, f"depth_of_{label}")
        scan = JdbcTable(database, name, Split("n", 4, equal_depth=True)).scan(spark)
        assert scan.count() == rows.count()


def test_equal_depth_asks_for_a_column():
    with pytest.raises(ValueError, match="need a column"):
        Split(partitions=4, equal_depth=True)
    with pytest.raises(ValueError, match="goes with equal_depth"):
        Split("a", 4, tie="b")
