"""Every query against its SQL, over whole tables."""

import datetime
import decimal
import hashlib
import os

import duckdb
import pytest

from landfall.queries import ORACLES, QUERIES

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")
TABLES = [f.removesuffix(".parquet") for f in sorted(os.listdir(FOLDER))]


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(
            f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{FOLDER}/{name}.parquet')"
        )
    return connection


def plain(value):
    if isinstance(value, decimal.Decimal):
        return str(value.normalize())
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    return repr(value)


def rows(columns, records):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(plain(record[i]) for i in order) for record in records)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equals_sql(spark, duck, name):
    frame = QUERIES[name](spark, FOLDER)
    result = duck.execute(ORACLES[name])
    columns = [c[0] for c in result.description]
    assert sorted(frame.columns) == sorted(columns)
    expected = rows(columns, result.fetchall())
    assert expected
    assert rows(frame.columns, frame.collect()) == expected


def test_all_but_sha3_have_sql():
    assert set(QUERIES) - set(ORACLES) == {"content_key_sha3"}


def test_sha3_query_is_hashlib(spark):
    for row in QUERIES["content_key_sha3"](spark, FOLDER).toLocalIterator():
        key, *values = row
        text = "||".join(str(v) for v in values)
        assert key == hashlib.sha3_512(text.encode()).hexdigest()


def test_entry(spark):
    import __spark_entry__ as contract

    frame = contract.entry(spark)
    assert frame.count() > 0
    assert set(contract.oracle_sql()) <= set(contract.queries())
