"""Every registered query against its SQL on the smallest tables."""

import math
import os
from decimal import Decimal

import pytest

import __spark_entry__ as entry

duckdb = pytest.importorskip("duckdb")
SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    connection.execute("set timezone = 'UTC'")
    for name in TABLES:
        connection.execute(f"create view {name} as select * from '{SF}/{name}.parquet'")
    return connection


def plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return ""
    if isinstance(value, (float, Decimal)):
        return repr(float(value))
    return str(value)


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(plain(row[i]) for i in order) for row in rows)


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query(spark, duck, name):
    df = entry.queries()[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    sql = entry.oracle_sql().get(name)
    if sql is None:
        assert rows
        return
    result = duck.execute(sql)
    columns = [c[0] for c in result.description]
    assert sorted(df.columns) == sorted(columns)
    assert canonical(df.columns, rows) == canonical(columns, result.fetchall())


def test_entry(spark):
    assert entry.entry(spark).count() == 1000


def test_sql_views(spark):
    from tidemark.plans.views import register

    assert register(spark, SF) == ["ticks", "features", "labels", "predictions"]
    out = spark.sql("select count(*) from features join predictions using (product_id, seq)")
    assert out.first()[0] == 1000
