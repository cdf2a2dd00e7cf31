"""Every registered query against its SQL at the smallest scale."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from probelake.catalog.tables import SCHEMAS
from tools.check import TABLES, as_bag

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no driver tables here")


@pytest.fixture(scope="module")
def sql():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query(spark, sql, name):
    df = entry.queries()[name](spark, SF)
    got = as_bag(df.columns, [tuple(r) for r in df.collect()])
    text = entry.oracle_sql().get(name)
    if text is None:
        assert sum(got[0].values()) > 0
        return
    result = sql.execute(text)
    want = as_bag([d[0] for d in result.description], result.fetchall())
    assert got == want


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_lookups_of_all_customers_are_written_and_read_back(spark, tmp_path):
    """Two of its columns differ in case alone."""
    tables = {
        "customer": [(i, f"c{i}", i % 2, 1.0, "X") for i in range(6)], "nation": [(0, "ALGERIA", 0), (1, "BRAZIL", 1)],
        "region": [(0, "AFRICA"), (1, "AMERICA")],
    }
    for name, data in tables.items():
        spark.createDataFrame(data, SCHEMAS[name]).write.parquet(f"{tmp_path}/{name}.parquet")
    found = entry.queries()
    try:
        found["lookup_files"](spark, str(tmp_path)).write.parquet(f"{tmp_path}/out")
        back = spark.read.parquet(f"{tmp_path}/out")
        assert back.columns == ["c_custkey", "sid", "provName", "cityName", "PROVNAME"]
        assert sorted(map(tuple, back.collect()))[1] == (1, "1", "BRAZIL", "AMERICA", "BRAZIL") and back.count() == 6
    finally:
        found["parquet_dim"](spark, str(tmp_path))
    assert spark.conf.get("spark.sql.caseSensitive") == "false"
