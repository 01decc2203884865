from __future__ import annotations

import os

import duckdb
import pytest

import __spark_entry__ as entry
from millrace import plans as catalog

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables are not here")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in os.listdir(SF):
        con.execute(f"CREATE VIEW {name.removesuffix('.parquet')} AS SELECT * FROM '{SF}/{name}'")
    return con


def plain(rows):
    return sorted((tuple(float(f"{v:.9g}") if isinstance(v, float) else v for v in r) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_queries_equal_their_sql(spark, duck, name):
    got = catalog.QUERIES[name](spark, SF)
    columns = sorted(got.columns)
    want = duck.sql(f"SELECT {', '.join(columns)} FROM ({catalog.ORACLES[name]})").fetchall()
    assert plain(got.select(*columns).collect()) == plain(want)


def test_entry_and_registry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(catalog.QUERIES) <= set(entry.queries())


def test_reference_violations_of_many_statuses(spark, tmp_path):
    spark.createDataFrame([(i, 1 if i else 2, f"s{i}") for i in range(12)], "o_orderkey long, o_custkey long, o_orderstatus string").write.parquet(str(tmp_path / "orders.parquet"))
    spark.createDataFrame([(1,)], "c_custkey long").write.parquet(str(tmp_path / "customer.parquet"))
    got = catalog.QUERIES["reference_violations"](spark, str(tmp_path)).collect()
    assert [(r.record_id, r.missing, r.video_id) for r in got] == [(0, 2, "s0")]
