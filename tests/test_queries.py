import pytest
from oracle import assert_same

import lodeseam.plans.goldens  # noqa: F401
from lodeseam.plans.queries import ORACLE, QUERIES

DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_same_rows_as_duckdb(spark, name):
    assert_same(QUERIES[name](spark, DIR), ORACLE[name], DIR)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_runs(spark, name):
    assert QUERIES[name](spark, DIR).count() > 0


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())


def test_first_of_equal_decisions_in_the_table(spark, tmp_path):
    """Two lines of one number: the first file's goes first, also where Spark reads a larger file before it."""
    import duckdb

    columns = "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double"
    parts = {"a": [(1, 1, 0, 1, 10.0), (1, 2, 2, 1, 10.0), (1, 2, 0, 1, 10.0)], "b": [(1, 1, 2, 1, 10.0), *((i, 10, i, 1, 10.0) for i in range(5000))]}
    (tmp_path / "lineitem.parquet").mkdir()
    for name, rows in parts.items():
        spark.createDataFrame(rows, columns).toPandas().astype({"l_linenumber": "int32"}).to_parquet(tmp_path / "lineitem.parquet" / f"{name}.parquet", index=False)
    got = [tuple(r) for r in QUERIES["first_decision_counts"](spark, str(tmp_path)).collect()]
    con = duckdb.connect(config={"threads": 1})  # more threads leave it open which of them is first
    con.sql(f"CREATE VIEW lineitem AS SELECT * FROM '{tmp_path}/lineitem.parquet/*.parquet'")
    assert got == con.sql(ORACLE["first_decision_counts"]).fetchall() == [(1, 0, 1, 1)]
