"""Every registered query against its SQL twin, and invariants of its plans."""

import duckdb
import pytest

import __spark_entry__ as registry
import oracle
from conftest import DATA
from tidemark import workload

TABLES = [p.stem for p in sorted((DATA / "sf0.001").glob("*.parquet"))]


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(repr(row[i]) for i in order) for row in rows)


@pytest.fixture(scope="module")
def duck(root):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{root}/{name}.parquet'")
    return connection


@pytest.mark.parametrize("name", sorted(q.__name__ for q in workload.QUERIES))
def test_query_equals_sql(spark, duck, root, name):
    df = registry.queries()[name](spark, root)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    result = duck.execute(registry.oracle_sql()[name])
    columns = [d[0] for d in result.description]
    assert sorted(columns) == sorted(df.columns)
    assert got == rows_of(columns, result.fetchall())
    assert got


def test_every_query_has_sql():
    names = {q.__name__ for q in workload.QUERIES}
    assert names == set(oracle.oracle_sql()) and names <= set(registry.queries()) & set(registry.oracle_sql())


def test_entry(spark):
    assert registry.entry(spark).columns == ["country", "month", "mean"]


def test_same_result_with_one_and_many_partitions(spark, root):
    names = ["trend_slope_top100", "continent_weekly_stats", "kmeans_by_month"]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    found = []
    for partitions in ("1", "13"):
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        try:
            found.append([sorted(map(tuple, getattr(workload, n)(spark, root).collect())) for n in names])
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", before)
    assert found[0] == found[1]
