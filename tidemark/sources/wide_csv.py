"""Wide panels as CSV: four header columns and one column per day."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tidemark.functions.dates import parse_header
from tidemark.functions.places import LAT, LON, LONG_NAMES, PLACE
from tidemark.operators.reshape import days_to_long
from tidemark.operators.wide import drop_matching, split_columns

# Fixed value: names that a saved row index gets when it is read back.
INDEX_COLUMNS = r"Unnamed|_c\d+$"


def _type(name: str) -> T.DataType:
    if name in (LAT, LON):
        return T.DoubleType()
    return T.DecimalType(18, 0) if parse_header(name) else T.StringType()


def read_wide(spark: SparkSession, path: str) -> DataFrame:
    """Read a wide panel; only its first line is looked at to learn the columns.

    No cell is dropped: ``3.0`` is 3, a fraction is rounded to the nearest whole number, an
    empty cell is null, and a cell that is no number is an error, as is a part file whose
    header has other columns or another order.
    """
    names = spark.read.option("header", True).csv(path).columns
    schema = T.StructType([T.StructField(n, _type(n)) for n in names])
    strict = {"header": True, "mode": "FAILFAST", "enforceSchema": False}
    data = drop_matching(spark.read.schema(schema).options(**strict).csv(path), INDEX_COLUMNS)
    return data.to(T.StructType([T.StructField(n, T.LongType() if parse_header(n) else _type(n)) for n in data.columns]))


def read_snapshots(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """One long panel (``province``, ``country``, ``date``, ``cum``) of several snapshots, oldest first.

    Each file has its own day columns. A place and day has the level of the latest snapshot
    that holds it: a day that a later header lacks stays, an empty cell replaces nothing.
    """
    if not paths:
        raise ValueError("a panel needs at least one snapshot")
    parts = []
    for number, path in enumerate(paths):
        data = read_wide(spark, path)
        headers, _ = split_columns(data)
        long = days_to_long(data, headers).withColumnsRenamed(LONG_NAMES)
        parts.append(long.select(*PLACE, "date", "cum", F.lit(number).alias("snapshot")).where("cum IS NOT NULL"))
    rows = reduce(DataFrame.unionByName, parts)
    return rows.groupBy(*PLACE, "date").agg(F.max_by("cum", "snapshot").alias("cum"))


def write_csv(df: DataFrame, path: str) -> None:
    """Write a result with its header, one file per partition, in place of what an earlier run left there.

    Spark marks the folder with a ``_SUCCESS`` file once all parts are there.
    """
    df.write.mode("overwrite").option("header", True).csv(path)


def read_report(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A result that ``write_csv`` wrote to its end; one that a run left half written is an error."""
    mark = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    if not mark.getFileSystem(spark._jsc.hadoopConfiguration()).exists(mark):
        raise ValueError(f"{path} has not been written to its end")
    return spark.read.schema(schema).option("header", True).csv(path)


def preview(df: DataFrame, rows: int = 5) -> DataFrame:
    """The first rows, for a look at a result."""
    return df.limit(rows)
