"""Panels derived from order tables: places are (country, segment), counts are orders."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tidemark.functions.places import PLACE
from tidemark.operators.panel import cumulative

DOMINANT = 1_000_000  # rows of a key from which a join deals it to several tasks
MAIN_SEGMENT = "HOUSEHOLD"  # rows of this segment stand for the country itself


# The columns read, with their types, so that no job looks for them.
SCHEMAS = {
    "orders": "o_custkey BIGINT, o_orderdate TIMESTAMP_NTZ",
    "customer": "c_custkey BIGINT, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING",
    "nation": "n_nationkey INT, n_name STRING",
    "supplier": "s_suppkey BIGINT, s_nationkey INT",
    "lineitem": "l_suppkey BIGINT, l_shipdate TIMESTAMP_NTZ",
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING",
}


def table(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{root}/{name}.parquet")


def province() -> Column:
    return F.when(F.col("c_mktsegment") != MAIN_SEGMENT, F.col("c_mktsegment"))


def day_range(facts: DataFrame, when: str) -> DataFrame:
    """One row with the first and the last day of ``facts``; of the raw column, which file statistics can answer."""
    return facts.agg(F.min(when).cast("date").alias("start"), F.max(when).cast("date").alias("end"))


def _panel(counts: DataFrame, keys: Sequence[str], bounds: DataFrame) -> DataFrame:
    return cumulative(counts, keys, bounds.select("start").scalar(), bounds.select("end").scalar())


def order_range(spark: SparkSession, root: str) -> DataFrame:
    return day_range(table(spark, root, "orders"), "o_orderdate")


def order_counts(spark: SparkSession, root: str) -> DataFrame:
    """Orders per place and day.

    The join is left to Spark: customers are broadcast only below its size
    threshold, otherwise the adaptive planner splits a customer that dominates.
    Rows are combined before the shuffle to (nation, segment, day), and the
    names are attached to the few combined rows.
    """
    orders = table(spark, root, "orders").select("o_custkey", F.col("o_orderdate").cast("date").alias("date"))
    customers = table(spark, root, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    nations = table(spark, root, "nation").select("n_nationkey", F.col("n_name").alias("country"))
    per_day = (
        orders.join(customers, F.col("o_custkey") == F.col("c_custkey"))
        .groupBy("c_nationkey", "c_mktsegment", "date")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return per_day.join(nations, F.col("c_nationkey") == F.col("n_nationkey")).select(
        "country", province().alias("province"), "date", "n"
    )


def last_order_day(spark: SparkSession, root: str) -> Column:
    return order_range(spark, root).select("end").scalar()


def order_panel(spark: SparkSession, root: str) -> DataFrame:
    """Cumulative orders per place on every day of the order range."""
    return _panel(order_counts(spark, root), PLACE, order_range(spark, root))


def sparse_panel(spark: SparkSession, root: str) -> DataFrame:
    """Cumulative orders per place on the days that have orders only: places skip days and months."""
    by_day = Window.partitionBy(*PLACE).orderBy("date").rowsBetween(Window.unboundedPreceding, 0)
    return order_counts(spark, root).select(*PLACE, "date", F.sum("n").over(by_day).alias("cum"))


def shipment_panel(spark: SparkSession, root: str) -> DataFrame:
    """Cumulative shipments per country of the supplier on every day of the shipping range."""
    items = table(spark, root, "lineitem")
    shipped = items.select("l_suppkey", F.col("l_shipdate").cast("date").alias("date"))
    suppliers = table(spark, root, "supplier")
    nations = table(spark, root, "nation").select("n_nationkey", F.col("n_name").alias("country"))
    per_day = (
        shipped.join(suppliers, F.col("l_suppkey") == F.col("s_suppkey"))
        .groupBy("s_nationkey", "date")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    counts = per_day.join(nations, F.col("s_nationkey") == F.col("n_nationkey")).select("country", "date", "n")
    return _panel(counts, ["country"], day_range(items, "l_shipdate"))


def event_counts(spark: SparkSession, root: str, keys: Sequence[str]) -> DataFrame:
    """Events per user, type or both and day."""
    events = table(spark, root, "events")
    return events.groupBy(*keys, F.col("ts").cast("date").alias("date")).agg(F.count(F.lit(1)).alias("n"))


def event_range(spark: SparkSession, root: str) -> DataFrame:
    return day_range(table(spark, root, "events"), "ts")


def event_panel(spark: SparkSession, root: str, keys: Sequence[str]) -> DataFrame:
    """Cumulative events per user, type or both on every day of the event range."""
    return _panel(event_counts(spark, root, keys), keys, event_range(spark, root))


def customer_locations(spark: SparkSession, root: str) -> DataFrame:
    """Coordinates derived from the customer key; some customers have none.

    A negative balance hides the latitude, every fiftieth key sits at (0, 0).
    """
    key = F.col("c_custkey")
    at_origin = F.pmod(key, F.lit(50)) == 0
    lat = (F.pmod(key * 37, F.lit(1700)).cast("double") / 10) - 85 + 0.05
    lon = (F.pmod(key * 73, F.lit(3600)).cast("double") / 10) - 180 + 0.05
    return table(spark, root, "customer").select(
        "c_custkey",
        "c_nationkey",
        "c_mktsegment",
        F.when(F.col("c_acctbal") >= 0, F.when(at_origin, 0.0).otherwise(lat)).alias("lat"),
        F.when(at_origin, 0.0).otherwise(lon).alias("lon"),
    )


def place_locations(spark: SparkSession, root: str) -> DataFrame:
    """A place lies where its customer with the lowest key lies."""
    first = (
        customer_locations(spark, root)
        .groupBy("c_nationkey", "c_mktsegment")
        .agg(F.min_by("lat", "c_custkey").alias("lat"), F.min_by("lon", "c_custkey").alias("lon"))
    )
    nations = table(spark, root, "nation").select("n_nationkey", F.col("n_name").alias("country"))
    return first.join(nations, F.col("c_nationkey") == F.col("n_nationkey")).select(
        "country", province().alias("province"), "lat", "lon"
    )
