"""All reports of one wide CSV file, written to a folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.functions import dates
from tidemark.functions.dates import label_of, month_of, parse_header
from tidemark.functions.places import COUNTRY, LONG_NAMES, PLACE, PROVINCE
from tidemark.operators import joins, panel as panels, reshape, wide
from tidemark.operators.weekly import weekly_stats
from tidemark.plans import clusters, monthly, trends
from tidemark.session import settle
from tidemark.sources.wide_csv import read_wide, write_csv

LISTED = 10  # length of the most / least affected lists


def monthly_table(data: DataFrame) -> DataFrame:
    """Monthly means per country, columns named by month."""
    _, days = wide.split_columns(data)
    means = monthly.mean_by_country_wide(data)
    names = {wide.bucket_name(d): label_of(parse_header(d)) for d in wide.month_ends(days)}
    return means.withColumnsRenamed(names)


def cluster_table(clustered: DataFrame, locations: DataFrame, days: list[str]) -> DataFrame:
    """One row per clustered place in the order of the slopes, one column per month."""
    labels = [f"{parse_header(d):%m/%y}" for d in wide.month_ends(days)]
    rows = joins.inner(clustered, locations, PLACE).withColumn("label", F.date_format("month", "MM/yy"))
    rows = rows.withColumn("linear_coef", F.col("slope").cast("float"))
    keys = ["rank", "province", "country", "lat", "lon", "linear_coef"]
    return reshape.to_wide(rows, keys, "label", labels, "cluster").orderBy("rank")


def write_all(spark: SparkSession, path: str, out: str) -> None:
    """Parse the file once, keep it as a table, and write every report below ``out``."""
    data = settle(read_wide(spark, path), "wide")
    headers, days = wide.split_columns(data)
    last = F.lit(parse_header(days[-1]))
    long = settle(reshape.days_to_long(data, headers).withColumnsRenamed(LONG_NAMES), "long")
    panel, locations = long.select(*PLACE, "date", "cum"), data.select(*[wide.col(h) for h in headers])
    locations = locations.withColumnsRenamed(LONG_NAMES).select(*PLACE, "lat", "lon")

    months = [label_of(parse_header(d)) for d in wide.month_ends(days)]
    table = settle(monthly_table(data), "monthly")
    write_csv(table, f"{out}/monthly_mean")
    countries = reshape.labels_of(table, wide.col(COUNTRY))
    by_month = reshape.to_long(table, [COUNTRY], "month", "mean").select(wide.col(COUNTRY).alias("country"), "month", "mean")
    write_csv(reshape.to_wide(by_month, ["month"], "country", countries, "mean"), f"{out}/monthly_mean_transposed")
    totals = panels.sum_by(panels.on_last_day(panel, last), ["country"])
    listed = settle(monthly.most_and_least(totals, "country", "cum", LISTED), "listed")
    write_csv(listed.select("side", "rank", "country", "cum"), f"{out}/most_least")
    named = [r[0] for r in listed.orderBy(F.desc("side"), "rank").select("country").collect()]
    chosen = joins.keep(by_month, listed.select("country"), ["country"])
    write_csv(reshape.to_wide(chosen, ["month"], "country", list(dict.fromkeys(named)), "mean"), f"{out}/most_least_transposed")
    write_csv(wide.level_mean(data, [COUNTRY, PROVINCE], days), f"{out}/level_mean")
    steepest = trends.steepest_daily(panel, PLACE)
    write_csv(steepest.select("rank", *PLACE, "slope").orderBy("rank"), f"{out}/steepest")
    write_csv(panels.increase(panel, PLACE), f"{out}/daily_increase")
    increases = clusters.steepest_increases(panel, PLACE).withColumn("label", dates.month_label(F.col("month")))
    write_csv(reshape.to_wide(increases, ["rank", *PLACE, "slope"], "label", months, "increase"), f"{out}/steepest_increases")
    daily = settle(trends.continent_daily(panel, locations, PLACE), "daily")
    write_csv(daily.orderBy("continent", "date"), f"{out}/continent_daily")
    write_csv(weekly_stats(daily, "continent").orderBy("continent", "week"), f"{out}/continent_weekly")
    clustered = settle(clusters.by_month(panel, PLACE), "clustered")
    write_csv(cluster_table(clustered, locations, days), f"{out}/clusters")
    write_csv(clusters.hulls(clustered.where(F.col("month") == month_of(last))), f"{out}/hulls")
    bounds = spark.createDataFrame([(parse_header(days[0]), parse_header(days[-1]))], "start date, end date")
    write_csv(panels.calendar(bounds), f"{out}/dates")
