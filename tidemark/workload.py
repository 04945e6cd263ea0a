"""The analyses bound to the order tables, one DataFrame per name.

Days and months leave as text, a missing province as an empty one.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.functions import dates
from tidemark.functions.places import COUNTRY, LAT, LON, LONG_NAMES, PLACE, PROVINCE, is_unlocated, relabel
from tidemark.functions.regions import ELSEWHERE, UNLOCATED, continent, rings
from tidemark.functions.sql import CONTINENT_FUNCTION, register_continent
from tidemark.operators import joins, monthly as buckets, panel as panels, polygons, reshape, wide
from tidemark.operators.ranking import top
from tidemark.operators.scaling import min_max
from tidemark.operators.weekly import weekly_stats
from tidemark.plans import appended, clusters, monthly, trends
from tidemark.session import new_folder, settle
from tidemark.sources import tables, wide_csv
from tidemark.streaming import weekly as arriving

RENAMES = {"NATION_7": "NATION_8"}  # a label folded into another one
KEPT = ("NATION_3", "NATION_11", "NATION_19", "NATION_99")  # a list as a caller gives it
REPORT = 10  # length of the most / least affected lists


def _province() -> F.Column:
    return F.coalesce("province", F.lit("")).alias("province")


def _place() -> list:
    return ["country", _province()]


def _month() -> F.Column:
    return dates.year_month(F.col("month")).alias("month")


def _day() -> F.Column:
    return dates.iso_day(F.col("date")).alias("day")


def _slope() -> F.Column:
    return F.col("slope").cast("float").alias("slope")


def _range(spark: SparkSession, root: str) -> tuple:
    """First and last day as values: wide tables need their column names."""
    return tuple(tables.order_range(spark, root).first())


# --- panel and calendar


def panel_cumulative(spark: SparkSession, root: str) -> DataFrame:
    return tables.order_panel(spark, root).select(*_place(), _day(), "cum")


def calendar_days(spark: SparkSession, root: str) -> DataFrame:
    return panels.calendar(tables.order_range(spark, root)).select("idx", _day())


def header_names(spark: SparkSession, root: str) -> DataFrame:
    days = panels.calendar(tables.order_range(spark, root))
    named = days.select("date", dates.day_header(F.col("date")).alias("header"))
    parsed = named.withColumn("parsed", dates.header_to_date(F.col("header")))
    bucket = parsed.withColumn("bucket", dates.bucket_header(F.col("parsed")))
    return bucket.select(
        "header",
        "bucket",
        dates.bucket_days(F.col("bucket")).alias("bucket_days"),
        dates.dashed_day(F.col("header")).alias("dashed"),
        dates.iso_day(F.col("parsed")).alias("day"),
        dates.year_month(F.col("parsed")).alias("month"),
        dates.month_label(F.col("parsed")).alias("label"),
        dates.iso_day(dates.header_to_date(F.date_format("date", "M/d/yyyy"))).alias("long_day"),
    )


def months_present(spark: SparkSession, root: str) -> DataFrame:
    days = panels.calendar(tables.order_range(spark, root))
    return buckets.months(days).select(_month(), dates.month_label(F.col("month")).alias("label"))


# --- months


def monthly_mean_by_country(spark: SparkSession, root: str) -> DataFrame:
    means = monthly.mean_by_country(tables.order_panel(spark, root), PLACE)
    return means.select("country", _month(), "mean")


def monthly_mean_ragged(spark: SparkSession, root: str) -> DataFrame:
    """Means per country of a panel whose places skip days and months."""
    means = monthly.mean_by_country(tables.sparse_panel(spark, root), PLACE)
    return means.select("country", _month(), "mean")


def monthly_mean_by_place(spark: SparkSession, root: str) -> DataFrame:
    return monthly.mean(tables.order_panel(spark, root), PLACE).select(*_place(), _month(), "mean")


def monthly_increase_by_place(spark: SparkSession, root: str) -> DataFrame:
    return monthly.increase(tables.order_panel(spark, root), PLACE).select(*_place(), _month(), "increase")


def monthly_level_mean(spark: SparkSession, root: str) -> DataFrame:
    return buckets.level_mean(tables.order_panel(spark, root), PLACE).select(*_place(), _month(), "level_mean")


def monthly_mean_wide(spark: SparkSession, root: str) -> DataFrame:
    labels = [dates.label_of(m) for m in dates.months_between(*_range(spark, root))]
    means = monthly.mean_by_country(tables.order_panel(spark, root), PLACE)
    labelled = means.select("country", dates.month_label(F.col("month")).alias("label"), "mean")
    return reshape.to_wide(labelled, ["country"], "label", labels, "mean")


def monthly_mean_transposed(spark: SparkSession, root: str) -> DataFrame:
    """Months as rows and countries as columns; the names, which become columns, come from the nation table."""
    countries = reshape.labels_of(tables.table(spark, root, "nation"), F.col("n_name"))
    means = monthly.mean_by_country(tables.order_panel(spark, root), PLACE)
    labelled = means.select(dates.month_label(F.col("month")).alias("label"), "country", "mean")
    return reshape.to_wide(labelled, ["label"], "country", countries, "mean")


def most_least_affected(spark: SparkSession, root: str) -> DataFrame:
    panel = tables.order_panel(spark, root)
    last = panels.on_last_day(panel, tables.last_order_day(spark, root))
    totals = panels.sum_by(last, ["country"])
    report = monthly.most_and_least(totals, "country", "cum", REPORT)
    means = monthly.mean_by_country(panel, PLACE)
    both = joins.inner(means, report, ["country"])
    return both.select("side", "rank", "country", F.col("cum").alias("total"), _month(), "mean")


def most_least_transposed(spark: SparkSession, root: str) -> DataFrame:
    """Months as rows, the most and the least affected as columns named by side and rank."""
    report = most_least_affected(spark, root).select(F.concat_ws("_", "side", "rank").alias("place"), "month", "mean")
    month = F.to_date(F.concat("month", F.lit("-01")))
    labelled = report.select(dates.month_label(month).alias("label"), "place", "mean")
    places = [f"{side}_{i}" for side in ("most", "least") for i in range(REPORT)]
    return reshape.to_wide(labelled, ["label"], "place", places, "mean")


def kept_entities(spark: SparkSession, root: str) -> DataFrame:
    """Monthly means of the countries that a caller lists; names without data give no row."""
    panel = tables.order_panel(spark, root)
    kept = joins.keep(panel, spark.createDataFrame([(name,) for name in KEPT], "country string"), ["country"])
    return monthly.mean_by_country(kept, PLACE).select("country", _month(), "mean")


def total_by_country(spark: SparkSession, root: str) -> DataFrame:
    last = panels.on_last_day(tables.order_panel(spark, root), tables.last_order_day(spark, root))
    return panels.sum_by(last, ["country"]).select("country", F.col("cum").alias("total"))


def total_by_province(spark: SparkSession, root: str) -> DataFrame:
    totals = panels.sum_by(tables.order_panel(spark, root), ["province", "date"])
    return totals.select(_province(), _day(), F.col("cum").alias("total"))


def relabel_entities(spark: SparkSession, root: str) -> DataFrame:
    panel = tables.order_panel(spark, root).withColumn("country", relabel(F.col("country"), RENAMES))
    totals = panels.sum_by(panel, ["country", "date"])
    return totals.select("country", _day(), F.col("cum").alias("total"))


# --- wide tables


def _wide_panel(spark: SparkSession, root: str) -> DataFrame:
    """The panel with one column per day behind the four header columns."""
    start, end = _range(spark, root)
    series = reshape.day_series(tables.order_panel(spark, root), PLACE, start, end)
    both = joins.inner(tables.place_locations(spark, root), series, PLACE)
    named = both.withColumnsRenamed({name: header for header, name in LONG_NAMES.items()})
    return reshape.days_to_wide(named, start, end)


def _wide_place() -> list:
    return [wide.col(COUNTRY).alias("country"), F.coalesce(wide.col(PROVINCE), F.lit("")).alias("province")]


def wide_roundtrip(spark: SparkSession, root: str) -> DataFrame:
    long = reshape.days_to_long(_wide_panel(spark, root), [PROVINCE, COUNTRY, LAT, LON])
    return long.select(*_wide_place(), _day(), "cum")


def wide_level_mean(spark: SparkSession, root: str) -> DataFrame:
    data = _wide_panel(spark, root)
    means = wide.level_mean(data, [COUNTRY, PROVINCE], wide.split_columns(data)[1])
    return reshape.to_long(means, [COUNTRY, PROVINCE], "month", "level_mean").select(
        *_wide_place(), "month", "level_mean"
    )


def wide_slopes(spark: SparkSession, root: str) -> DataFrame:
    data = _wide_panel(spark, root)
    headers, days = wide.split_columns(data)
    increases = wide.daily_increase(data, headers, days)
    return increases.select(*_wide_place(), wide.slope(days[:-1]).cast("float").alias("slope"))


def wide_csv_monthly_mean(spark: SparkSession, root: str) -> DataFrame:
    """Wide panel to CSV and back, then the monthly means per country."""
    path = new_folder(spark, "wide-csv")
    indexed = _wide_panel(spark, root).select(F.monotonically_increasing_id().alias("Unnamed: 0"), "*")
    wide_csv.write_csv(indexed, path)
    means = monthly.mean_by_country_wide(wide_csv.read_wide(spark, path))
    long = reshape.to_long(means, [COUNTRY], "bucket", "mean")
    return long.select(wide.col(COUNTRY).alias("country"), "bucket", "mean")


def snapshot_panel(spark: SparkSession, root: str) -> DataFrame:
    """Three snapshots of the panel, with other first and last days and other levels where they overlap, read as one."""
    start, end = _range(spark, root)
    third = (end - start) / 3
    cuts = [(start, start + third), (start + third / 2, start + 2 * third), (start + 1.5 * third, end)]
    panel = settle(tables.order_panel(spark, root), "panel")
    paths = []
    for number, (first, last) in enumerate(cuts):
        level = F.col("cum") + (len(cuts) - 1 - number)  # later corrected
        part = panel.where(F.col("date").between(first, last)).withColumn("cum", level)
        both = joins.inner(tables.place_locations(spark, root), reshape.day_series(part, PLACE, first, last), PLACE)
        named = both.withColumnsRenamed({name: header for header, name in LONG_NAMES.items()})
        paths.append(new_folder(spark, "snapshot"))
        wide_csv.write_csv(reshape.days_to_wide(named, first, last), paths[-1])
    return wide_csv.read_snapshots(spark, paths).select(*_place(), _day(), "cum")


def written_totals(spark: SparkSession, root: str) -> DataFrame:
    """Totals per country written as a report twice, the second in place of the first, and read back."""
    path = new_folder(spark, "totals")
    for totals in (total_by_country(spark, root).limit(1), total_by_country(spark, root)):
        wide_csv.write_csv(totals, path)
    return wide_csv.read_report(spark, path, "country string, total long")


# --- trends and continents


def daily_increase(spark: SparkSession, root: str) -> DataFrame:
    return panels.increase(tables.order_panel(spark, root), PLACE).select(*_place(), _day(), "inc")


def trend_slope_top100(spark: SparkSession, root: str) -> DataFrame:
    return trends.steepest_daily(tables.order_panel(spark, root), PLACE).select("rank", *_place(), _slope())


def _appended(spark: SparkSession, root: str, batches: int = 3) -> list[DataFrame]:
    """The panel of orders as it arrives: batches of days, oldest first, from one written table."""
    first, last = _range(spark, root)
    panel = settle(tables.order_panel(spark, root), "arriving")
    batch = F.date_diff("date", F.lit(first)) * batches / ((last - first).days + 1)
    return [panel.where(F.floor(batch) == i) for i in range(batches)]


def appended_slope_top100(spark: SparkSession, root: str) -> DataFrame:
    """``trend_slope_top100`` with days that came in batches, each read once."""
    first, *others = _appended(spark, root)
    state = settle(appended.known(first, PLACE), "known")
    for later in others:
        state = settle(appended.merged(state, appended.known(later, PLACE), PLACE), "known")
    report = top(appended.slopes(state, PLACE), "slope", PLACE, trends.STEEPEST_DAILY)
    return report.select("rank", *_place(), _slope())


def appended_daily_increase(spark: SparkSession, root: str) -> DataFrame:
    """``daily_increase`` with days that came in batches: each adds its own increases."""
    first, *others = _appended(spark, root)
    state, found = settle(appended.known(first, PLACE), "known"), panels.increase(first, PLACE)
    for later in others:
        found = found.unionByName(appended.increases(state, later, PLACE))
        state = settle(appended.merged(state, appended.known(later, PLACE), PLACE), "known")
    return found.select(*_place(), _day(), "inc")


def continent_label(spark: SparkSession, root: str) -> DataFrame:
    label = continent("lat", "lon").alias("continent")
    return tables.customer_locations(spark, root).select("c_custkey", label)


def continent_label_corrected(spark: SparkSession, root: str) -> DataFrame:
    label = continent("lat", "lon", corrected=True).alias("continent")
    return tables.customer_locations(spark, root).select("c_custkey", label)


def continent_label_sql(spark: SparkSession, root: str) -> DataFrame:
    """The label as a function of SQL text."""
    register_continent(spark)
    text = f"SELECT c_custkey, {CONTINENT_FUNCTION}(lat, lon) AS continent FROM {{located}}"
    return spark.sql(text, located=tables.customer_locations(spark, root))


def outlines(spark: SparkSession, corrected: bool = False) -> DataFrame:
    """The outlines as a table of vertices, labels in order of priority."""
    found = rings(corrected)
    rank = {name: i for i, name in enumerate(dict.fromkeys(name for name, _ in found))}
    rows = [(n, name, rank[name], i, float(a), float(b)) for n, (name, ring) in enumerate(found) for i, (a, b) in enumerate(ring)]
    return spark.createDataFrame(rows, "ring long, label string, priority int, seq int, lat double, lon double")


def continent_label_table(spark: SparkSession, root: str) -> DataFrame:
    """The label by a join with the outlines as rows."""
    located = tables.customer_locations(spark, root)
    apart = is_unlocated(F.col("lat"), F.col("lon"))
    found = polygons.label(located.where(~apart), outlines(spark), "c_custkey")
    named = found.select("c_custkey", F.coalesce("label", F.lit(ELSEWHERE)).alias("continent"))
    return named.union(located.where(apart).select("c_custkey", F.lit(UNLOCATED)))


def _continent_daily(spark: SparkSession, root: str) -> DataFrame:
    return trends.continent_daily(tables.order_panel(spark, root), tables.place_locations(spark, root), PLACE)


def continent_daily_total(spark: SparkSession, root: str) -> DataFrame:
    return _continent_daily(spark, root).select("continent", _day(), "inc")


def continent_weekly_stats(spark: SparkSession, root: str) -> DataFrame:
    return weekly_stats(_continent_daily(spark, root), "continent")


def continent_weekly_min_size(spark: SparkSession, root: str) -> DataFrame:
    weeks = weekly_stats(_continent_daily(spark, root), "continent")
    return weeks.select("continent", "week", F.abs("min").alias("min_size"))


# --- clusters


def top50_monthly_mean(spark: SparkSession, root: str) -> DataFrame:
    means = clusters.steepest_means(tables.order_panel(spark, root), PLACE)
    return means.select("rank", *_place(), _slope(), _month(), "mean")


def top50_monthly_increase(spark: SparkSession, root: str) -> DataFrame:
    increases = clusters.steepest_increases(tables.order_panel(spark, root), PLACE)
    return increases.select("rank", *_place(), _slope(), _month(), "increase")


def minmax_scaled(spark: SparkSession, root: str) -> DataFrame:
    means = clusters.steepest_means(tables.order_panel(spark, root), PLACE)
    return min_max(means, "month", "mean", bounded=True).select(*_place(), _month(), "scaled")


def _clustered(spark: SparkSession, root: str) -> DataFrame:
    return clusters.by_month(tables.order_panel(spark, root), PLACE)


def kmeans_by_month(spark: SparkSession, root: str) -> DataFrame:
    return _clustered(spark, root).select("rank", *_place(), _month(), "cluster")


def kmeans_few_places(spark: SparkSession, root: str) -> DataFrame:
    """Fewer places than the usual report."""
    clustered = clusters.by_month(tables.order_panel(spark, root), PLACE, 20)
    return clustered.select("rank", *_place(), _month(), "cluster")


def kmeans_many_places(spark: SparkSession, root: str) -> DataFrame:
    """Far more places than the usual report."""
    clustered = clusters.by_month(tables.order_panel(spark, root), PLACE, 90)
    return clustered.select("rank", *_place(), _month(), "cluster")


def cluster_matrix(spark: SparkSession, root: str) -> DataFrame:
    labels = [f"{m:%m/%y}" for m in dates.months_between(*_range(spark, root))]
    rows = _clustered(spark, root).select(
        "rank", *_place(), _slope(), F.date_format("month", "MM/yy").alias("label"), "cluster"
    )
    return reshape.to_wide(rows, ["rank", "country", "province", "slope"], "label", labels, "cluster")


def cluster_text(spark: SparkSession, root: str) -> DataFrame:
    """The text of each month next to the clusters read back from it."""
    rows = clusters.parsed(clusters.texts(_clustered(spark, root)))
    return rows.select(_month(), "cluster_id", "rank", "cluster")


def cluster_hull(spark: SparkSession, root: str) -> DataFrame:
    """Hulls of the latest month only."""
    clustered = _clustered(spark, root)
    latest = dates.month_of(tables.last_order_day(spark, root))
    hulls = clusters.hulls(clustered.where(F.col("month") == latest))
    return hulls.select("cluster", "vertex", "slope", "mean")


def cluster_hull_by_month(spark: SparkSession, root: str) -> DataFrame:
    return clusters.hulls(_clustered(spark, root)).select(_month(), "cluster", "vertex", "slope", "mean")


# --- the same questions on other tables


def shipment_monthly_mean(spark: SparkSession, root: str) -> DataFrame:
    return monthly.mean(tables.shipment_panel(spark, root), ["country"]).select("country", _month(), "mean")


def event_trend_top100(spark: SparkSession, root: str) -> DataFrame:
    keys = ["event_type", "user_id"]
    bounds = tables.event_range(spark, root)
    start, end = bounds.select("start").scalar(), bounds.select("end").scalar()
    slopes = trends.slopes_of_counts(tables.event_counts(spark, root, keys), keys, start, end)
    return top(slopes, "slope", keys, trends.STEEPEST_DAILY).select("rank", *keys, _slope())


def event_weekly_stats(spark: SparkSession, root: str) -> DataFrame:
    return weekly_stats(panels.increase(tables.event_panel(spark, root, ["event_type"]), ["event_type"]), "event_type")


def event_weekly_stream(spark: SparkSession, root: str) -> DataFrame:
    """The weeks of events that arrive as files; the stored table is replayed in any order, so no row is late."""
    folder = new_folder(spark, "events")
    events = arriving.arriving(spark, f"{root}/events.parquet", tables.SCHEMAS["events"])
    arriving.follow(arriving.daily_counts(events, "event_type", "ts", "36500 days"), folder).awaitTermination()
    return arriving.weekly(arriving.counted(spark, folder, "event_type"), "event_type")


# --- joins


def outer_join_headers(spark: SparkSession, root: str) -> DataFrame:
    last = panels.on_last_day(tables.order_panel(spark, root), tables.last_order_day(spark, root))
    joined = joins.outer(tables.place_locations(spark, root), last.select(*PLACE, F.col("cum").alias("total")), PLACE)
    return joined.select(*_place(), "lat", "lon", "total")


def outer_join_users(spark: SparkSession, root: str) -> DataFrame:
    """Every event with the segment of its user, and every customer without events."""
    events = tables.table(spark, root, "events").select(F.col("user_id").alias("party"), "event_id", "event_type")
    customers = tables.table(spark, root, "customer").select(F.col("c_custkey").alias("party"), F.col("c_mktsegment").alias("segment"))
    return joins.outer_split(events, customers, ["party"], most=tables.DOMINANT).select("party", "event_id", "event_type", "segment")


QUERIES: Sequence[Callable[[SparkSession, str], DataFrame]] = (
    panel_cumulative,
    calendar_days,
    header_names,
    months_present,
    monthly_mean_by_country,
    monthly_mean_ragged,
    monthly_mean_by_place,
    monthly_increase_by_place,
    monthly_level_mean,
    monthly_mean_wide,
    monthly_mean_transposed,
    most_least_affected,
    most_least_transposed,
    kept_entities,
    total_by_country,
    total_by_province,
    relabel_entities,
    wide_roundtrip,
    wide_level_mean,
    wide_slopes,
    wide_csv_monthly_mean,
    snapshot_panel,
    written_totals,
    daily_increase,
    trend_slope_top100,
    appended_slope_top100,
    appended_daily_increase,
    continent_label,
    continent_label_corrected,
    continent_label_sql,
    continent_label_table,
    continent_daily_total,
    continent_weekly_stats,
    continent_weekly_min_size,
    top50_monthly_mean,
    top50_monthly_increase,
    minmax_scaled,
    kmeans_by_month,
    kmeans_few_places,
    kmeans_many_places,
    cluster_matrix,
    cluster_text,
    cluster_hull,
    cluster_hull_by_month,
    outer_join_headers,
    outer_join_users,
    shipment_monthly_mean,
    event_trend_top100,
    event_weekly_stats,
    event_weekly_stream,
)
