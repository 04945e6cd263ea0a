"""Weekly statistics of events that arrive in files, late ones included."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators import panel as panels
from tidemark.operators.weekly import weekly_stats

LATE = "3 days"  # how far behind the newest event a row may come and still count


def arriving(spark: SparkSession, path: str, schema: str, files: int | None = None) -> DataFrame:
    """The Parquet files at ``path``, a folder or one file, as a stream, ``files`` of them at a time."""
    reader = spark.readStream.schema(schema)
    pattern = f"{path[:-1]}[{path[-1]}]"  # a plain path would have to be a folder
    return (reader.option("maxFilesPerTrigger", files) if files else reader).parquet(pattern)


def daily_counts(events: DataFrame, key: str, when: str, late: str = LATE) -> DataFrame:
    """Rows per ``key`` and ``date`` so far, of a stream; a day older than the watermark leaves the state and its late rows are dropped."""
    # the day's midnight is the event time: times without a zone have no watermark, and a day is counted whole
    days = events.withColumn("_day", F.to_date(when).cast("timestamp")).withWatermark("_day", late)
    return days.groupBy(key, "_day").agg(F.count(F.lit(1)).alias("n")).select(key, F.to_date("_day").alias("date"), "n")


def _writer(folder: str) -> Callable[[DataFrame, int], None]:
    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{folder}/batch={number}")

    return write


def follow(counts: DataFrame, folder: str) -> StreamingQuery:
    """Write what every batch changed below ``folder``, until all that is there has been read.

    A batch that is repeated after a failure overwrites its own files, and state and progress
    are kept in ``folder``, so a query that starts again goes on where it stopped and nothing counts twice.
    """
    started = counts.writeStream.outputMode("update").foreachBatch(_writer(f"{folder}/counts"))
    return started.option("checkpointLocation", f"{folder}/progress").trigger(availableNow=True).start()


def counted(spark: SparkSession, folder: str, key: str) -> DataFrame:
    """The newest count of every ``key`` and ``date`` that ``follow`` has written: counts only grow."""
    written = spark.read.parquet(f"{folder}/counts")
    return written.groupBy(key, "date").agg(F.max("n").alias("n"))


def weekly(counts: DataFrame, key: str) -> DataFrame:
    """Weekly statistics of the daily counts, as ``weekly_stats`` gives them for the day-to-day increases of a panel."""
    bounds = counts.agg(F.min("date").alias("start"), F.max("date").alias("end"))
    panel = panels.cumulative(counts, [key], bounds.select("start").scalar(), bounds.select("end").scalar())
    return weekly_stats(panels.increase(panel, [key]), key)
