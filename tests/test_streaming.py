"""Weeks over arriving events against the same weeks over the whole table."""

from datetime import datetime, timedelta

from tidemark import workload
from tidemark.streaming import weekly

SCHEMA = "ts timestamp_ntz, kind string"


def file_of(spark, path, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(path)


def day(n, hour=0):
    return datetime(2024, 1, 1) + timedelta(days=n, hours=hour)


def counts(spark, path, folder):
    stream = weekly.daily_counts(weekly.arriving(spark, path, SCHEMA, files=1), "kind", "ts", "2 days")
    weekly.follow(stream, folder).awaitTermination()
    return {(r.kind, r.date.day): r.n for r in weekly.counted(spark, folder, "kind").collect()}


def test_late_rows_and_a_second_start(spark, tmp_path):
    path, folder = str(tmp_path / "in"), str(tmp_path / "out")
    file_of(spark, path, [(day(0, 3), "a"), (day(0, 4), "a"), (day(1), "b")])
    assert counts(spark, path, folder) == {("a", 1): 2, ("b", 2): 1}
    file_of(spark, path, [(day(9), "a")])
    assert counts(spark, path, folder) == {("a", 1): 2, ("b", 2): 1, ("a", 10): 1}
    # the newest event is of day 10: day 9 may still come, day 2 may not
    file_of(spark, path, [(day(8, 5), "a"), (day(1), "b"), (day(9, 1), "a")])
    assert counts(spark, path, folder) == {("a", 1): 2, ("b", 2): 1, ("a", 9): 1, ("a", 10): 2}
    assert counts(spark, path, folder) == {("a", 1): 2, ("b", 2): 1, ("a", 9): 1, ("a", 10): 2}


def test_final_state_is_that_of_the_table(spark, root, tmp_path):
    events = spark.read.parquet(f"{root}/events.parquet")
    for n in range(4):
        events.where(f"event_id % 4 = {n}").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = weekly.daily_counts(weekly.arriving(spark, str(tmp_path / "in"), events._jdf.schema().toDDL(), files=1), "event_type", "ts", "4000 days")
    query = weekly.follow(stream, str(tmp_path / "out"))
    query.awaitTermination()
    assert len([p for p in query.recentProgress if p["numInputRows"]]) == 4
    got = weekly.weekly(weekly.counted(spark, str(tmp_path / "out"), "event_type"), "event_type")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, workload.event_weekly_stats(spark, root).collect()))
