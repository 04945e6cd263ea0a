"""Snapshots of one panel whose headers grow, and sinks that are written again."""

from datetime import date

import pytest

from tidemark.sources import wide_csv

HEAD = "Province/State,Country/Region,Lat,Long"


def write(path, *lines):
    path.write_text("\n".join([f"{HEAD},{lines[0]}", *lines[1:]]) + "\n")
    return str(path)


def test_the_latest_snapshot_wins(spark, tmp_path):
    files = [
        write(tmp_path / "a.csv", "1/30/20,1/31/20", ",A,1,2,5,7", "X,B,0,0,1,1", "Y,C,0,0,3,3"),
        write(tmp_path / "b.csv", "1/31/20,2/1/20", ",A,1,2,8,9", "X,B,0,0,,2"),
        write(tmp_path / "c.csv", "2/2/20", ",A,1,2,11"),
    ]
    got = {(r.province, r.country, r.date): r.cum for r in wide_csv.read_snapshots(spark, files).collect()}
    assert got == {
        (None, "A", date(2020, 1, 30)): 5, (None, "A", date(2020, 1, 31)): 8, (None, "A", date(2020, 2, 1)): 9, (None, "A", date(2020, 2, 2)): 11,
        ("X", "B", date(2020, 1, 30)): 1, ("X", "B", date(2020, 1, 31)): 1, ("X", "B", date(2020, 2, 1)): 2,
        ("Y", "C", date(2020, 1, 30)): 3, ("Y", "C", date(2020, 1, 31)): 3,
    }
    with pytest.raises(ValueError, match="snapshot"):
        wide_csv.read_snapshots(spark, [])


def test_a_report_is_written_again_and_a_half_written_one_is_not_read(spark, tmp_path):
    path = str(tmp_path / "report")
    for n in (5, 3):
        wide_csv.write_csv(spark.range(n), path)
        assert wide_csv.read_report(spark, path, "id long").count() == n
    (tmp_path / "report" / "_SUCCESS").unlink()
    with pytest.raises(ValueError, match="not been written to its end"):
        wide_csv.read_report(spark, path, "id long")
    wide_csv.write_csv(spark.range(4), path)
    assert wide_csv.read_report(spark, path, "id long").count() == 4
