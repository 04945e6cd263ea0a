"""From a wide file to all reports, with numbers checked against plain pandas."""

import glob
import random
from datetime import date, timedelta

import pandas as pd
import pytest

from tidemark.functions.dates import header_of
from tidemark.plans.reports import write_all


@pytest.fixture(scope="module")
def panel_file(tmp_path_factory):
    rng = random.Random(9)
    days = [header_of(date(2020, 1, 22) + timedelta(i)) for i in range(100)]
    rows = []
    for place in range(60):
        level, levels = 0, []
        for i in range(len(days)):
            level += rng.randint(0, 3 + place * i // 40)
            levels.append(level)
        province = None if place % 4 == 0 else f"P{place}"
        rows.append([province, f"C{place // 4}", rng.uniform(-60, 80), rng.uniform(-179, 179), *levels])
    frame = pd.DataFrame(rows, columns=["Province/State", "Country/Region", "Lat", "Long", *days])
    path = tmp_path_factory.mktemp("reports") / "data.csv"
    frame.to_csv(path)
    return str(path), frame, days


def read(folder):
    parts = [pd.read_csv(p) for p in sorted(glob.glob(f"{folder}/*.csv"))]
    return pd.concat(parts, ignore_index=True)


def test_write_all(spark, panel_file, tmp_path):
    path, frame, days = panel_file
    out = str(tmp_path / "out")
    write_all(spark, path, out)

    ends = ["1/31/20", "2/29/20", "3/31/20", days[-1]]
    totals = frame.groupby("Country/Region")[days].sum()
    expected = pd.DataFrame({"1/20": totals[ends[0]].astype(float)})
    for before, end in zip(ends, ends[1:]):
        day = int(end.split("/")[1])
        expected[f"{end.split('/')[0]}/20"] = (totals[end] - totals[before]) / day
    got = read(f"{out}/monthly_mean").set_index("Country/Region").sort_index()
    pd.testing.assert_frame_equal(got, expected.sort_index(), check_names=False)

    listed = read(f"{out}/most_least")
    most = totals[days[-1]].sort_values(ascending=False).head(10)
    assert list(listed[listed.side == "most"].sort_values("rank")["cum"]) == list(most)

    daily, weekly = read(f"{out}/continent_daily"), read(f"{out}/continent_weekly")
    assert daily["inc"].sum() == int((frame[days[-1]] - frame[days[0]]).sum())
    assert set(weekly["week"]) == set(range(1, 16))
    assert (weekly["min"] <= weekly["mean"]).all() and (weekly["mean"] <= weekly["max"]).all()

    turned = read(f"{out}/monthly_mean_transposed").set_index("month")
    pd.testing.assert_frame_equal(turned.T.sort_index().sort_index(axis=1), expected.sort_index().sort_index(axis=1), check_names=False)
    chosen = read(f"{out}/most_least_transposed").set_index("month")
    assert set(chosen.columns) == set(listed["country"])
    pd.testing.assert_frame_equal(chosen.sort_index(axis=1).sort_index(), turned[sorted(chosen.columns)].sort_index())
    steepest = read(f"{out}/steepest")
    assert len(steepest) == 60 and steepest["slope"].is_monotonic_decreasing
    increases = read(f"{out}/daily_increase")
    assert increases["inc"].sum() == daily["inc"].sum() and len(increases) == 60 * 99
    assert len(read(f"{out}/level_mean")) == 60
    assert len(read(f"{out}/steepest_increases")) == 50

    clusters = read(f"{out}/clusters")
    assert list(clusters.columns[-4:]) == ["01/20", "02/20", "03/20", "04/20"] and len(clusters) == 50
    assert clusters["linear_coef"].is_monotonic_decreasing
    assert clusters[clusters.columns[-4:]].isin([0, 1, 2, 3]).all().all()
    assert set(read(f"{out}/hulls")["cluster"]) <= {0, 1, 2, 3}
    assert len(read(f"{out}/dates")) == 100
