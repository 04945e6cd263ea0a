"""Names, keys and coordinates of places."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, functions as F

# Header columns of a wide panel and their names in a long one.
PROVINCE, COUNTRY, LAT, LON = "Province/State", "Country/Region", "Lat", "Long"
LONG_NAMES = {PROVINCE: "province", COUNTRY: "country", LAT: "lat", LON: "lon"}
PLACE = ("country", "province")


def relabel(name: Column, renames: Mapping[str, str]) -> Column:
    """Replace listed names, keep all others."""
    out = name
    for old, new in renames.items():
        out = F.when(name == old, F.lit(new)).otherwise(out)
    return out


def is_unlocated(lat: Column, lon: Column) -> Column:
    """No usable coordinates: missing, not a number, or exactly (0, 0)."""
    missing = lat.isNull() | lon.isNull() | F.isnan(lat) | F.isnan(lon)
    return missing | ((lat == 0) & (lon == 0))
