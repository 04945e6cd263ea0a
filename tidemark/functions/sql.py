"""Functions callable from SQL text, as native expressions rather than UDFs."""

from __future__ import annotations

from pyspark.sql import SparkSession

from tidemark.functions.regions import ELSEWHERE, UNLOCATED, inside, rings

CONTINENT_FUNCTION = "continentLabeler"  # fixed value: the name queries call it by


def register_continent(spark: SparkSession, name: str = CONTINENT_FUNCTION, corrected: bool = False) -> None:
    """Make ``name(lat, lon)`` return the continent in this session's SQL."""
    tests = "\n".join(f"WHEN {inside('lat', 'lon', ring)} THEN '{label}'" for label, ring in rings(corrected))
    missing = "lat IS NULL OR lon IS NULL OR isnan(lat) OR isnan(lon) OR (lat = 0 AND lon = 0)"
    spark.sql(
        f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(lat DOUBLE, lon DOUBLE) RETURNS STRING "
        f"RETURN CASE WHEN {missing} THEN '{UNLOCATED}'\n{tests}\nELSE '{ELSEWHERE}' END"
    )
