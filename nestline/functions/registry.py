"""The feature functions by name, for use in SQL text."""

from __future__ import annotations

from pyspark.sql import SparkSession

from nestline.config import EARTH_RADIUS_MILES, RATIO_FLOOR

# SQL functions are expanded into the query: no Python runs and nothing is hidden from Catalyst
_FUNCTIONS = {
    "deviation_ratio(usual DOUBLE, actual DOUBLE) RETURNS FLOAT":
        f"CASE WHEN usual IS NOT NULL AND actual IS NOT NULL AND actual <> 0 "
        f"THEN CAST(greatest(try_divide(usual, actual), {RATIO_FLOOR}D) AS FLOAT) END",
    "deviation_diff(usual DOUBLE, actual DOUBLE) RETURNS FLOAT":
        "CAST(actual - usual AS FLOAT)",
    "haversine_part(lat1 DOUBLE, lon1 DOUBLE, lat2 DOUBLE, lon2 DOUBLE) RETURNS DOUBLE":
        "pow(sin(radians(lat2 - lat1) / 2), 2) + cos(radians(lat1)) * cos(radians(lat2)) "
        "* pow(sin(radians(lon2 - lon1) / 2), 2)",
    "haversine_miles(lat1 DOUBLE, lon1 DOUBLE, lat2 DOUBLE, lon2 DOUBLE) RETURNS FLOAT":
        f"CAST(2 * {EARTH_RADIUS_MILES}D * atan2(sqrt(haversine_part(lat1, lon1, lat2, lon2)), "
        f"sqrt(greatest(0D, 1 - haversine_part(lat1, lon1, lat2, lon2)))) AS FLOAT)",
}


def register_functions(spark: SparkSession) -> None:
    for signature, body in _FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {signature} RETURN {body}")
