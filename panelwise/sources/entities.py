"""The literal place dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Places of the daily feed with coordinates and climate zone.
PLACES = (
    ("nairobi", -1.29, 36.82, "Highland"),
    ("mombasa", -4.04, 39.67, "Coastal"),
    ("kisumu", -0.10, 34.76, "Lakeside"),
    ("nakuru", -0.30, 36.07, "Highland"),
    ("eldoret", 0.52, 35.27, "Highland"),
    ("garissa", -0.47, 39.64, "Semi-arid"),
    ("kakamega", 0.28, 34.75, "Western"),
    ("machakos", -1.52, 37.26, "Eastern"),
)


def places(spark: SparkSession) -> DataFrame:
    """Eight rows: (city, lat, lon, zone)."""
    return spark.createDataFrame(list(PLACES), "city string, lat double, lon double, zone string")
