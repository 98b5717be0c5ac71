"""The zone dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

CSV_SCHEMA = "LocationID INT, Borough STRING, Zone STRING, service_zone STRING"


def zone_dimension(raw: DataFrame) -> DataFrame:
    return raw.select(
        F.col("LocationID").cast("int").alias("location_id"),
        F.col("Borough").alias("borough"),
        F.col("Zone").alias("zone"),
        "service_zone",
    )


def read_zones(spark: SparkSession, path: str) -> DataFrame:
    """``N/A`` in the file is an ordinary word, not a missing value."""
    return zone_dimension(spark.read.csv(path, header=True, schema=CSV_SCHEMA))
