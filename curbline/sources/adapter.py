"""Trips and zones derived from the order tables, for queries and benchmarks.

Three months of trips come out of ``lineitem`` by integer arithmetic; suppliers stand in for
zones. Every line item is one trip, so the work grows with the table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from .zones import zone_dimension


# Stated rather than inferred: a query then opens no file before it runs.
SCHEMAS = {
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT,"
    " l_quantity DOUBLE, l_extendedprice DOUBLE, l_linestatus STRING",
    "orders": "o_orderkey BIGINT, o_orderstatus STRING, o_orderdate TIMESTAMP_NTZ",
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "region": "r_regionkey INT, r_name STRING",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def trips(spark: SparkSession, sf_dir: str, delivery: bool = False) -> DataFrame:
    """``delivery=True`` adds the column telling in which delivery of the month a row came."""
    keyed = table(spark, sf_dir, "lineitem").selectExpr(
        "CASE l_orderkey % 3 WHEN 0 THEN DATE'2025-01-01' WHEN 1 THEN DATE'2025-02-01'"
        " ELSE DATE'2025-03-01' END AS source_month",
        "(l_orderkey * 31 + l_linenumber * 97 + l_partkey) % 10000 AS k",
        "(l_orderkey * 7919 + l_linenumber * 104729 + l_partkey * 13) % 2419200 AS h",
        "l_suppkey",
        "l_quantity",
        "l_extendedprice AS price",
        "CASE WHEN l_linestatus = 'F' THEN 1 ELSE 2 END AS delivery",
    )
    timed = keyed.selectExpr(
        "*",
        "CASE WHEN k BETWEEN 700 AND 709 THEN -3600L"
        "     WHEN k BETWEEN 710 AND 719 THEN 2764800L ELSE h END AS off_s",
        "CASE WHEN k < 100 THEN -60 * (k % 10)"
        "     WHEN k < 200 THEN 28800 + 60 * (k - 99) ELSE 90 + k % 3600 END AS dur_s",
    )
    start = "cast(source_month AS timestamp_ntz)"
    return timed.selectExpr(
        "source_month",
        *(["delivery"] if delivery else []),
        f"timestampadd(SECOND, off_s, {start}) AS tpep_pickup_datetime",
        f"timestampadd(SECOND, off_s + dur_s, {start}) AS tpep_dropoff_datetime",
        "l_suppkey AS PULocationID",
        "CASE WHEN k BETWEEN 200 AND 299 THEN 0D WHEN k BETWEEN 300 AND 349 THEN 1000D"
        " WHEN k BETWEEN 350 AND 399 THEN 99D ELSE l_quantity / 5 END AS trip_distance",
        "CASE WHEN k BETWEEN 400 AND 449 OR k BETWEEN 500 AND 649 THEN -price"
        " ELSE price END AS fare_amount",
        "CASE WHEN k BETWEEN 500 AND 649 THEN -price WHEN k BETWEEN 650 AND 659 THEN 0D"
        " ELSE price END AS total_amount",
    )


def zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    suppliers, nations, regions = (
        table(spark, sf_dir, n) for n in ("supplier", "nation", "region")
    )
    return zone_dimension(
        suppliers.join(nations, F.col("s_nationkey") == F.col("n_nationkey"))
        .join(regions, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            F.col("s_suppkey").alias("LocationID"),
            F.col("r_name").alias("Borough"),
            F.col("s_name").alias("Zone"),
            F.col("n_name").alias("service_zone"),
        )
    )
