"""Additive roll-ups of the published table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..functions.metrics import SUMS
from ..functions.scalars import is_weekend, ratio, rounded_median

MONTH = "source_month"
ZONE = ["location_id", "borough", "zone"]
EXACT = "decimal(38,4)"


def _total(x: Column) -> Column:
    """An exact sum of published values; one of 10^34 or more raises."""
    return F.coalesce(F.sum(x.cast(EXACT)), F.lit(0)).cast(EXACT)


def _weighted(mean: str, obs: str) -> Column:
    """The sum behind a published mean, rebuilt from the mean and its denominator."""
    product = F.col(mean).cast(EXACT) * F.col(obs).cast("decimal(19,0)")
    return F.coalesce(F.sum(product.cast(EXACT)), F.lit(0)).cast(EXACT)


def additive() -> list[Column]:
    return [
        F.sum("trips").alias("trips"),
        _total(F.col("yellow_revenue_usd")).alias("revenue"),
        _total(F.col("refunds_usd")).alias("refunds"),
        F.sum("distance_obs").alias("dist_obs"),
        _weighted("avg_distance_mi", "distance_obs").alias("dist_sum"),
        F.sum("duration_obs").alias("dur_obs"),
        _weighted("avg_duration_min", "duration_obs").alias("dur_sum"),
        F.sum("fare_obs").alias("fare_obs"),
        _weighted("avg_fare_usd", "fare_obs").alias("fare_sum"),
    ]


def add_up(slices: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Coarser slices out of finer ones: sums and denominators simply add."""
    return slices.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in SUMS])


def daily_medians() -> list[Column]:
    """Medians of daily medians; a zone's month holds at most one row per day."""
    return [
        rounded_median("median_distance_mi", 3, 2).alias("median_dist"),
        rounded_median("median_duration_min", 2, 2).alias("median_dur"),
    ]


def zone_slices(curated: DataFrame, medians: bool = False) -> DataFrame:
    """One unrounded slice per month and zone."""
    return curated.groupBy(MONTH, *ZONE).agg(*additive(), *(daily_medians() if medians else []))


def day_slices(curated: DataFrame) -> DataFrame:
    """One unrounded slice per month and day."""
    return curated.groupBy(MONTH, "date").agg(*additive())


def reported(slices: DataFrame) -> DataFrame:
    """Sums in the unit they are read in: whole dollars, tenths of miles and minutes."""
    whole = {c: F.round(F.col(c), 0).cast("bigint") for c in ("revenue", "refunds", "fare_sum")}
    tenth = {c: F.round(F.col(c), 1).cast("double") for c in ("dist_sum", "dur_sum")}
    return slices.withColumns({**whole, **tenth})


def zone_month(curated: DataFrame) -> DataFrame:
    return reported(zone_slices(curated))


def daily_series(curated: DataFrame) -> DataFrame:
    series = reported(day_slices(curated)).withColumn("weekend", is_weekend(F.col("date")))
    return series.orderBy(MONTH, "date")


def zone_month_median(curated: DataFrame) -> DataFrame:
    return curated.groupBy(MONTH, *ZONE).agg(*daily_medians())


def zone_index(curated: DataFrame) -> DataFrame:
    """Zones over the whole history, busiest first."""
    totals = curated.groupBy(*ZONE).agg(F.sum("trips").alias("trips"))
    return totals.orderBy(F.desc("trips"), F.asc_nulls_first("location_id"))


def zone_month_dense(zone_slices: DataFrame) -> DataFrame:
    """Every zone in every month: absent sums are zero, absent medians stay null.

    ``zone_slices`` carries the medians and is read once. A zone's months become one row, which is
    set beside the list of all months and taken apart again, so no two tables meet. The
    window without a partition has one row for each zone. Zone names and months may be null.
    """
    carried = [*SUMS, "median_dist", "median_dur"]
    zones = (
        reported(zone_slices)
        .groupBy(*ZONE)
        .agg(F.collect_list(F.struct(MONTH, *carried)).alias("own"), F.collect_set(MONTH).alias("met"))
        .withColumn("months", F.array_distinct(F.flatten(F.collect_set("met").over(W.partitionBy()))))
    )
    missing = F.array_except("months", "met")
    blank = F.transform(
        missing,
        lambda month: F.struct(
            month.alias(MONTH),
            *[
                (F.lit(0) if c in SUMS else F.lit(None)).cast(kind).alias(c)
                for c, kind in reported(zone_slices).select(*carried).dtypes
            ],
        ),
    )
    return zones.select(*ZONE, F.inline(F.concat("own", blank))).select(MONTH, *ZONE, *carried)


def month_totals(curated: DataFrame) -> DataFrame:
    def cents(name: str) -> Column:
        return F.round(_total(F.col(name)), 2).cast("double")

    totals = curated.groupBy(MONTH).agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum("trips").alias("trips"),
        cents("yellow_revenue_usd").alias("revenue"),
        cents("refunds_usd").alias("refunds"),
        cents("net_revenue_usd").alias("net_revenue"),
    )
    return totals.withColumn("refund_share", ratio(-F.col("refunds"), F.col("revenue")))


def slices(curated: DataFrame) -> DataFrame:
    """Zone-month, day, month and whole-history slices in one pass.

    ``level`` tells them apart, since a day or a zone can itself be null.
    """
    sets = [
        [F.col(MONTH), F.col("location_id")],
        [F.col(MONTH), F.col("date")],
        [F.col(MONTH)],
        [],
    ]
    # bits of grouping_id, high to low: month, zone, day; a set bit means rolled up
    names = {1: "zone_month", 2: "day", 3: "month", 7: "history"}
    level = F.create_map(*[F.lit(x) for pair in names.items() for x in pair])
    return (
        curated.groupingSets(sets, MONTH, "location_id", "date")
        .agg(F.grouping_id().cast("int").alias("gid"), *additive())
        .select(level[F.col("gid")].alias("level"), MONTH, "location_id", "date", *SUMS)
    )


def outlined_mean(zone_slices: DataFrame, outlined: DataFrame) -> DataFrame:
    """Mean trips of an outlined zone per month; zones without trips count in the mean."""
    size = outlined.agg(F.count(F.lit(1))).scalar()
    drawn = F.col("o.location_id").isNotNull()
    return (
        zone_slices.alias("s")
        .join(outlined.select("location_id").alias("o"), "location_id", "left")
        .groupBy(MONTH)
        .agg(F.coalesce(F.sum(F.when(drawn, F.col("trips"))), F.lit(0)).alias("outlined_trips"))
        .withColumn("outlined_zones", size)
        .withColumn("mean_trips", ratio(F.col("outlined_trips"), F.col("outlined_zones")))
    )


def off_map_trips(zone_slices: DataFrame, outlined: DataFrame) -> DataFrame:
    """Trips per month in location codes that no map outlines."""
    off = zone_slices.join(outlined.select("location_id"), "location_id", "left_anti")
    return off.groupBy(MONTH).agg(
        F.count(F.lit(1)).alias("codes"), F.sum("trips").alias("trips")
    )


def zone_names(curated: DataFrame, outlines: DataFrame) -> DataFrame:
    """Names for the outlines: the published name, then the outline's own, then its number.

    ``outlines`` has location_id, name and borough; one row per location_id.
    """
    named = curated.groupBy("location_id").agg(
        F.max("zone").alias("c_zone"), F.max("borough").alias("c_borough")
    )
    fallback = F.concat(F.lit("zone "), F.col("location_id").cast("string"))
    return outlines.join(named, "location_id", "left").select(
        "location_id",
        F.coalesce("c_zone", "name", fallback).alias("zone"),
        F.coalesce("c_borough", "borough", F.lit("")).alias("borough"),
    )
