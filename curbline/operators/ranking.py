"""Rankings, classes and comparisons over slices."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..functions.metrics import MAP_SHARE, RANK_SHARE, coverage, metrics_long, solid
from ..functions.scalars import change, direction, js_round, ratio
from .slices import MONTH, ZONE, add_up, outlined_mean

CLASSES = 6
RANKED = 10
BUSIEST = 12
LOW_COVERAGE = 0.9


# Tables with one row per month, or per month and metric, are broadcast: the calendar bounds
# them, and a shuffle on the month would send all zones of a month to one task.


def rank_floor(zone_slices: DataFrame) -> DataFrame:
    """(month, floor): the least observations a ranked zone must have."""
    total = zone_slices.groupBy(MONTH).agg(F.sum("trips").alias("t"))
    return total.select(MONTH, js_round(F.col("t") * F.lit(RANK_SHARE)).alias("floor"))


def map_floor(zone_slices: DataFrame, outlined: DataFrame, share: float = MAP_SHARE) -> DataFrame:
    """(month, floor): the least observations a zone must have to be coloured."""
    mean = outlined_mean(zone_slices, outlined)
    return mean.select(MONTH, js_round(F.col("mean_trips") * F.lit(share)).alias("floor"))


def metric_support(zone_slices: DataFrame, outlined: DataFrame, share: float = MAP_SHARE):
    """Every metric of every zone and month, and whether it stands above the map's floor."""
    long = metrics_long(zone_slices, [MONTH, "location_id"])
    floor = map_floor(zone_slices, outlined, share)
    return long.join(floor, MONTH).withColumn("solid", solid(F.col("floor")))


def metric_coverage(zone_slices: DataFrame) -> DataFrame:
    long = metrics_long(zone_slices, [MONTH, "location_id"]).where(~F.col("additive"))
    return long.select(MONTH, "location_id", "metric", coverage().alias("coverage"))


def _rankable(zone_slices: DataFrame) -> DataFrame:
    long = metrics_long(zone_slices, [MONTH, *ZONE])
    floor = F.broadcast(rank_floor(zone_slices))  # one row per month
    return long.join(floor, MONTH).where(solid(F.col("floor")))


def zone_ranking(zone_slices: DataFrame, top: int = RANKED) -> DataFrame:
    """Best zones per month and metric. Tasks keep only their own best rows before the shuffle."""
    order = W.partitionBy(MONTH, "metric").orderBy(F.desc("value"), F.asc("location_id"))
    ranked = _rankable(zone_slices).withColumn("rank", F.row_number().over(order))
    return ranked.where(F.col("rank") <= top).select(
        MONTH, "metric", "rank", "location_id", "zone", "borough", "value", "trips"
    )


def best_zone(zone_slices: DataFrame) -> DataFrame:
    """The best zone per month and metric, and its share of the month for totals."""
    best = _rankable(zone_slices).groupBy(MONTH, "metric", "additive").agg(
        F.max_by(
            F.struct("location_id", "zone", "value", "trips"),
            F.struct(F.col("value"), -F.col("location_id")),
        ).alias("b")
    )
    month = metrics_long(add_up(zone_slices, [MONTH]), [MONTH]).select(
        MONTH, "metric", F.col("value").alias("month_value")
    )
    share = F.when(F.col("additive"), ratio(F.col("b.value"), F.col("month_value")))
    return best.join(F.broadcast(month), [MONTH, "metric"]).select(
        MONTH, "metric", "b.*", share.alias("share")
    )


def peak_day(day_slices: DataFrame) -> DataFrame:
    """The day with the highest value per month and metric, the earliest on ties."""
    days = metrics_long(day_slices, [MONTH, "date"]).where(F.col("value").isNotNull())
    earliest = -F.coalesce(F.unix_date("date"), F.lit(0))
    peak = F.max_by(F.struct("date", "value"), F.struct(F.col("value"), earliest))
    return days.groupBy(MONTH, "metric").agg(peak.alias("p")).select(MONTH, "metric", "p.*")


def busiest_zones(zones: DataFrame, top: int = BUSIEST) -> DataFrame:
    """The rows of the zones with most trips in a month, ranked. Tasks keep only their own best rows
    before the shuffle."""
    order = W.partitionBy(MONTH).orderBy(F.desc("trips"), F.asc("location_id"))
    return zones.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)


def mean_vs_median(zone_slices: DataFrame, top: int = BUSIEST) -> DataFrame:
    """The busiest zones of a month with mean, median and coverage side by side.

    ``zone_slices`` carries the medians. It may hold the busiest zones alone.
    """
    busiest = busiest_zones(zone_slices, top)
    c = F.col

    def low(share: str):
        return F.coalesce(c(share) < LOW_COVERAGE, F.lit(False))

    covered = {
        "coverage_dist": ratio(c("dist_obs"), c("trips")),
        "coverage_dur": ratio(c("dur_obs"), c("trips")),
    }
    return busiest.withColumns(covered).select(
        MONTH, "rank", "location_id", "zone", "borough", "trips",
        ratio(c("dist_sum"), c("dist_obs")).alias("avg_distance_mi"), "median_dist",
        "coverage_dist", low("coverage_dist").alias("low_dist"),
        ratio(c("dur_sum"), c("dur_obs")).alias("avg_duration_min"), "median_dur",
        "coverage_dur", low("coverage_dur").alias("low_dur"),
        ratio(c("fare_sum"), c("fare_obs")).alias("avg_fare_usd"),
    )


def quantile_classes(
    zone_slices: DataFrame,
    outlined: DataFrame,
    share: float = MAP_SHARE,
    classes: int = CLASSES,
) -> DataFrame:
    """Colour class of every outlined zone per month and metric.

    Edge i is the value at rank floor(i * n / classes) of all zones that have the metric, and a
    zone's class is the number of edges at or below its value. ``shown`` tells the zones above the
    floor; it has no part in the edges.
    """
    drawn = zone_slices.join(outlined.select("location_id"), "location_id", "left_semi")
    known = (
        metrics_long(drawn, [MONTH, "location_id"])
        .where(solid(F.lit(0)))
        .join(F.broadcast(map_floor(zone_slices, outlined, share)), MONTH)
        .withColumn("shown", solid(F.col("floor")))
    )
    # A month and metric has one row for each zone of a map, so its zones are ranked in one window.
    group = W.partitionBy(MONTH, "metric")
    rank = F.row_number().over(group.orderBy("value", "location_id")) - 1
    counted = known.withColumns({"rank": rank, "zones": F.count(F.lit(1)).over(group)})

    def edge(i: int) -> Column:
        at = F.floor(F.lit(i) * F.col("zones") / F.lit(classes)).cast("bigint")
        return F.max(F.when(F.col("rank") == at, F.col("value"))).over(group)

    at_or_below = [(F.col("value") >= F.col(f"edge_{i}")).cast("int") for i in range(1, classes)]
    return counted.withColumns({f"edge_{i}": edge(i) for i in range(1, classes)}).select(
        MONTH, "metric", "location_id", "value", sum(at_or_below, F.lit(0)).alias("class"), "shown"
    )


def month_vs_history(day_slices: DataFrame) -> DataFrame:
    """Each month against the whole history: totals per day, means weighted by the history."""
    days = day_slices.groupBy(MONTH).agg(F.count(F.lit(1)).alias("days"))
    month = metrics_long(add_up(day_slices, [MONTH]), [MONTH]).join(days, MONTH)
    whole = day_slices.withColumn("all", F.lit(1))
    history = metrics_long(add_up(whole, ["all"]), []).select(
        "metric", F.col("value").alias("history")
    )
    total_days = day_slices.agg(F.count(F.lit(1))).scalar()
    mine = F.when(F.col("additive"), F.col("value") / F.col("days")).otherwise(F.col("value"))
    base = F.when(F.col("additive"), F.col("history") / total_days).otherwise(F.col("history"))
    return (
        month.join(history, "metric")
        .withColumns({"mine": mine, "base": base, "coverage": coverage()})
        .withColumn("delta", change(F.col("mine"), F.col("base")))
        .withColumn("direction", direction(F.col("delta")))
        .select(
            MONTH, "metric", "value", "history", "days", "mine", "base", "delta", "direction",
            "coverage",
        )
    )
