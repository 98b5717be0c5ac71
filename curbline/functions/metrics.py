"""Derived metrics over additive slices.

A slice carries sums and their denominators; every mean is formed here, at the end, so that
one formula serves a zone, a day, a month and the whole history.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from .scalars import ratio

# fixed values: the additive columns of a slice
SUMS = [
    "trips",
    "revenue",
    "refunds",
    "dist_obs",
    "dist_sum",
    "dur_obs",
    "dur_sum",
    "fare_obs",
    "fare_sum",
]

RANK_SHARE = 0.001  # of the month's trips
MAP_SHARE = 0.01  # of the mean outlined zone's trips


@dataclass(frozen=True)
class Metric:
    name: str
    group: str  # totals, means or ratios
    value: Column
    obs: Column | None  # the weakest denominator behind the value; totals have none

    @property
    def additive(self) -> bool:
        return self.group == "totals"


def metrics() -> list[Metric]:
    c = F.col
    net = (c("revenue") + c("refunds")).cast("double")
    miles = ratio(c("dist_sum"), c("dist_obs"))
    minutes = ratio(c("dur_sum"), c("dur_obs"))
    fare = ratio(c("fare_sum"), c("fare_obs"))
    speed = F.when((c("dist_obs") > 0) & (c("dur_sum") > 0), ratio(miles, minutes, 60.0))
    per_mile = F.when((c("fare_obs") > 0) & (c("dist_sum") > 0), ratio(fare, miles))
    return [
        Metric("trips", "totals", c("trips").cast("double"), None),
        Metric("revenue", "totals", net, None),
        Metric("revenue_per_trip", "means", ratio(net, c("trips")), c("trips")),
        Metric("avg_fare_usd", "means", fare, c("fare_obs")),
        Metric("avg_distance_mi", "means", miles, c("dist_obs")),
        Metric("avg_duration_min", "means", minutes, c("dur_obs")),
        Metric("speed_mph", "ratios", speed, F.least(c("dist_obs"), c("dur_obs"))),
        Metric("fare_per_mile", "ratios", per_mile, F.least(c("fare_obs"), c("dist_obs"))),
    ]


def with_metrics(slices: DataFrame) -> DataFrame:
    """One column per metric."""
    return slices.withColumns({f"m_{m.name}": m.value for m in metrics()})


def metrics_long(slices: DataFrame, keys: list[str]) -> DataFrame:
    """One row per slice and metric: (keys, trips, metric, additive, value, obs)."""
    entries = [
        F.struct(
            F.lit(m.name).alias("metric"),
            F.lit(m.additive).alias("additive"),
            m.value.alias("value"),
            (F.lit(None) if m.obs is None else m.obs).cast("bigint").alias("obs"),
        )
        for m in metrics()
    ]
    return slices.select(*keys, "trips", F.explode(F.array(*entries)).alias("e")).select(
        *keys, "trips", "e.*"
    )


def solid(floor: Column) -> Column:
    """Whether a value stands on enough observations to be shown or ranked."""
    supported = F.col("value").isNotNull() & (F.col("obs") >= floor)
    return F.when(F.col("additive"), F.col("trips") > 0).otherwise(supported)


def coverage() -> Column:
    """Share of trips the metric could be measured on; a total has none."""
    return F.when(~F.col("additive"), ratio(F.col("obs"), F.col("trips")))
