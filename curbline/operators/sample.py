"""A small sample of trips in which every kind of broken row is present."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..config import Thresholds
from .rules import NEEDED, with_duration

PER_CONDITION = 20
RANDOM = "random"
RESIDUAL_ZONES = (264, 265)  # fixed values: location codes that are not places


def conditions(
    limits: Thresholds = Thresholds(), residual: Sequence[int] = RESIDUAL_ZONES
) -> dict[str, Column]:
    """The kinds a sample shows; their names are fixed values."""
    c = F.col
    speed = F.try_divide(c("trip_distance"), c("duration_min") / 60.0)
    return {
        "zero_distance": c("trip_distance") <= 0,
        "implausible_distance": c("trip_distance") > limits.max_distance_mi,
        "impossible_speed": (c("duration_min") > 1) & (speed > limits.max_speed_mph),
        "negative_fare": c("fare_amount") < 0,
        "reversal": c("total_amount") < 0,
        "zero_total": c("total_amount") == 0,
        "nonpositive_duration": c("duration_min") <= 0,
        "long_duration": c("duration_min") > limits.max_duration_min,
        "unknown_zone": c("PULocationID").isin(list(residual)),
    }


def pathology_sample(
    trips: DataFrame,
    rows: int,
    wanted: dict[str, Column] | None = None,
    seed: int = 1,
    per_condition: int = PER_CONDITION,
) -> DataFrame:
    """Up to ``per_condition`` rows of each kind, a row counting once per kind it shows, filled
    up to ``rows`` with a random sample of all trips.

    Every row is of the kind ``random`` too, so all picks are one top-k over one scan, by an order on
    the values themselves: the sample is the same on every run and every task sends on only its
    own best rows of each kind. The random order is the digest of the row under the seed; equal
    rows are interchangeable. A number that is none, or too large to be one, is as good as any
    other in the digest and sorts last.
    """
    wanted = conditions() if wanted is None else wanted
    shown = [F.when(cond, F.lit(name)) for name, cond in wanted.items()]
    columns = ["source_month", *NEEDED]

    def digits(column: str) -> Column:
        near = F.abs(F.col(column)) < 1e15
        return F.when(near, F.rint(F.when(near, F.col(column)) * 100).cast("bigint").cast("string")).when(
            F.col(column).isNotNull(), F.lit("far")
        )

    draw = F.md5(
        F.concat_ws("|", F.lit(str(seed)), *[F.col(c).cast("string") for c in NEEDED[:3]], *map(digits, NEEDED[3:]))
    )
    best = W.partitionBy("kind").orderBy("draw", *columns)
    picked = (
        with_duration(trips)
        .select(*columns, F.explode(F.array_compact(F.array(*shown, F.lit(RANDOM)))).alias("kind"))
        .withColumn("draw", F.when(F.col("kind") == RANDOM, draw))
        .withColumn("place", F.row_number().over(best))
        .where(F.col("place") <= max(rows, per_condition))
        .where((F.col("kind") == RANDOM) | (F.col("place") <= per_condition))
    )
    # ``rows`` random rows and a few per kind have come this far: the count-off is small
    taken = F.count_if(F.col("kind") != RANDOM).over(W.partitionBy())
    return (
        picked.withColumn("taken", taken)
        .where((F.col("kind") != RANDOM) | (F.col("place") <= F.lit(rows) - F.col("taken")))
        .select("kind", *columns)
    )
