"""What has to be done, decided from tables of source fingerprints.

inventory (source_month, etag, ...)   months the source publishes now
state     (source_month, etag, ...)   fingerprint each month was last loaded with
outputs   (source_month)              months that have a published partition
Every table holds one row per month.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..config import Thresholds
from ..functions.calendar import lookback, month_range
from ..functions.scalars import age_days, month_label

MONTH = "source_month"


def candidate_months(
    spark: SparkSession,
    today: date,
    first: str | None = None,
    last: str | None = None,
    limits: Thresholds = Thresholds(),
) -> DataFrame:
    """An explicit range, or the look-back window before today's month."""
    months = month_range(first, last) or lookback(today, limits.lookback_months)
    return spark.createDataFrame([(m,) for m in months], f"{MONTH} DATE")


def detect(
    candidates: DataFrame,
    inventory: DataFrame,
    state: DataFrame,
    outputs: DataFrame,
    force: bool = False,
) -> DataFrame:
    """One row per candidate: published or not, has output or not, and why it needs work.

    ``reason`` is null when there is nothing to do. A missing fingerprint on both sides
    counts as unchanged.
    """
    offered = inventory.select(MONTH, "etag", F.lit(True).alias("published"))
    loaded = state.select(MONTH, F.col("etag").alias("stored_etag"), F.lit(True).alias("stored"))
    done = outputs.select(MONTH, F.lit(True).alias("has_output")).distinct()
    no = F.lit(False)
    seen = (
        candidates.select(MONTH)
        .join(offered, MONTH, "left")
        .join(loaded, MONTH, "left")
        .join(done, MONTH, "left")
        .withColumns({c: F.coalesce(c, no) for c in ("published", "stored", "has_output")})
    )
    reason = (
        F.when(~F.col("published"), F.lit(None))
        .when(F.lit(force), "force")
        .when(~F.col("stored"), "new")
        .when(~F.col("etag").eqNullSafe(F.col("stored_etag")), "etag_changed")
        .when(~F.col("has_output"), "missing_output")
    )
    return seen.select(MONTH, "published", "etag", "has_output", reason.alias("reason"))


def work(detected: DataFrame) -> DataFrame:
    return detected.where(F.col("reason").isNotNull()).select(MONTH, "etag", "reason")


def ingest_gaps(candidates: DataFrame, inventory: DataFrame, outputs: DataFrame) -> DataFrame:
    """Published months without output, whatever else is known about them."""
    offered = candidates.select(MONTH).join(inventory.select(MONTH), MONTH, "left_semi")
    return offered.join(outputs.select(MONTH), MONTH, "left_anti")


def _labels(condition: Column | None = None) -> Column:
    label = month_label(F.col(MONTH))
    chosen = label if condition is None else F.when(condition, label)
    return F.array_sort(F.collect_list(chosen))


def freshness(detected: DataFrame, today: date, limits: Thresholds = Thresholds()) -> DataFrame:
    """One verdict over the window: gap first, then nothing published, then too old.

    The lists hold months of one look-back window or range.
    """
    newest = F.col("newest_month")
    gap = F.array_join("ingest_gap", ", ")
    age = F.col("source_age_days")
    problem = (
        F.when(F.size("ingest_gap") > 0, F.concat(F.lit("published months without output: "), gap))
        .when(newest.isNull(), "no published month in the window")
        .when(
            age > limits.source_stale_days,
            F.concat(
                F.lit("newest data is "), F.col("source_newest"), F.lit(" ("), age.cast("string"),
                F.lit(f" days old); the limit is {limits.source_stale_days}"),
            ),
        )
    )
    return (
        detected.agg(
            _labels().alias("checked"),
            _labels(F.col("reason").isNotNull()).alias("changed"),
            _labels(F.col("published") & ~F.col("has_output")).alias("ingest_gap"),
            F.max(F.when(F.col("published"), F.col(MONTH))).alias("newest_month"),
        )
        .withColumn("source_newest", month_label(newest))
        .withColumn("source_age_days", age_days(newest, F.lit(today)))
        .withColumn("detail", problem)
        .withColumn("status", F.when(F.col("detail").isNull(), "ok").otherwise("failed"))
        .drop("newest_month")
    )


def ingest_plan(
    expected: DataFrame, inventory: DataFrame, state: DataFrame, raw: DataFrame
) -> DataFrame:
    """Per month to process: reuse the stored copy or load it again.

    ``expected`` (source_month, etag) is what detection saw; ``moved`` tells that the source
    has changed again since. ``raw`` lists the months whose raw copy exists.
    """
    offered = inventory.select(MONTH, F.col("etag").alias("actual"), F.lit(True).alias("offered"))
    loaded = state.select(MONTH, F.col("etag").alias("stored_etag"), F.lit(True).alias("stored"))
    copies = raw.select(MONTH, F.lit(True).alias("has_raw")).distinct()
    same = F.col("stored") & F.col("has_raw") & F.col("stored_etag").eqNullSafe(F.col("actual"))
    moved = F.col("etag").isNotNull() & ~F.col("etag").eqNullSafe(F.col("actual"))
    return (
        expected.select(MONTH, "etag")
        .join(offered, MONTH, "left")
        .join(loaded, MONTH, "left")
        .join(copies, MONTH, "left")
        .select(
            MONTH,
            F.col("actual").alias("etag"),
            F.when(F.col("offered").isNull(), "unpublished")
            .when(same, "reuse")
            .otherwise("load")
            .alias("action"),
            (F.col("offered").isNotNull() & moved).alias("moved"),
        )
    )
