"""Hard limits a month must pass before it is published."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from ..config import Thresholds
from ..functions.scalars import change, ratio

MONTH = "source_month"


def _with_previous(metrics: DataFrame) -> DataFrame:
    """Adds the input of the calendar month before; null when that month is not there.

    One row per month, so one window over all of them is small.
    """
    order = W.partitionBy().orderBy(MONTH)
    adjacent = F.lag(MONTH).over(order) == F.add_months(MONTH, -1)
    return metrics.withColumn("previous_input", F.when(adjacent, F.lag("input").over(order)))


def volume_delta(metrics: DataFrame) -> DataFrame:
    """Input rows of each month against the calendar month before it."""
    return _with_previous(metrics).select(
        MONTH, "input", "previous_input",
        change(F.col("input"), F.col("previous_input")).alias("volume_delta"),
    )


def _judged(measured: DataFrame, limits: Thresholds) -> DataFrame:
    """Adds ``volume_delta`` and whether it is over the limit, month by month.

    The base of a month is the calendar month before it: its input in this batch if it passed, else
    its stored run. Whether a month passed thus depends on the one before, so the months are
    folded in order; there is one small row per month.
    """
    fold = f"""
        aggregate(months,
            named_struct('month', CAST(NULL AS DATE), 'input', CAST(NULL AS BIGINT),
                'out', CAST(array() AS ARRAY<STRUCT<month: DATE, delta: DOUBLE, over: BOOLEAN>>)),
            (done, m) -> transform(array(
                IF(done.month = add_months(m.month, -1), done.input, m.known)
            ), base -> transform(array(
                IF(base <> 0 AND m.input > 0, CAST(m.input AS DOUBLE) / CAST(base AS DOUBLE) - 1D, NULL)
            ), delta -> named_struct(
                'month', IF(m.fine AND coalesce(abs(delta) <= {limits.max_volume_delta}D, true),
                            m.month, done.month),
                'input', IF(m.fine AND coalesce(abs(delta) <= {limits.max_volume_delta}D, true),
                            m.input, done.input),
                'out', concat(done.out, array(named_struct('month', m.month, 'delta', delta,
                    'over', coalesce(abs(delta) > {limits.max_volume_delta}D, false))))
            ))[0])[0]).out"""
    one = F.struct(
        F.col(MONTH).alias("month"), "input", "known", F.col("failed_gate").isNull().alias("fine")
    )
    return (
        measured.agg(F.array_sort(F.collect_list(one)).alias("months"))
        .select(F.explode(F.expr(fold)).alias("m"))
        .select(F.col("m.month").alias(MONTH), F.col("m.delta").alias("volume_delta"), "m.over")
    )


def gate_results(
    metrics: DataFrame,
    limits: Thresholds = Thresholds(),
    months: DataFrame | None = None,
    history: DataFrame | None = None,
) -> DataFrame:
    """One row per month with every measured share and the first gate it fails.

    ``months`` lists the months that were asked for: one without a single row has no metrics
    and fails for that. ``history`` (source_month, input) holds the newest earlier runs. The volume
    gate compares with the month before: with this batch if that month passes in it, else with
    its earlier run; without either the gate is skipped. A month that fails is nobody's base.
    """
    rows = metrics
    if months is not None:
        rows = months.select(MONTH).join(rows, MONTH, "left")
    if history is not None:
        known = history.select(
            F.add_months(MONTH, 1).alias(MONTH), F.col("input").cast("bigint").alias("known")
        )
        rows = rows.join(known, MONTH, "left")
    else:
        rows = rows.withColumn("known", F.lit(None).cast("bigint"))
    c = F.col
    measured = rows.select(
        MONTH,
        "known",
        F.coalesce("input", F.lit(0)).cast("bigint").alias("input"),
        ratio(c("rejected"), c("input")).alias("reject_ratio"),
        ratio(c("reversed"), c("input")).alias("reversal_ratio"),
        ratio(c("x_trip_distance"), c("input")).alias("null_distance_ratio"),
        ratio(c("x_duration_min"), c("input")).alias("null_duration_ratio"),
    ).withColumn(
        "failed_gate",
        F.when(c("input") == 0, "no_rows")
        .when(c("reject_ratio") > limits.max_reject_ratio, "rejected")
        .when(c("reversal_ratio") > limits.max_reversal_ratio, "reversed")
        .when(c("null_distance_ratio") > limits.max_null_ratio_distance, "nulled_distance")
        .when(c("null_duration_ratio") > limits.max_null_ratio_duration, "nulled_duration"),
    )
    return measured.join(_judged(measured, limits), MONTH).select(
        MONTH, "input", "reject_ratio", "reversal_ratio", "null_distance_ratio",
        "null_duration_ratio", "volume_delta",
        F.coalesce("failed_gate", F.when(c("over"), "volume")).alias("failed_gate"),
    ).withColumn("passed", c("failed_gate").isNull())
