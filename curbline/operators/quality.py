"""Reports over the run history.

A history has one row per run: a few per month, whatever the size of the trips behind it.
``latest`` always means the newest run of each month.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..config import Thresholds
from ..functions.scalars import month_label, ratio
from .rules import ROW_ACTIONS, Rule

MONTH = "source_month"


def _count(of: str, key: str) -> Column:
    return F.coalesce(F.try_element_at(F.col(of), F.lit(key)), F.lit(0))


def _sum_values(of: str) -> Column:
    return F.aggregate(F.map_values(of), F.lit(0).cast("bigint"), lambda a, b: a + b)


def _reversed() -> Column:
    return F.coalesce(F.col("rows.reversed"), F.lit(0))


def rule_ledger(latest: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Rows each rule touched over all months, and what the rule does."""
    counts = latest.select(F.explode("rules").alias("rule", "n")).groupBy("rule").agg(
        F.sum("n").alias("rows")
    )
    words = {r.name: r.action if r.nulls is None else "null_field" for r in rules}
    fields = {r.name: "whole_row" if r.takes_row else r.nulls for r in rules}
    total = latest.agg(F.sum("rows.input")).scalar()

    def look_up(pairs: dict[str, str | None]) -> Column:
        known = F.create_map(*[F.lit(x) for kv in pairs.items() if kv[1] for x in kv])
        return F.try_element_at(known, F.col("rule"))

    return counts.select(
        "rule", look_up(words).alias("effect"), look_up(fields).alias("field"), "rows",
        ratio(F.col("rows"), total).alias("share"),
    ).orderBy(F.desc("rows"), "rule")


def history_kpis(runs: DataFrame) -> DataFrame:
    """One row over the whole history; counts come from the newest run of each month."""
    newest = W.partitionBy(MONTH).orderBy(F.desc("written_at"), F.desc("run_id"))
    marked = runs.withColumn("newest", F.row_number().over(newest) == 1)

    def total(x: Column) -> Column:
        return F.coalesce(F.sum(F.when(F.col("newest"), x)), F.lit(0))

    names = F.flatten(F.collect_set(F.when(F.col("newest"), F.map_keys("rules"))))
    return marked.agg(
        F.count_if("newest").alias("months"),
        F.count(F.lit(1)).alias("runs"),
        total(F.col("rows.input")).alias("input"),
        total(F.col("rows.output")).alias("output"),
        total(F.col("rows.rejected")).alias("rejected"),
        total(_reversed()).alias("reversed"),
        total(_sum_values("nulled")).alias("nulled"),
        F.size(F.array_distinct(names)).alias("rules"),
        F.max("seconds").alias("slowest_seconds"),
    ).withColumns(
        {
            "rejected_share": ratio(F.col("rejected"), F.col("input")),
            "reversed_share": ratio(F.col("reversed"), F.col("input")),
        }
    )


def run_funnel(runs: DataFrame) -> DataFrame:
    """How the input of each run was split."""
    whole = F.col("rows.input")
    return runs.select(
        MONTH, "run_id", whole.alias("input"), F.col("rows.output").alias("output"),
        ratio(F.col("rows.published"), whole).alias("published_share"),
        ratio(_reversed(), whole).alias("reversed_share"),
        ratio(F.col("rows.rejected"), whole).alias("rejected_share"),
        ratio(_reversed() + F.col("rows.rejected"), whole).alias("excluded_share"),
    )


def run_rules(runs: DataFrame) -> DataFrame:
    """Rules that touched rows, most rows first within a run."""
    hit = runs.select(
        MONTH, "run_id", F.col("rows.input").alias("input"), F.explode("rules").alias("rule", "rows")
    ).where(F.col("rows") > 0)
    order = W.partitionBy("run_id").orderBy(F.desc("rows"), "rule")
    return hit.select(
        MONTH, "run_id", F.row_number().over(order).alias("position"), "rule", "rows",
        ratio(F.col("rows"), F.col("input")).alias("share"),
    )


def rule_overlap(latest: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Rows that broke more than one row-level rule: flagged minus actually removed."""
    flagged = sum((_count("rules", r.name) for r in rules if r.action in ROW_ACTIONS), F.lit(0))
    removed = _reversed() + F.col("rows.rejected")
    return latest.select(
        MONTH, flagged.alias("flagged"), removed.alias("removed"),
        (flagged - removed).alias("overlap"),
    )


def quarantine_monthly(latest: DataFrame, refunds: DataFrame) -> DataFrame:
    """What left the published set, by month and in total, beside the mean month.

    ``refunds`` is (source_month, refunds) from the published table: the only place that
    knows the money behind the reversals.
    """
    joined = latest.join(refunds.select(MONTH, F.col("refunds").alias("refund_money")), MONTH).select(
        MONTH, "refund_money", F.col("rows.input").alias("input"),
        F.col("rows.rejected").alias("rejected"), _reversed().alias("reversed"),
        _sum_values("nulled").alias("nulled"),
        *[_count("nulled", c).alias(f"nulled_{c}") for c in ("trip_distance", "duration_min", "fare_amount")],
    )
    counts = [c for c in joined.columns if c not in (MONTH, "refund_money")]
    rolled = joined.rollup(MONTH).agg(
        F.grouping(MONTH).alias("is_total"),
        *[F.sum(c).alias(c) for c in counts],
        F.round(F.sum(F.col("refund_money").cast("decimal(18,4)")), 2).cast("double").alias("refunds"),
    )
    # one row per month and one total: the window spans the whole, small report
    months = F.col("is_total") == 0
    everything = W.partitionBy()

    def mean(c: str) -> Column:
        n = F.count(F.when(months, F.lit(1))).over(everything).cast("double")
        return F.max(F.when(~months, F.col(c))).over(everything).cast("double") / n

    return rolled.select(
        F.when(months, month_label(F.col(MONTH))).otherwise("total").alias("month"),
        *counts, "refunds",
        ratio(F.col("rejected"), F.col("input")).alias("rejected_share"),
        ratio(F.col("reversed"), F.col("input")).alias("reversed_share"),
        *[mean(c).alias(f"mean_{c}") for c in ("rejected", "reversed", "nulled", "refunds")],
    )


def worst_month(latest: DataFrame) -> DataFrame:
    """Per gate the highest value a month reached; the earliest month on ties, zero at least.

    The volume is compared with the month before it in the history.
    """
    whole = F.col("rows.input")
    # one row per month, so one window over all of them is small
    previous = F.lag(whole).over(W.partitionBy().orderBy(MONTH))
    measures = {
        "rejected": ratio(F.col("rows.rejected"), whole),
        "reversed": ratio(_reversed(), whole),
        "nulled_distance": ratio(_count("nulled", "trip_distance"), whole),
        "nulled_duration": ratio(_count("nulled", "duration_min"), whole),
        "volume": F.abs(ratio(whole, previous) - 1),
    }
    entries = [F.struct(F.lit(k).alias("measure"), v.alias("v")) for k, v in measures.items()]
    long = latest.select(MONTH, F.array(*entries).alias("e")).select(MONTH, F.explode("e").alias("e"))
    value = F.greatest(F.coalesce("e.v", F.lit(0.0)), F.lit(0.0))
    return long.groupBy(F.col("e.measure").alias("measure")).agg(
        F.max(value).alias("worst"),
        F.max_by(month_label(F.col(MONTH)), F.struct(value, -F.unix_date(MONTH))).alias("month"),
    )


def gate_headroom(latest: DataFrame, limits: Thresholds = Thresholds()) -> DataFrame:
    """How much of each gate's limit the worst month used up."""
    # fixed values: gate measure -> limit
    limit = F.create_map(
        *[
            F.lit(x)
            for pair in {
                "rejected": limits.max_reject_ratio,
                "reversed": limits.max_reversal_ratio,
                "nulled_distance": limits.max_null_ratio_distance,
                "nulled_duration": limits.max_null_ratio_duration,
                "volume": limits.max_volume_delta,
            }.items()
            for x in pair
        ]
    )
    used = F.col("worst") / F.col("limit")
    return worst_month(latest).withColumn("limit", limit[F.col("measure")]).select(
        "measure", "worst", "month", "limit", F.least(F.lit(1.0), used).alias("used"),
        (used >= 0.5).alias("warn"),
    )
