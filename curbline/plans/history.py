"""Run and check history: append-only tables beside the published one."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, Window as W, functions as F

from ..functions.scalars import duration_seconds, wall_clock

RUN_SCHEMA = """
    run_id STRING, dataset STRING, source_month DATE, written_at TIMESTAMP_NTZ, trigger STRING,
    app_version STRING, git_sha STRING,
    source STRUCT<url: STRING, etag: STRING, last_modified: TIMESTAMP_NTZ, bytes: BIGINT,
                  sha256: STRING, moved: BOOLEAN>,
    schema STRUCT<columns: INT, extra: ARRAY<STRING>, missing_optional: ARRAY<STRING>>,
    rows STRUCT<input: BIGINT, published: BIGINT, reversed: BIGINT, rejected: BIGINT,
                output: BIGINT, prev_version_input: BIGINT, nonfinite: BIGINT>,
    rules MAP<STRING, BIGINT>, nulled MAP<STRING, BIGINT>, thresholds MAP<STRING, DOUBLE>,
    seconds DOUBLE
"""

CHECK_SCHEMA = """
    check_id STRING, dataset STRING, checked_at TIMESTAMP_NTZ, trigger STRING,
    app_version STRING, git_sha STRING, checked ARRAY<STRING>, changed ARRAY<STRING>,
    source_newest STRING, source_age_days INT, ingest_gap ARRAY<STRING>, status STRING,
    detail STRING
"""

SHOWN = 14
STALE_HOURS = 48


def _newest_first():
    return [F.desc("written_at"), F.desc("run_id")]


def latest_runs(runs: DataFrame) -> DataFrame:
    """The newest run of each month."""
    order = W.partitionBy("source_month").orderBy(*_newest_first())
    ranked = runs.withColumn("_rn", F.row_number().over(order))
    return ranked.where(F.col("_rn") == 1).drop("_rn")


def runs_history(runs: DataFrame) -> DataFrame:
    """All runs, newest first, each beside the input of the version before it."""
    order = W.partitionBy("source_month").orderBy("written_at", "run_id")
    previous = F.lag(F.col("rows.input")).over(order)
    return runs.withColumn("previous_version_input", previous).orderBy(
        F.desc("source_month"), *_newest_first()
    )


def recent_runs(runs: DataFrame, shown: int = SHOWN) -> DataFrame:
    return runs.orderBy(F.desc("source_month"), *_newest_first()).limit(shown)


def recent_checks(checks: DataFrame, shown: int = SHOWN) -> DataFrame:
    """The newest checks, each carrying how many there are in all."""
    total = checks.agg(F.count(F.lit(1))).scalar()
    return checks.withColumn("total", total).orderBy(F.desc("checked_at"), F.desc("check_id")).limit(shown)


def stale_checks(checks: DataFrame, now: datetime, hours: int = STALE_HOURS) -> DataFrame:
    """Whether the newest check is older than two daily slots."""
    newest = checks.agg(F.max("checked_at").alias("newest"))
    seconds = duration_seconds(F.col("newest"), wall_clock(now))
    return newest.withColumn("hours", seconds / F.lit(3600.0)).withColumn(
        "stale", F.col("hours") > hours
    )


def upgrade_runs(runs: DataFrame) -> DataFrame:
    """Runs written before reversals had a rule of their own.

    They counted them, together with uncharged trips, under ``nonpositive_total`` and as
    rejected. Such a run is translated and marked, since the two cannot be told apart later.
    """
    old, new = "nonpositive_total", "reversal"
    moved = F.try_element_at(F.col("rules"), F.lit(old))
    is_old = F.col("rows.reversed").isNull() & moved.isNotNull()
    others = F.map_filter("rules", lambda k, _: ~k.isin(old, new))
    rules = F.map_concat(others, F.create_map(F.lit(new), moved))
    rejected = F.coalesce(F.col("rows.rejected"), F.lit(0)) - moved
    rows = (
        F.col("rows").withField("reversed", moved).withField("rejected", rejected)
    )
    return runs.withColumns(
        {
            "rules": F.when(is_old, rules).otherwise(F.col("rules")),
            "rows": F.when(is_old, rows).otherwise(F.col("rows")),
            "reversals_estimated": is_old,
        }
    )
