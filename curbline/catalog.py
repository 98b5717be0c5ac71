"""Every registered query: (spark, directory of tables) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from .functions.metrics import with_metrics
from .functions.scalars import next_month
from .operators import daily, gates, quality, ranking, rules as R, sample, slices as S
from .operators.contract import NEEDED
from .plans import detect as D, history as H
from .sources import adapter, derived
from .sources.months import partitions as month_partitions

Query = Callable[[SparkSession, str], DataFrame]
MONTH = "source_month"
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def _flagged(spark, sf):
    rules = R.default_rules()
    return R.flag_rows(adapter.trips(spark, sf), rules), rules


def _curated(spark, sf, medians=False):
    return daily.zone_day(
        adapter.trips(spark, sf),
        adapter.zones(spark, sf),
        R.default_rules(),
        medians=medians,
    )


def _stats(spark, sf):
    return daily.daily_stats(*_flagged(spark, sf))


def _zone_slices(spark, sf, medians=False):
    return S.zone_slices(_curated(spark, sf, medians), medians)


def _day_slices(spark, sf):
    return S.day_slices(_curated(spark, sf))


def _latest(spark, sf):
    return H.latest_runs(derived.runs(spark, sf))


def _long(counts: DataFrame, prefix: str, name: str) -> DataFrame:
    """Count columns with a prefix to (month, name, rows)."""
    columns = [c for c in counts.columns if c.startswith(prefix)]
    entries = [
        F.struct(F.lit(c.removeprefix(prefix)).alias(name), F.col(c).alias("rows"))
        for c in columns
    ]
    return counts.select(MONTH, F.explode(F.array(*entries)).alias("e")).select(MONTH, "e.*")


# ---- rows ----


@query
def zone_day(spark, sf):
    return _curated(spark, sf, medians=True)


@query
def scan_trips(spark, sf):
    return adapter.trips(spark, sf)


@query
def zones_dim(spark, sf):
    return adapter.zones(spark, sf)


@query
def trip_duration(spark, sf):
    return R.with_duration(adapter.trips(spark, sf)).select(
        MONTH, "tpep_pickup_datetime", "tpep_dropoff_datetime", "PULocationID", "duration_min"
    )


@query
def out_of_month(spark, sf):
    flagged, _ = _flagged(spark, sf)
    return flagged.where("v_out_of_month").select(
        MONTH, next_month(F.col(MONTH)).alias("month_end"), "tpep_pickup_datetime", "PULocationID"
    )


@query
def labelled_rows(spark, sf):
    flagged, _ = _flagged(spark, sf)
    return flagged.select(MONTH, *NEEDED, "reject_reason")


@query
def excluded_rows(spark, sf):
    return R.excluded_rows(_flagged(spark, sf)[0])


@query
def nulled_fields(spark, sf):
    return R.kept_rows(*_flagged(spark, sf)).select(MONTH, *NEEDED, "duration_min", "reject_reason")


@query
def run_metrics(spark, sf):
    return daily.run_metrics(_stats(spark, sf)).select(
        MONTH, "input", "published", "reversed", "rejected", "output"
    )


@query
def rule_counts(spark, sf):
    flagged, rules = _flagged(spark, sf)
    return _long(daily.row_stats(flagged, rules, [MONTH]), "r_", "rule")


@query
def nulled_counts(spark, sf):
    flagged, rules = _flagged(spark, sf)
    return _long(daily.row_stats(flagged, rules, [MONTH]), "x_", "field")


@query
def reversal_only_zones(spark, sf):
    return _curated(spark, sf).where("trips = 0").select(
        MONTH, "date", "location_id", "trips", "avg_fare_usd", "yellow_revenue_usd", "refunds_usd",
        "net_revenue_usd",
    )


@query
def custom_rules(spark, sf):
    c = F.col
    own = [
        R.Rule("tiny_total", c("total_amount").between(0, 1500), R.REJECT),
        R.Rule("credit", c("total_amount") < 0, R.REVERSAL),
        R.Rule("cheap_mile", c("fare_amount") < 1000 * c("trip_distance"), "fare_amount"),
        R.Rule("crawl", c("trip_distance") / 2 < c("duration_min") / 60, "duration_min"),
        R.Rule("long_haul", c("trip_distance") > 9, R.OBSERVE),
    ]
    flagged = R.flag_rows(adapter.trips(spark, sf), own)
    return daily.row_stats(flagged, own, [MONTH]).select(
        MONTH, "input", "published", "reversed", "rejected",
        *[f"r_{r.name}" for r in own], "x_fare_amount", "x_duration_min", "fare_obs", "duration_obs",
        F.col("distance_obs"),
    )


# ---- gates ----


@query
def gate_results(spark, sf):
    months = derived.expected_months(spark, sf)
    return gates.gate_results(daily.run_metrics(_stats(spark, sf)), months=months)


@query
def volume_delta(spark, sf):
    flagged, rules = _flagged(spark, sf)
    return gates.volume_delta(daily.row_stats(flagged, rules, [MONTH]))


# ---- histories ----


def _flat_run(runs: DataFrame, *more: str) -> DataFrame:
    return runs.select(
        "run_id", MONTH, "written_at", "trigger", F.col("rows.input").alias("input"),
        F.col("rows.published").alias("published"), F.col("rows.reversed").alias("reversed"),
        F.col("rows.rejected").alias("rejected"), F.col("rows.output").alias("output"),
        F.col("rules")["reversal"].alias("rule_reversal"),
        F.col("nulled")["trip_distance"].alias("nulled_distance"),
        "seconds", *more,
    )


@query
def partitions(spark, sf):
    month = {"year": F.year(MONTH), "month": F.month(MONTH)}
    return month_partitions(_curated(spark, sf).withColumns(month))


@query
def latest_runs(spark, sf):
    return _flat_run(_latest(spark, sf))


@query
def runs_history(spark, sf):
    runs = H.runs_history(derived.runs(spark, sf))
    limit = F.col("thresholds")["max_reversal_ratio"]
    shown = runs.withColumn("max_reversal_ratio", limit)
    return _flat_run(shown, "previous_version_input", "max_reversal_ratio")


@query
def recent_runs(spark, sf):
    return _flat_run(H.recent_runs(derived.runs(spark, sf)))


@query
def recent_checks(spark, sf):
    return H.recent_checks(derived.checks(spark, sf)).select(
        "check_id", "checked_at", "trigger", F.size("checked").alias("n_checked"),
        F.col("checked")[0].alias("first_checked"), F.array_join("changed", ",").alias("changed"),
        "source_newest", "status", "detail", "total",
    )


@query
def upgrade_runs(spark, sf):
    return H.upgrade_runs(derived.old_runs(spark, sf)).select(
        "run_id", F.col("rows.reversed").alias("reversed"), F.col("rows.rejected").alias("rejected"),
        F.col("rules")["reversal"].alias("rule_reversal"), F.size("rules").alias("n_rules"),
        "reversals_estimated",
    )


# ---- detection ----


def _candidates(spark, sf):
    """Every month from the first to the last that the source has."""
    return derived.month_span(derived.inventory(spark, sf))


def _detected(spark, sf):
    return D.detect(
        _candidates(spark, sf), derived.inventory(spark, sf), derived.state(spark, sf),
        derived.outputs(spark, sf),
    )


@query
def detect(spark, sf):
    return _detected(spark, sf).select(MONTH, "published", "etag", "has_output", "reason")


@query
def ingest_gaps(spark, sf):
    return D.ingest_gaps(_candidates(spark, sf), derived.inventory(spark, sf), derived.outputs(spark, sf))


@query
def freshness(spark, sf):
    seen = D.freshness(_detected(spark, sf), derived.TODAY)
    return seen.select(
        F.size("checked").alias("n_checked"), F.array_join("changed", ",").alias("changed"),
        F.array_join("ingest_gap", ", ").alias("ingest_gap"), "source_newest", "source_age_days",
        "status", "detail",
    )


@query
def ingest_plan(spark, sf):
    return D.ingest_plan(
        derived.detected_earlier(spark, sf), derived.inventory(spark, sf),
        derived.state(spark, sf), derived.raw_copies(spark, sf),
    )


@query
def stale_checks(spark, sf):
    return H.stale_checks(derived.checks(spark, sf), derived.NOW)


# ---- analytics ----


@query
def zone_month(spark, sf):
    return S.zone_month(_curated(spark, sf))


@query
def zone_month_median(spark, sf):
    rules = R.default_rules()
    return S.zone_month_median(daily.day_medians(adapter.trips(spark, sf), adapter.zones(spark, sf), rules))


@query
def zone_month_dense(spark, sf):
    return S.zone_month_dense(_zone_slices(spark, sf, medians=True))


@query
def zone_index(spark, sf):
    return S.zone_index(_curated(spark, sf))


@query
def daily_series(spark, sf):
    return S.daily_series(_curated(spark, sf))


@query
def month_totals(spark, sf):
    return S.month_totals(_curated(spark, sf))


def _as_double(df: DataFrame) -> DataFrame:
    money = ("revenue", "refunds", "dist_sum", "dur_sum", "fare_sum")
    return df.withColumns({c: F.col(c).cast("double") for c in money})


@query
def slices(spark, sf):
    return _as_double(S.slices(_curated(spark, sf)))


@query
def metrics(spark, sf):
    rows = with_metrics(S.slices(_curated(spark, sf)))
    values = [c for c in rows.columns if c.startswith("m_")]
    return rows.select("level", MONTH, "location_id", "date", *values)


@query
def metric_support(spark, sf):
    return ranking.metric_support(_zone_slices(spark, sf), derived.outlined(spark, sf))


@query
def coverage(spark, sf):
    return ranking.metric_coverage(_zone_slices(spark, sf))


@query
def zone_mean(spark, sf):
    return S.outlined_mean(_zone_slices(spark, sf), derived.outlined(spark, sf))


@query
def zone_names(spark, sf):
    return S.zone_names(_curated(spark, sf), derived.outlines(spark, sf))


@query
def off_map_trips(spark, sf):
    return S.off_map_trips(_zone_slices(spark, sf), derived.outlined(spark, sf))


@query
def zone_ranking(spark, sf):
    return ranking.zone_ranking(_zone_slices(spark, sf))


@query
def best_zone(spark, sf):
    return ranking.best_zone(_zone_slices(spark, sf))


@query
def peak_day(spark, sf):
    return ranking.peak_day(_day_slices(spark, sf))


@query
def mean_vs_median(spark, sf):
    trips, rules = adapter.trips(spark, sf), R.default_rules()
    # Trips are counted for every zone first, so that only those shown need medians.
    shown = ranking.busiest_zones(daily.zone_trips(trips, rules))
    curated = daily.zone_day(daily.trips_of(trips, shown), adapter.zones(spark, sf), rules)
    return ranking.mean_vs_median(S.zone_slices(curated, medians=True))


@query
def quantile_classes(spark, sf):
    return ranking.quantile_classes(_zone_slices(spark, sf), derived.outlined(spark, sf))


@query
def month_vs_history(spark, sf):
    return ranking.month_vs_history(_day_slices(spark, sf))


# ---- quality reports ----


@query
def rule_ledger(spark, sf):
    return quality.rule_ledger(_latest(spark, sf), R.default_rules())


@query
def history_kpis(spark, sf):
    return quality.history_kpis(derived.runs(spark, sf))


@query
def run_funnel(spark, sf):
    return quality.run_funnel(derived.runs(spark, sf))


@query
def run_rules(spark, sf):
    return quality.run_rules(derived.runs(spark, sf))


@query
def rule_overlap(spark, sf):
    return quality.rule_overlap(_latest(spark, sf), R.default_rules())


@query
def quarantine_monthly(spark, sf):
    return quality.quarantine_monthly(_latest(spark, sf), S.month_totals(_curated(spark, sf)))


@query
def worst_month(spark, sf):
    return quality.worst_month(_latest(spark, sf))


@query
def gate_headroom(spark, sf):
    return quality.gate_headroom(_latest(spark, sf))


@query
def pathology_sample(spark, sf):
    wanted = sample.conditions(residual=[0, 1])
    return sample.pathology_sample(adapter.trips(spark, sf), 500, wanted)
