"""Gates, slices, rankings, classes, reports and the sample on small tables."""

import random
from datetime import date

import pytest
from pyspark.sql import functions as F

from conftest import CASES, TRIP_SCHEMA, ride
from curbline.config import Thresholds
from curbline.functions import scalars as X
from curbline.functions.metrics import SUMS, metrics_long, solid
from curbline.operators import gates, quality, ranking, sample, slices as S

JAN, FEB, MAR = date(2025, 1, 1), date(2025, 2, 1), date(2025, 3, 1)
METRICS = (
    "source_month DATE, input BIGINT, rejected BIGINT, reversed BIGINT, x_trip_distance BIGINT,"
    " x_duration_min BIGINT"
)


def gate(spark, rows, months=None, history=None, limits=Thresholds()):
    metrics = spark.createDataFrame(rows, METRICS)
    wanted = months and spark.createDataFrame([(m,) for m in months], "source_month DATE")
    known = history and spark.createDataFrame(history, "source_month DATE, input BIGINT")
    out = gates.gate_results(metrics, limits, wanted, known).collect()
    return {r["source_month"]: r for r in out}


@pytest.mark.parametrize(
    ("counts", "failed"),
    [
        ((1000, 50, 80, 100, 50), None),  # every limit is reached, none is passed
        ((1000, 51, 90, 0, 0), "rejected"),
        ((1000, 10, 90, 200, 0), "reversed"),  # 9 % reversals: their own budget, not the other
        ((1000, 0, 0, 101, 51), "nulled_distance"),
        ((1000, 0, 0, 0, 51), "nulled_duration"),
    ],
)
def test_gate_limits(spark, counts, failed):
    row = gate(spark, [(JAN, *counts)])[JAN]
    assert (row["failed_gate"], row["passed"]) == (failed, failed is None)


def test_reversals_have_their_own_budget(spark):
    loose = Thresholds(max_reversal_ratio=0.2)
    assert gate(spark, [(JAN, 1000, 10, 90, 0, 0)], limits=loose)[JAN]["passed"]


def test_a_failed_month_is_nobodys_base(spark):
    def counts(month, n):
        return (month, n, 0, 0, 0, 0)

    before = [(date(2024, 12, 1), 1000)]
    out = gate(spark, [counts(JAN, 300), counts(FEB, 1000)], history=before)
    assert out[JAN]["failed_gate"] == "volume" and out[FEB]["passed"]
    assert out[FEB]["volume_delta"] is None
    # an earlier run of the failed month is
    out = gate(spark, [counts(JAN, 300), counts(FEB, 1000)], history=[*before, (JAN, 900)])
    assert out[FEB]["volume_delta"] == pytest.approx(1 / 9)
    # and a month fails for the base that the one before it became
    out = gate(spark, [counts(JAN, 1100), counts(FEB, 300), counts(MAR, 320)], history=before)
    assert [out[m]["failed_gate"] for m in (JAN, FEB, MAR)] == [None, "volume", None]


def test_volume_gate_and_absent_months(spark):
    rows = [(JAN, 100, 0, 0, 0, 0), (FEB, 141, 0, 0, 0, 0)]
    out = gate(spark, rows, months=[JAN, FEB, MAR])
    assert out[JAN]["volume_delta"] is None and out[JAN]["passed"]
    assert out[FEB]["failed_gate"] == "volume"
    assert (out[MAR]["failed_gate"], out[MAR]["input"]) == ("no_rows", 0)
    # a month that is not adjacent is no predecessor
    assert gate(spark, [(JAN, 100, 0, 0, 0, 0), (MAR, 500, 0, 0, 0, 0)])[MAR]["passed"]
    # the history helps out, and the batch wins over it
    assert gate(spark, rows[1:], history=[(JAN, 10)])[FEB]["failed_gate"] == "volume"
    assert gate(spark, [rows[0], (FEB, 120, 0, 0, 0, 0)], history=[(JAN, 10)])[FEB]["passed"]


SLICE = "source_month DATE, location_id INT, borough STRING, zone STRING, trips BIGINT, revenue DECIMAL(38,4), refunds DECIMAL(38,4), dist_obs BIGINT, dist_sum DECIMAL(38,4), dur_obs BIGINT, dur_sum DECIMAL(38,4), fare_obs BIGINT, fare_sum DECIMAL(38,4)"


def slice_rows(spark, rows):
    from decimal import Decimal

    def dec(x):
        return Decimal(str(x))

    data = [
        (m, z, f"b{z}", f"z{z}", t, dec(rev), dec(ref), do, dec(ds), uo, dec(us), fo, dec(fs))
        for m, z, t, rev, ref, do, ds, uo, us, fo, fs in rows
    ]
    return spark.createDataFrame(data, SLICE)


def test_metrics_of_one_slice(spark):
    one = slice_rows(spark, [(JAN, 1, 10, 200.0, -20.0, 8, 24.0, 5, 60.0, 4, 50.0)])
    out = {r["metric"]: r for r in metrics_long(one, ["location_id"]).collect()}
    assert {k: r["value"] for k, r in out.items()} == {
        "trips": 10.0, "revenue": 180.0, "revenue_per_trip": 18.0, "avg_fare_usd": 12.5,
        "avg_distance_mi": 3.0, "avg_duration_min": 12.0, "speed_mph": 15.0,
        "fare_per_mile": 12.5 / 3.0,
    }
    assert {k: r["obs"] for k, r in out.items()} == {
        "trips": None, "revenue": None, "revenue_per_trip": 10, "avg_fare_usd": 4,
        "avg_distance_mi": 8, "avg_duration_min": 5, "speed_mph": 5, "fare_per_mile": 4,
    }


def test_metrics_without_observations_are_null(spark):
    none = slice_rows(spark, [(JAN, 1, 0, 0.0, -5.0, 0, 0, 0, 0, 0, 0)])
    out = {r["metric"]: r["value"] for r in metrics_long(none, ["location_id"]).collect()}
    assert out.pop("revenue") == -5.0 and out.pop("trips") == 0.0
    assert set(out.values()) == {None}
    held = metrics_long(none, ["location_id"]).where(solid(F.lit(0))).count()
    assert held == 0


def busy(spark, seed=1, zones=40):
    rng = random.Random(seed)
    rows = []
    for m in (JAN, FEB):
        for z in range(zones):
            t = rng.randint(1, 50) * (1000 if z == 0 else 1)  # one zone holds most trips
            rows.append((m, z, t, t * 10.0, -1.0, t, float(t * rng.randint(1, 9)), t, t * 12.0, t, t * 9.0))
    return slice_rows(spark, rows), rows


def test_ranking_floor_and_order(spark):
    df, rows = busy(spark)
    out = ranking.zone_ranking(df).where("metric = 'avg_distance_mi'").collect()
    for m in (JAN, FEB):
        mine = [r for r in rows if r[0] == m]
        floor = int(sum(r[2] for r in mine) * 0.001 + 0.5)
        want = sorted([(-r[6] / r[5], r[1]) for r in mine if r[5] >= floor])[:10]
        got = [(-r["value"], r["location_id"]) for r in sorted(out, key=lambda r: r["rank"]) if r["source_month"] == m]
        assert got == want
    best = {r["source_month"]: r for r in ranking.best_zone(df).where("metric = 'trips'").collect()}
    total = sum(r[2] for r in rows if r[0] == JAN)
    top = max(r[2] for r in rows if r[0] == JAN)
    assert best[JAN]["share"] == top / total


def test_quantile_classes_against_sorting(spark):
    df, rows = busy(spark, zones=36)  # six divides the number of zones
    outlined = spark.createDataFrame([(z,) for z in range(30)] + [(99,)], "location_id INT")
    out = ranking.quantile_classes(df, outlined).where("metric = 'trips'").collect()
    for m in (JAN, FEB):
        known = sorted(r[2] for r in rows if r[0] == m and r[1] < 30)
        edges = [known[i * len(known) // 6] for i in range(1, 6)]
        for r in (r for r in out if r["source_month"] == m):
            assert r["class"] == sum(r["value"] >= e for e in edges)
        assert sum(r["source_month"] == m for r in out) == 30


def test_outlined_mean_counts_empty_zones(spark):
    df, rows = busy(spark)
    outlined = spark.createDataFrame([(1,), (2,), (99,), (98,)], "location_id INT")
    jan = S.outlined_mean(df, outlined).where(F.col("source_month") == F.lit(JAN)).first()
    trips = sum(r[2] for r in rows if r[0] == JAN and r[1] in (1, 2))
    assert (jan["outlined_trips"], jan["outlined_zones"], jan["mean_trips"]) == (trips, 4, trips / 4)
    off = S.off_map_trips(df, outlined).where(F.col("source_month") == F.lit(JAN)).first()
    assert (off["codes"], off["trips"]) == (38, sum(r[2] for r in rows if r[0] == JAN) - trips)


def test_dense_fills_sums_but_not_medians(spark):
    df = slice_rows(spark, [(JAN, 1, 5, 50.4, -1.0, 5, 10.04, 5, 60, 5, 40), (FEB, 2, 7, 70, 0, 7, 10, 7, 60, 7, 40)])
    df = df.withColumns({"median_dist": F.lit(1.5), "median_dur": F.lit(9.0)})
    out = {(r["source_month"], r["location_id"]): r for r in S.zone_month_dense(df).collect()}
    assert len(out) == 4
    gap = out[(FEB, 1)]
    assert all(gap[c] == 0 for c in SUMS) and gap["median_dist"] is None and gap["zone"] == "z1"
    assert (out[(JAN, 1)]["revenue"], out[(JAN, 1)]["dist_sum"]) == (50, 10.0)


def latest(spark, rows):
    data = [(f"r{m}", m, (i, rev, rej), {}, {"trip_distance": nd}) for m, i, rev, rej, nd in rows]
    return spark.createDataFrame(
        data,
        "run_id STRING, source_month DATE, rows STRUCT<input: BIGINT, reversed: BIGINT, rejected: BIGINT>,"
        " rules MAP<STRING, BIGINT>, nulled MAP<STRING, BIGINT>",
    )


def test_worst_month_ties_and_floor(spark):
    runs = latest(spark, [(JAN, 100, 2, 0, 5), (FEB, 100, 2, 0, 6), (MAR, 50, None, 0, 0)])
    out = {r["measure"]: (r["worst"], r["month"]) for r in quality.worst_month(runs).collect()}
    assert out["reversed"] == (0.02, "2025-01")  # the first month on ties
    assert out["rejected"] == (0.0, "2025-01")  # never above zero
    assert out["nulled_distance"] == (0.06, "2025-02")
    assert out["volume"] == (0.5, "2025-03")
    used = {r["measure"]: r for r in quality.gate_headroom(runs).collect()}
    assert used["volume"]["used"] == 1.0 and used["volume"]["warn"]
    assert used["reversed"]["used"] == 0.25 and not used["reversed"]["warn"]


def test_scalars(spark):
    row = spark.sql("select 2.5D a, -0.004D b, 1.005D c, -2.5D d, date'2025-01-04' e").select(
        X.js_round(F.col("a")).alias("up"), X.js_round(F.col("d")).alias("down"),
        X.direction(F.col("b")).alias("flat"), X.direction(F.col("a")).alias("rise"),
        X.round_half(F.col("c"), 2).alias("tie"), X.round_half(F.lit(-0.125), 2).alias("away"),
        X.is_weekend(F.col("e")).alias("sat"), X.change(F.col("a"), F.lit(0)).alias("no_base"),
        X.ratio(F.col("a"), F.lit(0)).alias("no_whole"),
    ).first()
    assert tuple(row) == (3, -2, "flat", "up", 1.01, -0.13, True, None, None)


def test_sample_shows_every_kind(spark):
    many = [ride(f"2023-06-{1 + i % 28:02d}T10:00", 20, 1.0 + i, 9.0, 11.0) for i in range(200)]
    broken = [ride("2023-06-05T10:00", 10, 0.0, 5.0, float(i)) for i in range(1, 31)]
    df = spark.createDataFrame(CASES + many + broken + [ride("2023-06-05T10:00", 10, 1.0, 5.0, 6.0, zone=264)], TRIP_SCHEMA)
    out = sample.pathology_sample(df, 100).collect()
    kinds = [r["kind"] for r in out]
    assert len(out) == 100
    assert kinds.count("zero_distance") == 20  # capped per kind
    assert {"implausible_distance", "impossible_speed", "negative_fare", "reversal", "zero_total",
            "nonpositive_duration", "long_duration", "unknown_zone", "random"} <= set(kinds)
    again = sample.pathology_sample(df.repartition(5), 100).collect()
    assert sorted(map(str, out)) == sorted(map(str, again))


def test_top_k_is_cut_before_the_shuffle(spark):
    df, _ = busy(spark)
    ranked = ranking.zone_ranking(df)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in ranked and "Partial" in ranked
    drawn = sample.pathology_sample(spark.createDataFrame(CASES, TRIP_SCHEMA), 20)
    text = drawn._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in text and "Partial" in text and text.count("Scan ExistingRDD") == 1
    assert "CartesianProduct" not in text


def test_sample_of_broken_numbers(spark):
    """NaN, infinities and numbers beyond any whole number end nothing and are sampled like others."""
    nan, inf = float("nan"), float("inf")
    rows = [ride("2023-06-10T08:00", 12, m, f, t) for m in (nan, inf, -inf, 1e18, None) for f in (nan, 1e300, 5.0) for t in (-inf, nan, 1e18, -7.0)]
    df = spark.createDataFrame(rows + CASES, TRIP_SCHEMA)
    out = sample.pathology_sample(df, 500)
    kinds = [r["kind"] for r in out.collect()]
    assert {"implausible_distance", "zero_distance", "reversal", "random"} <= set(kinds)
    assert sorted(map(str, out.collect())) == sorted(map(str, sample.pathology_sample(df.repartition(4), 500).collect()))
    assert kinds.count("random") == len(rows) + len(CASES)


def test_dense_table_and_classes_read_the_slices_once(spark, tmp_path):
    df = slice_rows(spark, [(JAN, 1, 5, 50.4, -1.0, 5, 10.04, 5, 60, 5, 40), (FEB, 2, 7, 70, 0, 7, 10, 7, 60, 7, 40)])
    df.withColumns({"median_dist": F.lit(1.5), "median_dur": F.lit(9.0)}).write.parquet(str(tmp_path / "s"))
    stored = spark.read.parquet(str(tmp_path / "s"))
    assert S.zone_month_dense(stored)._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
