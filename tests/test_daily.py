"""Numbers worked out by hand for the rides of conftest, and the edges around them."""

from datetime import date, datetime

import pytest
from pyspark.errors import PySparkException

from conftest import CASES, JUNE, TRIP_SCHEMA, ride
from curbline.operators import daily, rules
from curbline.operators.contract import CURATED



@pytest.fixture(scope="module")
def published(trips, zones):
    rows = daily.zone_day(trips, zones, rules.default_rules()).collect()
    return {r["location_id"]: r for r in rows}


@pytest.fixture(scope="module")
def flagged(trips):
    return rules.flag_rows(trips, rules.default_rules())


def test_zone_with_all_defects(published):
    """Worked out by hand: 9 rides; 6 distances of 31.3 miles, 7 durations of 113 minutes, 8 fares
    of 285.50."""
    r = published[7]
    got = {c: r[c] for c in CURATED if c not in ("date", "location_id", "borough", "zone", "service_zone")}
    assert got == {
        "trips": 9,
        "avg_distance_mi": 5.217,
        "median_distance_mi": 4.1,
        "distance_obs": 6,
        "avg_duration_min": 16.14,
        "median_duration_min": 18.0,
        "duration_obs": 7,
        "avg_fare_usd": 35.69,
        "fare_obs": 8,
        "yellow_revenue_usd": 324.95,
        "refunds_usd": -11.5,
        "net_revenue_usd": 313.45,
    }
    assert list(r.asDict()) == ["source_month", *CURATED]
    assert (r["date"], r["borough"], r["zone"], r["service_zone"]) == (date(2023, 6, 10), "North", "Old Harbour", "Boats")


def test_zone_without_refunds_has_zero_of_them(published):
    r = published[19]
    assert (r["trips"], r["refunds_usd"], r["net_revenue_usd"], r["borough"]) == (1, 0.0, 41.0, "South")


def test_counts_of_the_run(flagged):
    m = daily.run_metrics(daily.daily_stats(flagged, rules.default_rules())).first().asDict()
    del m["source_month"]
    assert m == {
        "input": 13, "published": 10, "reversed": 1, "rejected": 2, "output": 2, "nonfinite": 0,
        "r_out_of_month": 2, "r_implausible_distance": 1, "r_impossible_speed": 2,
        "r_duration_over_limit": 1, "r_nonpositive_duration": 1, "r_negative_fare": 2,
        "r_zero_distance": 1, "r_zero_total": 1, "r_reversal": 2,
        "x_trip_distance": 3, "x_duration_min": 2, "x_fare_amount": 2,
    }


def test_excluded_and_kept_rows(flagged):
    out = sorted((r["reject_reason"], r["fare_amount"], r["total_amount"]) for r in rules.excluded_rows(flagged).collect())
    assert out == [("out_of_month", 9.0, -10.0), ("out_of_month", 15.0, 17.0), ("reversal", -9.0, -11.5)]
    kept = rules.kept_rows(flagged, rules.default_rules()).collect()
    assert len(kept) == 11
    missing = [sum(r[c] is None for r in kept) for c in ("trip_distance", "duration_min", "fare_amount")]
    assert missing == [3, 2, 2]


def table_of(spark, zones, rows, **options):
    df = spark.createDataFrame(rows, TRIP_SCHEMA)
    return daily.zone_day(df, zones, rules.default_rules(), **options).collect()


def test_a_day_of_refunds_stays_and_a_day_of_rejects_goes(spark, zones):
    rows = [ride("2023-06-20T10:00", 8, 1.0, -6.0, -6.5), ride("2023-08-20T10:00", 8, 1.0, 6.0, 6.5)]
    (r,) = table_of(spark, zones, rows)
    assert (r["date"], r["trips"], r["avg_fare_usd"], r["refunds_usd"]) == (date(2023, 6, 20), 0, None, -6.5)
    assert r["median_distance_mi"] is None and r["median_duration_min"] is None


def test_rides_without_a_start_share_a_day_without_date(spark, zones):
    (r,) = table_of(spark, zones, [ride(None, 0, m, 5.0, 6.0) for m in (2.0, 8.0, 3.0)])
    assert (r["date"], r["trips"], r["median_distance_mi"], r["duration_obs"]) == (None, 3, 3.0, 0)


@pytest.mark.parametrize(
    "miles, mean",
    [
        ([0.50049] * 3, 0.5),  # no cut of single values
        ([1.0004999996], 1.0),  # one rounding
        ([1.0005], 1.001),  # a tie goes up
        ([0.1] * 10, 0.1),
        ([2.0, 2.001], 2.001),
    ],
)
def test_sums_keep_all_digits_and_round_once(spark, zones, miles, mean):
    (r,) = table_of(spark, zones, [ride("2023-06-20T10:00", 8, m, 60.5549997, 6.5) for m in miles])
    assert (r["avg_distance_mi"], r["avg_fare_usd"]) == (mean, 60.55)


def test_numbers_that_are_none_are_counted_and_stop_nothing(spark, zones):
    nan, inf = float("nan"), float("inf")
    rows = [
        ride("2023-06-20T10:00", 8, 2.0, nan, 10.0),
        ride("2023-06-20T11:00", 8, 4.0, 7.0, nan),
        ride("2023-06-20T12:00", 8, 3.0, 9.0, inf),
        ride("2023-06-20T13:00", 8, 3.0, 8.0, 1e16),
    ]
    (r,) = table_of(spark, zones, rows)
    assert (r["trips"], r["fare_obs"], r["avg_fare_usd"]) == (4, 3, 8.0)
    assert r["yellow_revenue_usd"] == 1e16 + 10
    flagged = rules.flag_rows(spark.createDataFrame(rows, TRIP_SCHEMA), rules.default_rules())
    assert daily.daily_stats(flagged, rules.default_rules()).first()["nonfinite"] == 3


def test_repeated_zone_id_fails(trips, zones):
    doubled = zones.union(zones.limit(1))
    with pytest.raises(PySparkException, match="repeated location_id"):
        daily.zone_day(trips, doubled, rules.default_rules(), medians=False).collect()


def test_unknown_zone_keeps_its_rows(spark, zones):
    (r,) = table_of(spark, zones, [ride("2023-06-20T10:00", 8, 1.0, 5.0, 5.0, zone=500)])
    assert (r["location_id"], r["borough"], r["trips"]) == (500, None, 1)


def test_zone_id_overflow_raises(spark, zones):
    with pytest.raises(Exception, match="CAST_OVERFLOW"):
        table_of(spark, zones, [ride("2023-06-20T10:00", 8, 1.0, 5.0, 5.0, zone=2**40)])


def test_duration_ignores_daylight_saving_and_truncates(spark):
    def between(first, last):
        return (JUNE, datetime.fromisoformat(first), datetime.fromisoformat(last), 1, 1.0, 1.0, 1.0)

    rows = [
        between("2023-03-12T01:15", "2023-03-12T03:45"),
        between("2023-03-12T01:50", "2023-03-12T02:30"),  # a time the clock skips
        between("2023-06-12T01:40:00.500", "2023-06-12T01:30:01"),
    ]
    out = rules.with_duration(spark.createDataFrame(rows, TRIP_SCHEMA)).collect()
    assert [r["duration_s"] for r in out] == [9000, 2400, -599]


def test_rules_are_data(trips):
    from pyspark.sql import functions as F

    own = [
        rules.Rule("short", F.col("trip_distance") < 2.5, rules.REJECT),
        rules.Rule("pricey", F.col("total_amount") > 90, rules.OBSERVE),
        rules.Rule("odd_total", F.col("total_amount") < 0, "total_amount"),
    ]
    flagged = rules.flag_rows(trips, own)
    m = daily.row_stats(flagged, own, ["source_month"]).first()
    assert (m["rejected"], m["r_short"], m["r_pricey"], m["x_total_amount"]) == (4, 4, 1, 2)
    with pytest.raises(ValueError, match="nope"):
        rules.flag_rows(trips, [rules.Rule("bad", F.lit(True), "nope")])
    with pytest.raises(ValueError, match="plain words"):
        rules.flag_rows(trips, [rules.Rule("it's", F.lit(True), rules.OBSERVE)])
    with pytest.raises(ValueError, match="repeat"):
        rules.flag_rows(trips, [own[0], own[0]])


def test_no_row_rule_means_all_published(trips):
    from pyspark.sql import functions as F

    own = [rules.Rule("seen", F.col("total_amount") > 0, rules.OBSERVE)]
    flagged = rules.flag_rows(trips, own)
    assert daily.row_stats(flagged, own, ["source_month"]).first()["published"] == len(CASES)


def test_one_zone_with_most_rows(spark, zones):
    import random
    from statistics import median

    rng = random.Random(11)
    hot = [ride("2023-06-09T10:00", 40, rng.uniform(0.1, 20), 9.0, 9.0) for _ in range(2001)]
    rest = [ride(f"2023-06-{d:02d}T10:00", 30, float(d), 9.0, 9.0, zone=19) for d in range(1, 29)]
    df = spark.createDataFrame(hot + rest, TRIP_SCHEMA).repartition(6)
    out = daily.zone_day(df, zones, rules.default_rules()).collect()
    busiest = next(r for r in out if r["location_id"] == 7)
    assert busiest["median_distance_mi"] == round(median(r[4] for r in hot), 3)


def test_totals_of_any_size(spark, zones):
    """Amounts are doubles; their sums must not vanish, whatever they add up to."""
    cases = {
        20: [6e27, 6e27, 10.0],
        21: [1e20, 2.25, -0.0],
        22: [3e28, 1e28, 5.0],
        23: [1e300, 1e300],
        24: [9.99e27, 7.0] * 40,
        25: [123456789012345678.0, 0.5],
        26: [99999999999999.5, 0.5],
    }
    rows = [ride(f"2023-06-{day}T10:00", 8, 2.0, v, v) for day, own in cases.items() for v in own]
    found = {r["date"].day: r for r in table_of(spark, zones, rows)}
    assert found[20]["yellow_revenue_usd"] == 1.2e28 and found[20]["trips"] == 3
    assert found[20]["avg_fare_usd"] == pytest.approx(4e27, rel=1e-15)
    assert found[21]["yellow_revenue_usd"] == 1e20 and found[21]["avg_fare_usd"] == 33333333333333333334.08
    assert found[22]["yellow_revenue_usd"] == 4e28 and found[22]["fare_obs"] == 3
    assert found[23]["yellow_revenue_usd"] == 2e300
    assert found[24]["yellow_revenue_usd"] == pytest.approx(9.99e27 * 40, rel=1e-15)
    assert found[25]["yellow_revenue_usd"] == 123456789012345678.5 and found[25]["avg_fare_usd"] == 61728394506172839.25
    assert found[26]["yellow_revenue_usd"] == 1e14 and found[26]["avg_fare_usd"] == 5e13


def test_means_over_very_many_values(spark):
    """Beyond 10^12 values, by counts that stand for them."""
    from decimal import Decimal

    from pyspark.sql import functions as F

    from curbline.functions.scalars import rounded_quotient

    cases = [
        (Decimal(10) ** 24 + 5, 10**15, 3, 1000000000.0),
        (Decimal(3) * 10**13 + 1, 2 * 10**13, 2, 1.5),
        (Decimal("1.0005"), 1, 3, 1.001),
        (Decimal("-1.0005"), 1, 3, -1.001),
        (Decimal("2.0009999999"), 2, 3, 1.0),
        (Decimal("2.001"), 2, 3, 1.001),
        (Decimal(-(10**26)), 3, 2, -33333333333333333333333333.33),
        (Decimal(5), 0, 2, None),
    ]
    for total, count, places, mean in cases:
        df = spark.createDataFrame([(total, count)], "t DECIMAL(38,10), n BIGINT")
        assert df.select(rounded_quotient(F.col("t"), F.col("n"), places)).first()[0] == mean


def test_stored_and_joined_middles_agree(spark, trips, zones):
    own = rules.default_rules()
    flagged = rules.flag_rows(trips, own)
    apart = daily.curated_rows(daily.daily_stats(flagged, own), daily.daily_middles(flagged, own), zones)
    assert sorted(map(str, apart.collect())) == sorted(map(str, daily.zone_day(trips, zones, own).collect()))
