"""Random trips, with missing values, against a plain loop over the rows."""

import random
from collections import defaultdict
from datetime import date, datetime, timedelta
from decimal import ROUND_HALF_UP, Decimal
from statistics import median

import pytest
from pyspark.sql import functions as F

from conftest import TRIP_SCHEMA
from curbline.operators import daily, rules
from curbline.sources import adapter

JAN, FEB = date(2025, 1, 1), date(2025, 2, 1)


def random_trips(seed, n=1500):
    rng = random.Random(seed)

    def maybe(value, p=0.03):
        return None if rng.random() < p else value

    rows = []
    for _ in range(n):
        month = rng.choice([JAN, FEB])
        start = datetime(month.year, month.month, 1) + timedelta(seconds=rng.randint(-90000, 31 * 86400))
        pickup = maybe(start)
        dropoff = maybe(start + timedelta(seconds=rng.choice([rng.randint(-600, 3600), rng.randint(0, 40000)])))
        miles = maybe(rng.choice([0.0, round(rng.uniform(0, 30), 2), round(rng.uniform(0, 900), 1)]))
        fare = maybe(round(rng.uniform(-20, 90), 2))
        total = maybe(rng.choice([0.0, fare if fare is not None else 5.0, round(rng.uniform(-9, 99), 2)]))
        # one zone holds a third of the rows
        zone = maybe(100 if rng.random() < 0.34 else rng.choice([264, 7]))
        rows.append((month, pickup, dropoff, zone, miles, fare, total))
    return rows


def above(x, limit):
    return x is not None and x > limit


def judge(row):
    """(flags, minutes) of one row; a comparison with a missing value is no violation."""
    month, pickup, dropoff, _, miles, fare, total = row
    known = pickup is not None and dropoff is not None
    seconds = int((dropoff - pickup).total_seconds()) if known else None
    minutes = None if seconds is None else seconds / 60
    first = datetime(month.year, month.month, 1)
    beyond = datetime(month.year, month.month + 1, 1)
    fast = above(minutes, 1) and miles is not None and miles / (minutes / 60) > 100
    flags = {
        "out_of_month": pickup is not None and not first <= pickup < beyond,
        "implausible_distance": above(miles, 300),
        "impossible_speed": fast,
        "duration_over_limit": above(minutes, 480),
        "nonpositive_duration": minutes is not None and minutes <= 0,
        "negative_fare": fare is not None and fare < 0,
        "zero_distance": miles is not None and miles <= 0,
        "zero_total": total == 0,
        "reversal": total is not None and total < 0,
    }
    return flags, minutes


def rounded(x, places):
    if x is None:
        return None
    return float(Decimal(str(x)).quantize(Decimal(1).scaleb(-places), ROUND_HALF_UP))


def mean(values):
    return sum(Decimal(repr(v)) for v in values) / len(values) if values else None


def middle_minutes(minutes):
    """From whole seconds, so that a tie is one."""
    return Decimal(median(Decimal(round(m * 60)) for m in minutes)) / 60


def by_hand(rows):
    groups = defaultdict(list)
    counts = defaultdict(lambda: defaultdict(int))
    for row in rows:
        month, pickup, _, zone, miles, fare, total = row
        flags, minutes = judge(row)
        label = "out_of_month" if flags["out_of_month"] else "reversal" if flags["reversal"] else None
        c = counts[month]
        c["input"] += 1
        c["published"] += label is None
        c["reversed"] += label == "reversal"
        c["rejected"] += label == "out_of_month"
        for name, hit in flags.items():
            c[f"r_{name}"] += hit
        bad_miles = flags["implausible_distance"] or flags["impossible_speed"] or flags["zero_distance"]
        bad_minutes = flags["duration_over_limit"] or flags["nonpositive_duration"]
        c["x_trip_distance"] += bad_miles
        c["x_duration_min"] += bad_minutes
        c["x_fare_amount"] += flags["negative_fare"]
        if label != "out_of_month":
            day = pickup.date() if pickup else None
            groups[month, day, zone].append(
                (
                    label,
                    None if bad_miles else miles,
                    None if bad_minutes else minutes,
                    None if flags["negative_fare"] else fare,
                    total,
                )
            )
    table = {}
    for key, kept in groups.items():
        trips = [k for k in kept if k[0] is None]
        m, d, f = ([k[i] for k in trips if k[i] is not None] for i in (1, 2, 3))
        gross = sum(Decimal(repr(k[4])) for k in trips if k[4] is not None)
        back = sum(Decimal(repr(k[4])) for k in kept if k[0] == "reversal")
        table[key] = (
            len(trips),
            mean(m), median(m) if m else None, len(m),
            mean(d), middle_minutes(d) if d else None, len(d),
            mean(f), len(f),
            float(gross), float(back), float(gross + back),
        )
    return table, counts


@pytest.mark.parametrize("seed", [1, 2])
def test_daily_table_and_counts(spark, zones, seed):
    rows = random_trips(seed)
    df = spark.createDataFrame(rows, TRIP_SCHEMA).repartition(5)
    own = rules.default_rules()
    table, counts = by_hand(rows)
    out = daily.zone_day(df, zones, own).collect()
    got = {(r["source_month"], r["date"], r["location_id"]): r for r in out}
    assert got.keys() == table.keys()
    for key, (n, am, mm, om, ad, md, od, af, of, gross, back, net) in table.items():
        r = got[key]
        assert (r["trips"], r["distance_obs"], r["duration_obs"], r["fare_obs"]) == (n, om, od, of)
        # the mean may sit within one unit of the last place of a tie
        for value, want, unit in (
            (r["avg_distance_mi"], am, 1e-3),
            (r["avg_duration_min"], ad, 1e-2),
            (r["avg_fare_usd"], af, 1e-2),
        ):
            assert (value is None) == (want is None)
            assert value is None or abs(value - float(want)) <= unit * 0.5001
        for value, want, places in (
            (r["median_distance_mi"], mm, 3),
            (r["median_duration_min"], md, 2),
        ):
            assert value == rounded(want, places)
        assert r["yellow_revenue_usd"] == pytest.approx(gross, abs=1e-9)
        assert r["refunds_usd"] == pytest.approx(back, abs=1e-9)
        assert r["net_revenue_usd"] == pytest.approx(net, abs=1e-9)
    metrics = daily.run_metrics(daily.daily_stats(rules.flag_rows(df, own), own)).collect()
    for r in metrics:
        c = counts[r["source_month"]]
        assert {k: r[k] for k in c} == dict(c)
        assert r["output"] == sum(k[0] == r["source_month"] for k in table)


def test_invariants_on_the_tables(spark, sf_dir):
    own = rules.default_rules()
    trips, zones = adapter.trips(spark, sf_dir), adapter.zones(spark, sf_dir)
    for r in daily.run_metrics(daily.daily_stats(rules.flag_rows(trips, own), own)).collect():
        assert r["published"] + r["reversed"] + r["rejected"] == r["input"]
        assert all(r[f"r_{rule.name}"] > 0 for rule in own)  # every rule is exercised
    table = daily.zone_day(trips, zones, own)
    broken = table.where(
        "borough IS NULL OR distance_obs > trips OR duration_obs > trips OR refunds_usd > 0"
        " OR isnan(yellow_revenue_usd) OR abs(yellow_revenue_usd + refunds_usd - net_revenue_usd) > 0.001"
    )
    assert broken.count() == 0
    assert table.groupBy("source_month", "date", "location_id").count().where(F.col("count") > 1).count() == 0
