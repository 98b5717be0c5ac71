"""Groups that one task sorts and groups that are spread give one table, and sums of ordinary values
give the same as sums in parts."""

import random

import pytest

from conftest import TRIP_SCHEMA, ride
from curbline.operators import daily, rules

KEYS = ["source_month", *daily.GROUP]


def rides(seed):
    """Groups of very different sizes, with values of every kind."""
    rng = random.Random(seed)
    nan, inf = float("nan"), float("inf")
    odd = [None, nan, inf, -inf, 0.1, 1 / 3, 2.345, 999999.99, 1e6, 12345678.9, 1e14, 3.3e20, 1e29, -0.0]
    rows = []
    for zone, n in [(7, 900), (19, 40), (None, 60), (500, 1), (501, 2)]:
        for _ in range(n):
            start = rng.choice(["2023-06-10T08:00", "2023-06-11T09:30", None])
            money = rng.choice([round(rng.uniform(0, 90), 2), round(rng.uniform(-9, 9), 2)])
            if zone == 19 or rng.random() < 0.02:
                money = rng.choice(odd)
            miles = rng.choice([round(rng.uniform(0, 9), 1), rng.uniform(0, 9), rng.choice(odd)])
            rows.append(ride(start, rng.randint(0, 500), miles, money, rng.choice([money, 5.25]), zone=zone))
    return rows


def table(frame):
    return sorted(map(str, frame.collect()))


@pytest.fixture(scope="module")
def odd_trips(spark):
    return spark.createDataFrame(rides(5), TRIP_SCHEMA).repartition(5)


def test_sums_of_ordinary_values_and_sums_in_parts_agree(odd_trips, zones):
    own = rules.default_rules()
    stats = daily.daily_stats(rules.flag_rows(odd_trips, own), own)
    in_parts = table(daily.curated_rows(stats, None, zones))
    assert len(in_parts) > 9 and table(daily.zone_day(odd_trips, zones, own, medians=False)) == in_parts


def test_the_size_of_a_group_does_not_show(monkeypatch, odd_trips, zones):
    own = rules.default_rules()
    found = []
    for crowded in (0, 100, 1 << 18):  # all groups spread, some of them, none
        monkeypatch.setattr(daily, "CROWDED", crowded)
        found.append(table(daily.zone_day(odd_trips, zones, own)))
    assert found[0] == found[1] == found[2]


def test_long_durations_are_added_exactly(spark, zones):
    """Beyond a billion seconds each, with a rule set that trusts them."""
    rows = [ride("2023-06-10T08:00", m, 2.0, 5.0, 6.0) for m in (20_000_000, 20_000_001, 7)]
    (r,) = daily.zone_day(spark.createDataFrame(rows, TRIP_SCHEMA), zones, []).collect()
    assert (r["duration_obs"], r["avg_duration_min"], r["median_duration_min"]) == (3, 13333336.0, 20_000_000.0)


def test_table_statistics_are_narrow(odd_trips):
    own = rules.default_rules()
    rows = daily._measured(daily._keyed(rules.flag_rows(odd_trips, own), own), own, KEYS)
    kinds = {c: t for c, t in daily._table_stats(rows, KEYS).dtypes if c not in KEYS}
    assert set(kinds.values()) == {"bigint"}


def test_rows_of_small_groups_are_moved_once(spark, tmp_path, trips, zones):
    """In the plan that ran, the only windows are those two that rank a group's values, and both read
    the one shuffle of the rows."""
    trips.write.parquet(str(tmp_path / "t"))
    out = daily.zone_day(spark.read.parquet(str(tmp_path / "t")), zones, rules.default_rules())
    assert out._jdf.queryExecution().toRdd().count() == 2
    plan = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("Window [") == 2
    assert plan.count("Exchange hashpartitioning(source_month") == 1
