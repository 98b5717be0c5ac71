"""What keeps time and memory in bounds when months have many zones."""

import random

import pytest

from conftest import TRIP_SCHEMA, ride
from curbline import catalog
from curbline.operators import daily, ranking, rules, slices


@pytest.fixture(scope="module")
def town(spark):
    """Zones of different sizes, ties among them, zones that only pay back, and trips without a zone."""
    rng = random.Random(11)
    rows = []
    for zone in [*range(40), None]:
        for _ in range(rng.choice([3, 3, 5, 8])):
            start = rng.choice(["2023-06-10T08:00", "2023-06-11T09:30"])
            total = -4.0 if zone in (5, 6) else rng.choice([7.5, 12.25, -3.0])
            rows.append(ride(start, rng.randint(1, 90), rng.randint(1, 99) / 10, 6.5, total, zone=zone))
    return spark.createDataFrame(rows, TRIP_SCHEMA).repartition(3)


def plan_of(frame):
    frame._jdf.queryExecution().toRdd().count()
    return frame._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def lines(frame):
    return sorted(map(str, frame.collect()))


def test_trips_per_zone_are_those_of_the_table(town, zones):
    own = rules.default_rules()
    whole = slices.zone_slices(daily.zone_day(town, zones, own, medians=False))
    assert lines(daily.zone_trips(town, own)) == lines(whole.select("source_month", "location_id", "trips"))


@pytest.mark.parametrize("top", [1, 12, 60])
def test_the_busiest_zones_alone_give_the_same_report(town, zones, top):
    own = rules.default_rules()
    whole = slices.zone_slices(daily.zone_day(town, zones, own), medians=True)
    shown = ranking.busiest_zones(daily.zone_trips(town, own), top)
    some = slices.zone_slices(daily.zone_day(daily.trips_of(town, shown), zones, own), medians=True)
    want = lines(ranking.mean_vs_median(whole, top))
    assert len(want) == min(top, 41) and lines(ranking.mean_vs_median(some, top)) == want


def test_only_the_trips_of_shown_zones_are_read_on(spark, sf_dir):
    """mean_vs_median moves the trips of at most twelve zones a month for sums and medians."""
    frame = catalog.mean_vs_median(spark, sf_dir)
    assert "LeftSemi" in plan_of(frame) and "_location_id" in plan_of(frame)


def test_medians_by_themselves_are_those_of_the_table(monkeypatch, town, zones):
    own = rules.default_rules()
    for crowded in (0, 6, 1 << 18):  # all groups spread, some of them, none
        monkeypatch.setattr(daily, "CROWDED", crowded)
        alone = daily.day_medians(town, zones, own)
        assert lines(alone) == lines(daily.zone_day(town, zones, own).select(*alone.columns))


def test_a_task_holds_its_share_of_groups_on_any_cluster(monkeypatch, spark, town, zones, tmp_path):
    """Rows of small groups are dealt to a number of partitions that is no setting of the cluster, and
    no task adds up groups before that; tables with and without medians agree."""
    monkeypatch.setattr(daily, "DEALT", 13)
    town.write.parquet(str(tmp_path / "t"))
    stored, own = spark.read.parquet(str(tmp_path / "t")), rules.default_rules()
    plain = daily.zone_day(stored, zones, own, medians=False)
    for frame in (plain, daily.zone_day(stored, zones, own), daily.day_medians(stored, zones, own)):
        dealt = [x for x in plan_of(frame).splitlines() if "Exchange hashpartitioning(source_month" in x]
        assert len(dealt) == 1 and ", 13), REPARTITION_BY_NUM" in dealt[0]
    shared = [c for c in plain.columns if not c.startswith("median_")]
    whole = lines(plain)
    assert lines(plain.select(*shared)) == lines(daily.zone_day(stored, zones, own).select(*shared))
    monkeypatch.setattr(daily, "CROWDED", 0)  # all groups spread
    assert lines(daily.zone_day(stored, zones, own, medians=False)) == whole


def test_groups_are_sorted_by_a_digest_first(spark, town, zones, tmp_path):
    """A month tells few groups apart; sorting then compares whole rows."""
    town.write.parquet(str(tmp_path / "t"))
    plan = plan_of(daily.day_medians(spark.read.parquet(str(tmp_path / "t")), zones, rules.default_rules()))
    assert plan.count("Sort [_digest#") == 2


def test_crowded_groups_are_counted_without_the_rules(town):
    counted = daily._by_size(daily._keyed(rules.flag_rows(town, rules.default_rules()), rules.default_rules()), ["source_month"])[1]
    plan = counted._jdf.queryExecution().optimizedPlan().toString()
    below = plan[plan.index("Aggregate [_bucket"):]
    assert "trip_distance#" not in below.splitlines()[1] and "reject_reason" not in below
