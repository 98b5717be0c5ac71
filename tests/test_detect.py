"""Detection, freshness and ingest planning on small tables."""

from datetime import date, datetime

import pytest

from curbline.config import Thresholds
from curbline.functions.calendar import lookback, month_range
from curbline.plans import detect as D, history as H

MAY = date(2031, 5, 1)
TABLE = "source_month DATE, etag STRING"


def months(spark, *days):
    return spark.createDataFrame([(d,) for d in days], "source_month DATE")


def table(spark, **etags):
    rows = [(date(2031, int(k[1:]), 1), v) for k, v in etags.items()]
    return spark.createDataFrame(rows, TABLE)


def reason(spark, inventory, state, outputs, force=False):
    seen = D.detect(months(spark, MAY), inventory, state, outputs, force)
    return seen.first()["reason"]


@pytest.mark.parametrize(
    "today, months, newest, oldest",
    [
        (date(2019, 3, 31), 4, date(2019, 2, 1), date(2018, 11, 1)),
        (date(2020, 1, 1), 1, date(2019, 12, 1), date(2019, 12, 1)),
        (date(2021, 12, 5), 24, date(2021, 11, 1), date(2019, 12, 1)),
    ],
)
def test_lookback(today, months, newest, oldest):
    found = lookback(today, months)
    assert found == sorted(set(found), reverse=True) and len(found) == months
    assert (found[0], found[-1]) == (newest, oldest)


def test_month_range():
    assert month_range("2019-12", "2020-02") == [date(2019, 12, 1), date(2020, 1, 1), date(2020, 2, 1)]
    assert month_range("2020-02", None) == [date(2020, 2, 1)] == month_range(None, "2020-02")
    assert month_range(None, None) is None
    with pytest.raises(ValueError, match="backwards"):
        month_range("2020-02", "2019-12")


def test_reasons_in_order(spark):
    none, out = months(spark), months(spark, MAY)
    a, b, empty = table(spark, m5="a"), table(spark, m5="b"), table(spark)
    no_mark = table(spark, m5=None)
    assert reason(spark, empty, empty, none) is None  # not published is no work
    assert reason(spark, a, empty, none) == "new"
    assert reason(spark, a, a, out) is None
    assert reason(spark, b, a, out) == "etag_changed"
    assert reason(spark, a, a, none) == "missing_output"
    assert reason(spark, a, a, out, force=True) == "force"
    assert reason(spark, empty, empty, none, force=True) is None
    assert reason(spark, no_mark, no_mark, out) is None  # both without a mark: unchanged
    assert reason(spark, no_mark, a, out) == "etag_changed"
    work = D.work(D.detect(months(spark, MAY), b, a, out)).collect()
    assert [tuple(r) for r in work] == [(MAY, "b", "etag_changed")]


def verdict(spark, inventory, state, outputs, today=date(2031, 6, 20), limits=Thresholds()):
    seen = D.detect(months(spark, MAY, date(2031, 4, 1)), inventory, state, outputs)
    return D.freshness(seen, today, limits).first()


def test_freshness_order(spark):
    a, empty = table(spark, m5="a"), table(spark)
    out, none = months(spark, MAY), months(spark)
    ok = verdict(spark, a, a, out)
    assert (ok["status"], ok["changed"], ok["checked"]) == ("ok", [], ["2031-04", "2031-05"])
    assert (ok["source_newest"], ok["source_age_days"]) == ("2031-05", 19)
    assert "without output: 2031-05" in verdict(spark, a, a, none, date(2035, 1, 1))["detail"]
    assert "no published month" in verdict(spark, empty, empty, none)["detail"]
    assert "the limit is 120" in verdict(spark, a, a, out, date(2031, 10, 1))["detail"]
    assert verdict(spark, a, a, out, date(2031, 9, 29))["status"] == "ok"  # 120 days is not over


def test_gaps(spark):
    gaps = D.ingest_gaps(months(spark, MAY, date(2031, 4, 1)), table(spark, m5="a"), months(spark))
    assert [r["source_month"] for r in gaps.collect()] == [MAY]


def test_ingest_plan(spark):
    expected = table(spark, m1="a", m2="a", m3="a", m4="a", m5=None)
    inventory = table(spark, m1="a", m2="b", m3="a", m5="x")
    state = table(spark, m1="a", m2="a", m3="a", m5="x")
    raw = months(spark, date(2031, 1, 1), date(2031, 2, 1), MAY)
    rows = D.ingest_plan(expected, inventory, state, raw).orderBy("source_month").collect()
    assert [(r["action"], r["moved"]) for r in rows] == [
        ("reuse", False),
        ("load", True),  # the source moved on since detection
        ("load", False),  # no raw copy
        ("unpublished", False),
        ("reuse", False),
    ]


RUN = """run_id STRING, source_month DATE, written_at TIMESTAMP_NTZ,
    rows STRUCT<input: BIGINT, reversed: BIGINT, rejected: BIGINT>, rules MAP<STRING, BIGINT>"""


def run(rid, month, day, rows, rules=None):
    return (rid, date(2031, month, 1), datetime(2031, 6, day), rows, rules or {"reversal": 1})


def test_newest_run_is_by_time_not_by_name(spark):
    rows = [run("zz", 5, 1, (10, 1, 0)), run("aa", 5, 2, (20, 1, 0)), run("m", 4, 1, (5, 0, 0))]
    runs = spark.createDataFrame(rows, RUN)
    assert {r["run_id"] for r in H.latest_runs(runs).collect()} == {"aa", "m"}
    listed = H.runs_history(runs).collect()
    assert [(r["run_id"], r["previous_version_input"]) for r in listed] == [("aa", 10), ("zz", None), ("m", None)]


def test_old_runs_are_translated(spark):
    rows = [
        run("old", 5, 1, (100, None, 12), {"nonpositive_total": 10, "out_of_month": 2}),
        run("new", 5, 2, (100, 9, 2), {"reversal": 9, "out_of_month": 2}),
        run("odd", 5, 3, (100, None, 2), {"out_of_month": 2}),
    ]
    out = {r["run_id"]: r for r in H.upgrade_runs(spark.createDataFrame(rows, RUN)).collect()}
    assert out["old"]["rules"] == {"reversal": 10, "out_of_month": 2}
    assert (out["old"]["rows"]["reversed"], out["old"]["rows"]["rejected"]) == (10, 2)
    assert out["old"]["reversals_estimated"] and not out["new"]["reversals_estimated"]
    assert out["new"]["rows"]["reversed"] == 9 and out["odd"]["rows"]["reversed"] is None


def test_stale_checks(spark):
    checks = spark.createDataFrame([(datetime(2031, 6, 1, 6),), (datetime(2031, 6, 2, 6),)], "checked_at TIMESTAMP_NTZ")
    assert not H.stale_checks(checks, datetime(2031, 6, 4, 6)).first()["stale"]
    late = H.stale_checks(checks, datetime(2031, 6, 4, 6, 0, 1)).first()
    assert late["stale"] and late["hours"] > 48
