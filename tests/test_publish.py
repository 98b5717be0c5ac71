"""The whole way from raw files to published months, on small files."""

import os
from datetime import UTC, date, datetime

import pytest
from pyspark.sql import functions as F

from conftest import CASES, TRIP_SCHEMA, ride
from curbline.config import Thresholds
from curbline.errors import DataQualityError
from curbline.operators.contract import BASELINE, CURATED
from curbline.plans import history, publish
from curbline.plans.detect import candidate_months, detect
from curbline.sources import months as M
from curbline.sources.layout import Layout

JUN, JUL = date(2023, 6, 1), date(2023, 7, 1)
LOOSE = Thresholds(max_reject_ratio=0.5, max_reversal_ratio=0.5, max_null_ratio_distance=0.5,
                   max_null_ratio_duration=0.5, max_volume_delta=5.0)


def july(n=13):
    return [ride(f"2023-07-{3 + i % 9:02d}T10:00", 30, 5.0, 10.0, 12.0, month=JUL) for i in range(n)]


def put(spark, layout, month, rows, cast=None):
    df = spark.createDataFrame(rows, TRIP_SCHEMA).drop("source_month").withColumn("VendorID", F.lit(1))
    for column, kind in (cast or {}).items():
        df = df.withColumn(column, F.col(column).cast(kind))
    df.write.mode("overwrite").parquet(layout.month("raw", month))


@pytest.fixture
def layout(spark, tmp_path):
    out = Layout.under(str(tmp_path))
    put(spark, out, JUN, CASES)
    put(spark, out, JUL, july(), {"PULocationID": "int", "fare_amount": "float"})
    return out


def read(spark, layout, area):
    return spark.read.parquet(layout.base(area))


def test_publish_two_months_of_unlike_types(spark, layout, zones):
    assert publish.publish_months(spark, layout, [JUN, JUL], zones, LOOSE) == [JUN, JUL]
    stored = spark.read.parquet(layout.month("curated", JUN))
    assert stored.columns == CURATED
    rows = stored.orderBy("date", "location_id").collect()
    assert [r["borough"] for r in rows] == ["North", "South"]
    assert rows[0]["net_revenue_usd"] == 313.45
    out = read(spark, layout, "rejects").collect()
    assert sorted(r["reject_reason"] for r in out) == ["out_of_month", "out_of_month", "reversal"]
    runs = publish.read_runs(spark, layout).orderBy("source_month").collect()
    assert [r["rows"]["input"] for r in runs] == [13, 13]
    assert runs[0]["rules"]["impossible_speed"] == 2
    assert runs[0]["schema"]["extra"] == []
    assert len(runs[0]["schema"]["missing_optional"]) == len(BASELINE) - 7
    assert runs[0]["thresholds"]["max_volume_delta"] == 5.0
    assert M.stored_months(spark, layout) == [JUN, JUL]
    assert M.read_curated(spark, layout).count() == 11


def test_rerun_replaces_one_month_and_keeps_history(spark, layout, zones):
    publish.publish_months(spark, layout, [JUN, JUL], zones, LOOSE)
    before = sorted(map(str, spark.read.parquet(layout.month("curated", JUN)).collect()))
    publish.publish_months(spark, layout, [JUN], zones, LOOSE)
    assert sorted(map(str, spark.read.parquet(layout.month("curated", JUN)).collect())) == before
    assert spark.read.parquet(layout.month("curated", JUL)).count() == 9
    runs = history.runs_history(publish.read_runs(spark, layout))
    june = runs.where(F.col("source_month") == F.lit(JUN)).collect()
    assert [r["previous_version_input"] for r in june] == [13, None]
    assert june[0]["rows"]["prev_version_input"] == 13


def test_rerun_without_excluded_rows_leaves_none_behind(spark, layout, zones):
    publish.publish_months(spark, layout, [JUN], zones, LOOSE)
    assert read(spark, layout, "rejects").count() == 3
    put(spark, layout, JUN, [r for r in CASES if r[-1] >= 0 and r[1].month == 6])
    publish.publish_months(spark, layout, [JUN], zones, LOOSE)
    assert spark.read.parquet(layout.month("rejects", JUN)).count() == 0


def test_a_failing_month_does_not_stop_the_others(spark, layout, zones):
    strict = Thresholds(max_volume_delta=5.0)  # June breaks the quarantine budget
    with pytest.raises(DataQualityError, match="2023-06: gate rejected"):
        publish.publish_months(spark, layout, [JUN, JUL], zones, strict)
    assert M.stored_months(spark, layout) == [JUL]
    assert [r["source_month"] for r in publish.read_runs(spark, layout).collect()] == [JUL]


def test_contract_failure_and_absent_raw_are_reported(spark, layout, zones):
    put(spark, layout, JUN, CASES, {"total_amount": "string"})
    with pytest.raises(DataQualityError, match="total_amount: string is not numeric.*2023-08: nothing stored"):
        publish.publish_months(spark, layout, [JUN, JUL, date(2023, 8, 1)], zones, LOOSE)
    assert M.stored_months(spark, layout) == [JUL]


def test_volume_gate_uses_the_last_run_of_the_month_before(spark, layout, zones):
    publish.publish_months(spark, layout, [JUN], zones, LOOSE)
    put(spark, layout, JUL, july(30))
    with pytest.raises(DataQualityError, match="2023-07: gate volume"):
        publish.publish_months(spark, layout, [JUL], zones, Thresholds())


def test_old_partition_is_named(spark, layout, zones):
    publish.publish_months(spark, layout, [JUL], zones, LOOSE)
    path = layout.month("curated", JUL)
    rows = [tuple(r) for r in spark.read.parquet(path).drop("fare_obs").collect()]
    schema = spark.read.parquet(path).drop("fare_obs").schema
    spark.createDataFrame(rows, schema).write.mode("overwrite").parquet(path)
    with pytest.raises(DataQualityError, match="2023-07 lacks columns .*fare_obs"):
        M.read_curated(spark, layout)


def test_inventory_state_and_detection(spark, layout, zones):
    inventory = M.file_inventory(spark, layout)
    assert {r["source_month"] for r in inventory.collect()} == {JUN, JUL}
    assert all(r["sha256"] is None for r in inventory.collect())
    hashed = {r["source_month"]: r["sha256"] for r in M.file_inventory(spark, layout, content_hash=True).collect()}
    assert len(set(hashed.values())) == 2 and all(len(h) == 64 for h in hashed.values())
    publish.record_state(inventory, layout, datetime(2023, 9, 1))
    publish.publish_months(spark, layout, [JUN], zones, LOOSE, inventory=inventory)
    assert publish.read_runs(spark, layout).first()["source"]["etag"]

    def reasons():
        window = candidate_months(spark, date(2023, 9, 10))
        done = spark.createDataFrame([(m,) for m in M.stored_months(spark, layout)], "source_month DATE")
        seen = detect(window, M.file_inventory(spark, layout), publish.read_state(spark, layout), done)
        return {r["source_month"]: r["reason"] for r in seen.collect() if r["published"]}

    assert reasons() == {JUN: None, JUL: "missing_output"}
    put(spark, layout, JUN, CASES[:5])
    assert reasons()[JUN] == "etag_changed"
    publish.record_state(M.file_inventory(spark, layout), layout)
    assert reasons()[JUN] is None  # the newest fingerprint counts


def test_checks_are_recorded_also_when_they_fail(spark, layout, zones):
    inventory = M.file_inventory(spark, layout)
    publish.record_state(inventory, layout)
    today = date(2023, 9, 10)
    with pytest.raises(DataQualityError, match="without output: 2023-06, 2023-07"):
        publish.check_freshness(spark, layout, inventory, today)
    publish.publish_months(spark, layout, [JUN, JUL], zones, LOOSE)
    publish.check_freshness(spark, layout, inventory, today, trigger="daily")
    stored = publish.read_checks(spark, layout).agg(F.max("checked_at")).first()[0]
    now = datetime.now(UTC).replace(tzinfo=None)
    assert abs((now - stored).total_seconds()) < 600  # UTC, whatever the session time zone
    seen = inventory.agg(F.max("last_modified")).first()[0]
    assert abs((now - seen).total_seconds()) < 3600
    publish.check_freshness(spark, layout, inventory, today, record=False)
    with pytest.raises(DataQualityError, match="the limit is 120"):
        publish.check_freshness(spark, layout, inventory, date(2024, 2, 1), "2023-06", "2023-07")
    checks = history.recent_checks(publish.read_checks(spark, layout)).collect()
    assert [c["status"] for c in checks] == ["failed", "ok", "failed"]
    assert checks[1]["trigger"] == "daily" and checks[1]["changed"] == []
    assert checks[1]["source_newest"] == "2023-07" and checks[0]["total"] == 3


def test_month_without_rows_fails_its_gate(spark, layout, zones):
    put(spark, layout, JUL, [])
    with pytest.raises(DataQualityError, match="2023-07: gate no_rows"):
        publish.publish_months(spark, layout, [JUN, JUL], zones, LOOSE)
    assert M.stored_months(spark, layout) == [JUN]


def test_reading_one_month_prunes_the_others(spark, layout):
    schemas = {m: M.check_month(spark, layout, m)[0] for m in (JUN, JUL)}
    trips = M.read_trips(spark, layout, schemas).where(F.col("source_month") == F.lit(JUN))
    text = trips._jdf.queryExecution().executedPlan().toString()
    filters = text.split("PartitionFilters: [")[1].split("PushedFilters")[0]
    assert "make_date(year" in filters and "2023-06-01" in filters


def test_files_are_sorted_and_a_month_is_few_files(spark, layout, zones):
    import glob

    import pyarrow.parquet as pq

    rows = [ride(f"2023-07-{1 + i % 28:02d}T10:00", 20, 2.0, 9.0, 9.0, zone=1 + i % 60, month=JUL) for i in range(1500)]
    put(spark, layout, JUL, rows)
    publish.publish_months(spark, layout, [JUN, JUL], zones, LOOSE.__class__(max_reject_ratio=0.5, max_volume_delta=500.0, max_reversal_ratio=0.5, max_null_ratio_distance=0.5, max_null_ratio_duration=0.5))
    files = glob.glob(layout.month("curated", JUL) + "/*.parquet")
    assert 1 <= len(files) <= 8
    for f in files:
        table = pq.read_table(f, columns=["date", "location_id"]).to_pylist()
        keys = [(r["date"], r["location_id"]) for r in table]
        assert keys == sorted(keys)


def test_a_month_of_only_rejected_rows_is_published_empty(spark, layout, zones):
    put(spark, layout, JUL, [r for r in CASES if r[1].month != 7])  # other months' rows in July's file
    all_out = Thresholds(max_reject_ratio=1.0, max_reversal_ratio=1.0, max_null_ratio_distance=1.0,
                         max_null_ratio_duration=1.0, max_volume_delta=9.0)
    publish.publish_months(spark, layout, [JUL], zones, all_out)
    assert M.stored_months(spark, layout) == [JUL]
    assert spark.read.parquet(layout.month("curated", JUL)).count() == 0
    run = publish.read_runs(spark, layout).first()
    assert (run["rows"]["rejected"], run["rows"]["output"]) == (12, 0)


def reasons(spark, layout, today=date(2023, 9, 10)):
    done = spark.createDataFrame([(m,) for m in M.stored_months(spark, layout)], "source_month DATE")
    seen = detect(candidate_months(spark, today), M.file_inventory(spark, layout), publish.read_state(spark, layout), done)
    return {r["source_month"]: r["reason"] for r in seen.collect() if r["published"]}


def test_a_published_month_needs_no_more_work(spark, layout, zones):
    assert reasons(spark, layout) == {JUN: "new", JUL: "new"}
    publish.publish_months(spark, layout, [JUN, JUL], zones, LOOSE)
    assert reasons(spark, layout) == {JUN: None, JUL: None}
    put(spark, layout, JUL, july(9))
    assert reasons(spark, layout) == {JUN: None, JUL: "etag_changed"}


def test_process_does_what_is_needed_once(spark, layout, zones):
    loaded = []

    def go(**options):
        inventory = M.file_inventory(spark, layout)
        return publish.process(spark, layout, inventory, date(2023, 9, 10), zones, loaded.append, limits=LOOSE, **options)

    assert go() == [JUN, JUL] and loaded == [JUN, JUL]
    assert go() == []
    assert go(force=True, first="2023-06") == [JUN] and loaded == [JUN, JUL]  # the raw copy is reused


def test_an_unreadable_month_leaves_the_others(spark, layout, zones):
    import glob

    (path, *_) = glob.glob(layout.month("raw", JUN) + "/*.parquet")
    data = bytearray(open(path, "rb").read())
    data[4:60] = bytes(56)  # pages, not the footer
    open(path, "wb").write(data)
    for crc in glob.glob(layout.month("raw", JUN) + "/.*.crc"):
        os.remove(crc)
    with pytest.raises(DataQualityError, match="2023-06: cannot be read"):
        publish.publish_months(spark, layout, [JUN, JUL], zones, LOOSE)
    assert M.stored_months(spark, layout) == [JUL]


def test_stored_old_runs_are_read_translated(spark, layout, zones):
    publish.publish_months(spark, layout, [JUN], zones, LOOSE)
    stored = spark.read.parquet(layout.table("runs"))
    rows = F.col("rows").withField("reversed", F.lit(None).cast("bigint")).withField("rejected", F.lit(3).cast("bigint"))
    old = F.create_map(F.lit("nonpositive_total"), F.lit(2).cast("bigint"))
    kept = [tuple(r) for r in stored.withColumn("rows", rows).withColumn("rules", old).collect()]
    spark.createDataFrame(kept, stored.schema).write.mode("overwrite").parquet(layout.table("runs"))
    run = publish.read_runs(spark, layout).first()
    assert (run["rows"]["reversed"], run["rows"]["rejected"], run["rules"]["reversal"]) == (2, 1, 2)


def test_a_load_that_fails_leaves_the_others(spark, layout, zones):
    def load(month):
        if month == JUN:
            raise OSError("the line was cut")

    inventory = M.file_inventory(spark, layout)
    with pytest.raises(DataQualityError, match="2023-06: cannot be loaded: the line was cut"):
        publish.process(spark, layout, inventory, date(2023, 9, 10), zones, load, limits=LOOSE)
    assert M.stored_months(spark, layout) == [JUL]
    assert reasons(spark, layout) == {JUN: "new", JUL: None}


def test_what_was_loaded_is_recorded_and_a_move_reported(spark, layout, zones):
    def load(month):
        return {"etag": "newer", "bytes": 77} if month == JUL else None

    inventory = M.file_inventory(spark, layout)
    assert publish.process(spark, layout, inventory, date(2023, 9, 10), zones, load, limits=LOOSE) == [JUN, JUL]
    runs = {r["source_month"]: r["source"] for r in publish.read_runs(spark, layout).collect()}
    assert (runs[JUN]["moved"], runs[JUL]["moved"]) == (False, True)
    assert (runs[JUL]["etag"], runs[JUL]["bytes"]) == ("newer", 77) and runs[JUL]["url"]
    state = {r["source_month"]: r["etag"] for r in publish.read_state(spark, layout).collect()}
    assert state[JUL] == "newer" and state[JUN] == runs[JUN]["etag"]


def test_an_unreadable_file_is_named(spark, layout, zones):
    import glob

    (path, *_) = glob.glob(layout.month("raw", JUN) + "/*.parquet")
    data = bytearray(open(path, "rb").read())
    data[4:60] = bytes(56)
    open(path, "wb").write(data)
    for crc in glob.glob(layout.month("raw", JUN) + "/.*.crc"):
        os.remove(crc)
    with pytest.raises(DataQualityError, match=os.path.basename(path)):
        publish.publish_months(spark, layout, [JUN, JUL], zones, LOOSE)
    assert M.stored_months(spark, layout) == [JUL]
