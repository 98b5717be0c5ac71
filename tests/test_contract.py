"""Schema contract, drift and the columns a scan reads."""

import os
import shutil
from datetime import date

import pytest
from pyspark.sql import functions as F, types as T

from curbline.errors import DataQualityError
from curbline.operators import daily, rules
from curbline.operators.contract import BASELINE, NEEDED, REQUIRED, accept_trips, findings
from curbline.sources import adapter
from curbline.sources import months as M
from curbline.sources.layout import Layout
from curbline.sources.zones import read_zones

KINDS = {"temporal": T.TimestampNTZType(), "integer": T.LongType(), "numeric": T.DoubleType()}


def full_schema(**changed):
    types = {c: KINDS[REQUIRED.get(c, "numeric")] for c in BASELINE} | changed
    return T.StructType([T.StructField(c, t) for c, t in types.items() if t is not None])


def check(schema):
    return accept_trips({"a.parquet": schema})


def test_findings_of_all_files_are_one_table():
    files = {
        "a": full_schema(trip_distance=None, brand_new=T.LongType()),
        "b": full_schema(total_amount=T.StringType(), fare_amount=T.BooleanType()),
        "c": full_schema(),
    }
    assert [(f.file, f.column, f.found) for f in findings(files, REQUIRED)] == [
        ("a", "trip_distance", None),
        ("b", "fare_amount", "boolean"),
        ("b", "total_amount", "string"),
    ]
    with pytest.raises(DataQualityError, match="a: trip_distance: not there .*b: fare_amount: boolean is not numeric"):
        accept_trips(files)
    fit = {"a": full_schema(brand_new=T.LongType()), "b": full_schema(Airport_fee=None)}
    report = accept_trips(fit)
    assert (report.columns, report.extra, report.missing_optional) == (21, ["brand_new"], ["Airport_fee"])


def test_full_schema_has_no_drift():
    report = check(full_schema())
    assert (report.columns, report.extra, report.missing_optional) == (20, [], [])


def test_older_schema_passes_and_the_difference_shows():
    report = check(full_schema(cbd_congestion_fee=None))
    assert (report.columns, report.missing_optional) == (19, ["cbd_congestion_fee"])


def test_new_column_is_no_reason_to_fail():
    assert check(full_schema(brand_new=T.LongType())).extra == ["brand_new"]


def test_missing_required_column_fails():
    with pytest.raises(DataQualityError, match="trip_distance"):
        check(full_schema(trip_distance=None))


def test_every_wrong_type_is_listed():
    wrong = {"total_amount": T.StringType(), "PULocationID": T.DoubleType(), "tpep_pickup_datetime": T.LongType()}
    with pytest.raises(DataQualityError) as caught:
        check(full_schema(**wrong))
    assert all(c in str(caught.value) for c in wrong)


def test_kinds_are_loose():
    loose = {
        "PULocationID": T.ShortType(),
        "fare_amount": T.DecimalType(10, 2),
        "trip_distance": T.IntegerType(),
        "tpep_pickup_datetime": T.DateType(),
    }
    assert check(full_schema(**loose)).extra == []


def test_zone_file_keeps_its_words(spark, tmp_path):
    path = tmp_path / "zones.csv"
    path.write_text('LocationID,Borough,Zone,service_zone\n1,EWR,"Newark, Airport",EWR\n264,Unknown,N/A,N/A\n')
    rows = read_zones(spark, str(path)).orderBy("location_id").collect()
    assert [tuple(r) for r in rows] == [(1, "EWR", "Newark, Airport", "EWR"), (264, "Unknown", "N/A", "N/A")]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_trip_scan_reads_only_the_needed_columns(spark, tmp_path):
    layout = Layout.under(str(tmp_path))
    wide = spark.range(5).select(
        *[F.lit(None).cast(KINDS[REQUIRED.get(c, "numeric")]).alias(c) for c in BASELINE]
    )
    for month in (date(2025, 1, 1), date(2025, 2, 1)):
        wide.write.parquet(layout.month("raw", month))
    schemas = {m: M.check_month(spark, layout, m)[0] for m in (date(2025, 1, 1), date(2025, 2, 1))}
    trips = M.read_trips(spark, layout, schemas)
    text = plan(daily.daily_stats(rules.flag_rows(trips, rules.default_rules()), rules.default_rules()))
    assert text.count("FileScan") == 1  # two months, one scan
    read = text.split("ReadSchema: struct<")[1].split(">")[0]
    assert {c.split(":")[0] for c in read.split(",")} == set(NEEDED)


@pytest.mark.parametrize("first", ["a", "z"])
def test_every_file_of_a_month_is_checked(spark, tmp_path, first):
    layout, month = Layout.under(str(tmp_path)), date(2023, 6, 1)
    whole = spark.range(5).select(*[F.lit(1).cast(KINDS[k]).alias(c) if k != "temporal" else F.current_timestamp().cast("timestamp_ntz").alias(c) for c, k in REQUIRED.items()])
    other = "z" if first == "a" else "a"
    for name, df in ((first, whole), (other, whole.drop("total_amount"))):
        df.coalesce(1).write.parquet(str(tmp_path / name))
        (part,) = (tmp_path / name).glob("*.parquet")
        target = layout.month("raw", month)
        os.makedirs(target, exist_ok=True)
        shutil.copy(part, f"{target}/{name}.parquet")
    with pytest.raises(DataQualityError, match=f"{other}.parquet: .*total_amount"):
        M.check_month(spark, layout, month)


def test_files_of_unlike_types_are_read_together(spark, tmp_path):
    layout, month = Layout.under(str(tmp_path)), date(2023, 6, 1)
    at = F.lit("2023-06-05 10:00:00").cast("timestamp_ntz")
    for zone, fare in (("int", "float"), ("bigint", "decimal(9,2)")):
        spark.range(3).select(
            at.alias(NEEDED[0]), at.alias(NEEDED[1]), F.lit(4).cast(zone).alias(NEEDED[2]),
            F.lit(2.5).alias(NEEDED[3]), F.lit(7.5).cast(fare).alias(NEEDED[4]), F.lit(9.0).alias(NEEDED[5]),
        ).write.mode("append").parquet(layout.month("raw", month))
    schemas, _ = M.check_month(spark, layout, month)
    rows = M.read_trips(spark, layout, {month: schemas}).collect()
    assert len(rows) == 6 and {(r["PULocationID"], r["fare_amount"]) for r in rows} == {(4, 7.5)}


@pytest.mark.parametrize("which, unread", [("out_of_month", ["l_quantity", "l_extendedprice"]), ("trip_duration", ["l_quantity", "l_extendedprice"])])
def test_queries_read_only_what_they_use(spark, sf_dir, which, unread):
    from curbline import catalog

    text = plan(catalog.QUERIES[which](spark, sf_dir))
    read = text.split("ReadSchema: struct<")[1].split(">")[0]
    assert "l_orderkey" in read and not [c for c in unread if c in read]


def test_statistics_take_one_shuffle(spark, sf_dir):
    flagged = rules.flag_rows(adapter.trips(spark, sf_dir), rules.default_rules())
    stats = plan(daily.daily_stats(flagged, rules.default_rules()))
    assert stats.count("Exchange") == 1
    assert stats.count("HashAggregate") == 2  # combined before the shuffle
    assert "FileScan" in stats and "l_discount" not in stats
