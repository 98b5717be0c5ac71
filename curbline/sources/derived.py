"""Histories and source tables derived from the order tables, for queries and benchmarks.

A month of trips comes in two deliveries (by line status), so each month has two runs: one
over the first delivery and one over both. The source side is derived from ``orders``: one
source month per order month, fingerprinted by what it holds.
"""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..config import Thresholds
from ..functions.scalars import month_label, next_month
from ..operators import daily, rules as R
from . import adapter

MONTH = "source_month"
TODAY = date(2001, 12, 12)
NOW = datetime(2001, 8, 4, 0, 0, 0)


def _pairs(prefix: str, names) -> Column:
    return F.create_map(*[x for n in names for x in (F.lit(n), F.col(prefix + n))])


def run_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run metrics per (month, version): version 2 covers both deliveries."""
    rules = R.default_rules()
    flagged = R.flag_rows(adapter.trips(spark, sf_dir, delivery=True), rules)
    stats = daily.daily_stats(flagged, rules, (MONTH, "delivery"))
    counts = daily.count_columns(stats)
    versions = F.sequence(F.col("delivery"), F.lit(2))
    cumulated = (
        stats.withColumn("version", F.explode(versions))
        .groupBy(MONTH, "version", *daily.GROUP)
        .agg(*[F.sum(c).alias(c) for c in counts])
    )
    return daily.run_metrics(cumulated, (MONTH, "version"))


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The run history, with the columns the reports read."""
    rules = R.default_rules()
    written = F.timestamp_add(
        "DAY", F.lit(10) * F.col("version"), next_month(F.col(MONTH)).cast("timestamp_ntz")
    )
    limits = [F.lit(x) for pair in Thresholds().limits().items() for x in pair]
    kinds = ["input", "published", "reversed", "rejected", "output"]
    return run_counts(spark, sf_dir).select(
        F.format_string("r-%s-v%d", month_label(F.col(MONTH)), "version").alias("run_id"),
        MONTH,
        written.alias("written_at"),
        F.when(F.col("version") == 1, "scheduled").otherwise("manual").alias("trigger"),
        F.struct(*kinds).alias("rows"),
        _pairs("r_", [r.name for r in rules]).alias("rules"),
        _pairs("x_", list(R.nulling_flags(rules))).alias("nulled"),
        F.create_map(*limits).alias("thresholds"),
        (F.col("input") / F.lit(1000.0)).alias("seconds"),
    )


def old_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The history as if every first version had been written before the reversal rule."""
    old = F.col("run_id").endswith("-v1")
    rules = F.col("rules")
    both = rules["reversal"] + rules["zero_total"]
    kept = F.map_filter("rules", lambda k, _: ~k.isin("reversal", "zero_total"))
    former = F.map_concat(kept, F.create_map(F.lit("nonpositive_total"), both))
    rows = F.col("rows").withField("rejected", F.col("rows.rejected") + both).withField(
        "reversed", F.lit(None).cast("bigint")
    )
    return runs(spark, sf_dir).withColumns(
        {
            "rules": F.when(old, former).otherwise(rules),
            "rows": F.when(old, rows).otherwise(F.col("rows")),
        }
    )


def _order_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = adapter.table(spark, sf_dir, "orders")
    settled = F.col("o_orderstatus") != "P"
    day = F.col("o_orderdate")
    return orders.groupBy(F.trunc(day.cast("date"), "month").alias(MONTH)).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("o_orderkey").alias("keys"),
        F.count_if(settled).alias("settled_n"),
        F.coalesce(F.sum(F.when(settled, F.col("o_orderkey"))), F.lit(0)).alias("settled_keys"),
        F.max(day).cast("timestamp_ntz").alias("last_order"),
    )


def _etag(n: str, keys: str) -> Column:
    mark = F.concat_ws("-", F.col(n).cast("string"), F.col(keys).cast("string"))
    # every March the source sends no fingerprint
    return F.when(F.month(MONTH) != 3, mark)


def inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the source publishes: every order month."""
    return _order_months(spark, sf_dir).select(
        MONTH, _etag("n", "keys").alias("etag"), F.col("last_order").alias("last_modified"),
        (F.col("n") * 100).alias("bytes"),
    )


def state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What was loaded: months before 2001, the Junes before their open orders settled."""
    june = F.month(MONTH) == 6
    etag = F.when(june, _etag("settled_n", "settled_keys")).otherwise(_etag("n", "keys"))
    return _order_months(spark, sf_dir).where(F.col(MONTH) < "2001-01-01").select(
        MONTH, etag.alias("etag")
    )


def outputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Months with a published partition: the loaded ones but for the Septembers."""
    return state(spark, sf_dir).where(F.month(MONTH) != 9).select(MONTH)


def raw_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Months whose raw copy is still there: the loaded ones but for the Aprils."""
    return state(spark, sf_dir).where(F.month(MONTH) != 4).select(MONTH)


def detected_earlier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What detection saw: the inventory, the Decembers before their open orders settled."""
    december = F.month(MONTH) == 12
    etag = F.when(december, _etag("settled_n", "settled_keys")).otherwise(_etag("n", "keys"))
    return _order_months(spark, sf_dir).select(MONTH, etag.alias("etag"))


def checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One check per order month, thirty hours after its last order."""
    failed = F.month(MONTH) == 9
    label = month_label(F.col(MONTH))
    window = F.sequence(F.add_months(MONTH, -5), F.col(MONTH), F.expr("interval 1 month"))
    return _order_months(spark, sf_dir).select(
        F.concat(F.lit("c-"), label).alias("check_id"),
        F.timestamp_add("HOUR", F.lit(30), F.col("last_order")).alias("checked_at"),
        F.lit("daily").alias("trigger"),
        F.transform(window, month_label).alias("checked"),
        F.when(failed, F.array()).otherwise(F.array(label)).alias("changed"),
        label.alias("source_newest"),
        F.when(failed, "failed").otherwise("ok").alias("status"),
        F.when(failed, F.concat(F.lit("published months without output: "), label)).alias("detail"),
    )


def outlined(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zones a map outlines: all but those of one region."""
    return adapter.zones(spark, sf_dir).where(F.col("borough") != "AFRICA")


def outlines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outlines with names of their own, some of them for places no trip starts in."""
    known = outlined(spark, sf_dir).select(
        "location_id", F.col("service_zone").alias("name"), F.lit("outline").alias("borough")
    )
    named = F.when(F.col("n_regionkey") != 0, F.col("n_name"))
    other = adapter.table(spark, sf_dir, "nation").select(
        (F.col("n_nationkey") - 1000).cast("int").alias("location_id"),
        named.alias("name"),
        F.when(F.col("n_regionkey") != 0, F.lit("outline")).alias("borough"),
    )
    return known.unionByName(other)


def month_span(months: DataFrame) -> DataFrame:
    """All months from the first to the last of a table."""
    return months.agg(F.min(MONTH).alias("first"), F.max(MONTH).alias("last")).select(
        F.explode(F.expr("sequence(first, last, interval 1 month)")).alias(MONTH)
    )


def expected_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The months of the trips and one more that has none."""
    months = adapter.trips(spark, sf_dir).select(MONTH).distinct()
    return months.union(months.agg(next_month(F.max(MONTH)).alias(MONTH)))
