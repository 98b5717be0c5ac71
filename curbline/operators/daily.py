"""The published table: one row per (month, pickup day, pickup zone)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..functions.scalars import (
    add_cents,
    cents,
    finite,
    is_small,
    round_half,
    rounded_mean,
    rounded_quotient,
    rounded_sum,
    sum_parts,
    whole_quotient,
    whole_sum,
)
from .contract import CURATED, unique_dimension
from .order_stats import MEDIAN_POSITIONS, median_of, values_at
from .rules import PUBLISHED, Rule, any_flag, flag_rows, nulling_flags, reversal, trusted

GROUP = ["date", "location_id"]
MEASURED = ["trip_distance", "fare_amount", "total_amount"]
MIDDLES = ["distance_0", "distance_1", "seconds_0", "seconds_1"]  # the two middle values of each


SECONDS = "_seconds BETWEEN -1000000000 AND 1000000000"  # durations that are summed in 64 bits
BUCKETS = 1 << 16  # by a hash of month and zone
CROWDED = 1 << 18  # rows of a bucket whose groups are spread over all tasks
DEALT = 200  # partitions for the rows of all other groups: a task's memory is their share, on any cluster
VALUES = {
    "distance": "_miles",
    "fare": "_fare",
    "revenue": "CASE WHEN NOT _reversed THEN _total END",
    "refund": "CASE WHEN _reversed THEN _total END",
}


def _keyed(flagged: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    return flagged.withColumns(
        {
            "date": F.expr(f"to_date({trusted('tpep_pickup_datetime', rules)})"),
            "location_id": F.expr(f"cast({trusted('PULocationID', rules)} AS int)"),
        }
    )


def _measured(keyed: DataFrame, rules: Sequence[Rule], keys: Sequence[str]) -> DataFrame:
    """The rows with what the published table is made of and nothing else. ``_reversed`` is null for
    rows that are quarantined."""

    def published(column: str) -> str:
        return f"CASE WHEN {PUBLISHED} THEN {trusted(column, rules)} END"

    cancels = reversal(rules)
    return keyed.selectExpr(
        *keys,
        f"CASE WHEN {PUBLISHED} THEN false WHEN {cancels} THEN true END AS _reversed",
        f"{published('trip_distance')} AS _miles",
        f"CASE WHEN ({published('duration_min')}) IS NOT NULL THEN duration_s END AS _seconds",
        f"{published('fare_amount')} AS _fare",
        f"CASE WHEN {PUBLISHED} OR {cancels} THEN {trusted('total_amount', rules)} END AS _total",
    )


def _table_stats(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """What the published table needs of ``_measured`` rows: counts, and sums of ordinary values in
    64 bits, a quarter of the width of sums in parts."""
    measures = {
        "published": "count_if(NOT _reversed)",
        "reversed": "count_if(_reversed)",
        "distance_obs": f"count_if({finite('_miles')})",
        "duration_obs": "count(_seconds)",
        "duration_whole": f"sum(CASE WHEN {SECONDS} THEN _seconds END)",
        "fare_obs": f"count_if({finite('_fare')})",
        **{f"{name}_cents": f"sum({cents(x)})" for name, x in VALUES.items()},
        **{m: f"max({m})" for m in MIDDLES if m in rows.columns},
    }
    return rows.groupBy(*keys).agg(*[F.expr(e).alias(name) for name, e in measures.items()])


def _other_sums(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Sums of the values that ``_table_stats`` leaves out, of the groups that have any. Values are
    set one below the other first, so that one short condition serves them all."""
    stacked = ", ".join(f"'{name}', {x}, CAST(NULL AS BIGINT)" for name, x in VALUES.items())
    left_out = (
        rows.selectExpr(
            *keys,
            f"stack({len(VALUES) + 1}, {stacked}, 'seconds', CAST(NULL AS DOUBLE), _seconds)"
            " AS (measure, value, _seconds)",
        )
        .where(f"NOT ({SECONDS}) OR (value IS NOT NULL AND ({cents('value')}) IS NULL)")
    )
    return left_out.groupBy(*keys).agg(
        F.expr(whole_sum("_seconds")).alias("duration_s"),
        *[F.expr(sum_parts(f"CASE WHEN measure = '{n}' THEN value END")).alias(f"{n}_sum") for n in VALUES],
    )


def _by_size(rows: DataFrame, by: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """The rows of groups that one task can hold, and those of groups that must be spread.

    Groups are counted by buckets of a hash, so that the list of crowded ones, which is broadcast,
    has a length that does not depend on the data. The days of a zone are counted together: that
    takes two columns and none of the rules.
    """
    coarse = ", ".join([*by, "location_id"])
    dealt = rows.withColumn("_bucket", F.expr(f"pmod(hash({coarse}), {BUCKETS})"))
    crowded = F.broadcast(
        dealt.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > CROWDED).select("_bucket")
    )
    return tuple(dealt.join(crowded, "_bucket", how).drop("_bucket") for how in ("left_anti", "left_semi"))


def _ranked_middles(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``_measured`` rows with the middle values of their group on the rows that hold them. A group is
    sorted in one task; both measures and the sums after them share one shuffle of the rows. Groups
    are sorted by a digest first, which tells almost all of them apart by one whole number, where a
    month tells few."""
    rows = rows.withColumn("_digest", F.xxhash64(*keys))
    for measure, value in (("distance", "_miles"), ("seconds", "_seconds")):
        known = F.expr(f"CASE WHEN {finite(value)} THEN cast({value} AS double) + 0D END")
        group = W.partitionBy("_digest", *keys).orderBy(F.asc_nulls_last("_value"))
        whole = group.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
        ranked = rows.withColumn("_value", known).withColumns(
            {"_rank": F.row_number().over(group) - 1, "_n": F.count("_value").over(whole)}
        )
        middles = {
            f"{measure}_{i}": F.when(F.col("_rank") == position(F.col("_n")), F.col("_value"))
            for i, position in enumerate(MEDIAN_POSITIONS)
        }
        rows = ranked.withColumns(middles).drop("_value", "_rank", "_n")
    return rows.drop("_digest")


def _spread_middles(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The middle values of groups of any size, as up to four rows a group."""
    values = rows.selectExpr(
        *keys, "stack(2, 0, _miles, 1, CAST(_seconds AS DOUBLE)) AS (measure, value)"
    ).where(finite("value"))
    found = values_at(values, [*keys, "measure"], "value", MEDIAN_POSITIONS)
    held = [(measure, f"p{i}") for measure in (0, 1) for i in (0, 1)]
    return found.select(
        *keys, *[F.when(F.col("measure") == m, F.col(p)).alias(name) for name, (m, p) in zip(MIDDLES, held)]
    )


def _medians() -> dict[str, Column]:
    """The published medians out of the middle values."""
    # The median of whole seconds is a whole number of half seconds.
    halves = (median_of(F.col("seconds_0"), F.col("seconds_1")) * 2).cast("bigint")
    return {
        "median_distance_mi": round_half(median_of(F.col("distance_0"), F.col("distance_1")), 3),
        "median_duration_min": F.when(is_small(halves), whole_quotient(halves, F.lit(1), 120, 2))
        .otherwise(rounded_quotient(halves, F.lit(120), 2)),
    }


def row_stats(
    flagged: DataFrame,
    rules: Sequence[Rule],
    keys: Sequence[str],
) -> DataFrame:
    """Every count and sum of a run, per group, over all rows in one pass.

    Only integers and exact parts are summed, so partial sums combine map-side and the result does
    not depend on how the rows were split. A measurement that is no finite number is no
    observation; ``nonfinite`` counts the rows that hold one, and such a row stays a trip.
    """
    cancels = reversal(rules)

    def published(column: str) -> str:
        return f"CASE WHEN {PUBLISHED} THEN {trusted(column, rules)} END"

    miles, minutes, fare = (
        published(c) for c in ("trip_distance", "duration_min", "fare_amount")
    )
    odd = " OR ".join(f"NOT {finite(c)}" for c in MEASURED)
    total = trusted("total_amount", rules)
    measures = {
        "input": "count(1)",
        "published": f"count_if({PUBLISHED})",
        "reversed": f"count_if({cancels})",
        "rejected": f"count_if(NOT ({PUBLISHED}) AND NOT {cancels})",
        "nonfinite": f"count_if({odd})",
        **{f"r_{r.name}": f"count_if({r.flag})" for r in rules},
        **{f"x_{c}": f"count_if({any_flag(f)})" for c, f in nulling_flags(rules).items()},
        "distance_obs": f"count_if({finite(miles)})",
        "distance_sum": sum_parts(miles),
        "duration_obs": f"count({minutes})",
        "duration_s": whole_sum(f"CASE WHEN {minutes} IS NOT NULL THEN duration_s END"),
        "fare_obs": f"count_if({finite(fare)})",
        "fare_sum": sum_parts(fare),
        "revenue_sum": sum_parts(published("total_amount")),
        "refund_sum": sum_parts(f"CASE WHEN {cancels} THEN {total} END"),
    }
    return flagged.groupBy(*keys).agg(*[F.expr(e).alias(name) for name, e in measures.items()])


def daily_stats(
    flagged: DataFrame,
    rules: Sequence[Rule],
    by: Sequence[str] = ("source_month",),
) -> DataFrame:
    return row_stats(_keyed(flagged, rules), rules, [*by, *GROUP])


def daily_middles(
    flagged: DataFrame,
    rules: Sequence[Rule],
    by: Sequence[str] = ("source_month",),
) -> DataFrame:
    """The two middle values of distance (miles) and duration (seconds) over the published rows'
    finite values. A group has up to four rows, each with some of the four."""
    keys = [*by, *GROUP]
    keyed = _keyed(flagged, rules).where(PUBLISHED)
    few, many = (_measured(rows, rules, keys) for rows in _by_size(keyed, by))
    near = _ranked_middles(few.repartition(DEALT, *keys), keys).groupBy(*keys).agg(*[F.max(m).alias(m) for m in MIDDLES])
    return near.unionByName(_spread_middles(many, keys))


def curated_rows(
    stats: DataFrame,
    middles: DataFrame | None,
    zones: DataFrame,
    by: Sequence[str] = ("source_month",),
) -> DataFrame:
    """Statistics to the published columns; days with only quarantined rows are left out. The middle
    values come with the statistics, or by themselves, or not at all: then medians are null. Sums come
    in parts, or as cents with the parts of what is left."""
    keys = [*by, *GROUP]
    c = F.col
    split = "revenue_cents" in stats.columns

    def exact(name: str) -> Column:
        return add_cents(c(f"{name}_sum"), c(f"{name}_cents")) if split else c(f"{name}_sum")

    def in_cents(name: str) -> Column:
        """All values are cents, or there are none."""
        return c(f"{name}_sum").isNull() & F.coalesce(is_small(c(f"{name}_cents")), F.lit(True))

    def money(name: str) -> Column:
        total = rounded_sum(exact(name), 2)
        if split:
            whole = c(f"{name}_cents").cast("double") / F.lit(100.0)
            total = F.when(in_cents(name), whole).otherwise(total)
        return F.coalesce(total, F.lit(0.0))

    def mean(name: str, places: int) -> Column:
        count = c(f"{name}_obs")
        value = rounded_mean(exact(name), count, places)
        if not split:
            return value
        return F.when(in_cents(name), whole_quotient(c(f"{name}_cents"), count, 100, places)).otherwise(value)

    def minutes() -> Column:
        count, rest = c("duration_obs"), c("duration_s")
        if not split:
            return rounded_quotient(rest, count, 2, 60)
        whole = c("duration_whole")
        total = F.coalesce(rest.cast("decimal(37,0)") + whole, rest, whole.cast("decimal(37,0)"))
        near = rest.isNull() & F.coalesce(is_small(whole), F.lit(True))
        return F.when(near, whole_quotient(whole, count, 60, 2)).otherwise(
            rounded_quotient(total, count, 2, 60)
        )

    rows = stats.where(F.col("published") + F.col("reversed") > 0).select(
        *keys,
        F.col("published").alias("trips"),
        *("distance_obs", "duration_obs", "fare_obs"),
        mean("distance", 3).alias("avg_distance_mi"),
        minutes().alias("avg_duration_min"),
        mean("fare", 2).alias("avg_fare_usd"),
        money("revenue").alias("yellow_revenue_usd"),
        money("refund").alias("refunds_usd"),
        *[F.col(m) if m in stats.columns else F.lit(None).cast("double").alias(m) for m in MIDDLES],
    )
    if middles is not None:
        # No join on keys that may be null. A row of statistics and at least one of values make a
        # group, as values are of published trips.
        both = rows.drop(*MIDDLES).unionByName(middles, allowMissingColumns=True)
        rows = both.groupBy(*keys).agg(*[F.max(c).alias(c) for c in both.columns if c not in keys])
    net = round_half(F.col("yellow_revenue_usd") + F.col("refunds_usd"), 2)
    return (
        rows.withColumns({**_medians(), "net_revenue_usd": net})
        .join(unique_dimension(zones), "location_id", "left")
        .select(*by, *CURATED)
    )


def _grouped(rows: DataFrame, keys: Sequence[str], by: Sequence[str], medians: bool) -> list[DataFrame]:
    """``_measured`` rows to be added up per group, if wanted with middle values: those of groups that
    one task holds, dealt by group, and those of groups that are spread."""
    few, many = _by_size(rows, by)
    few = few.repartition(DEALT, *keys)
    if not medians:
        return [few, many]
    spread = many.unionByName(_spread_middles(many, keys), allowMissingColumns=True)
    return [_ranked_middles(few, keys), spread]


def zone_day(
    trips: DataFrame,
    zones: DataFrame,
    rules: Sequence[Rule],
    by: Sequence[str] = ("source_month",),
    medians: bool = True,
) -> DataFrame:
    """Trips of any number of months to the published table.

    ``medians=False`` leaves the two median columns null and saves their pass.
    """
    keys = [*by, *GROUP]
    rows = _measured(_keyed(flag_rows(trips, rules), rules), rules, keys)
    near, far = (_table_stats(part, keys) for part in _grouped(rows, keys, by, medians))
    others = _other_sums(rows, keys).withColumnsRenamed({k: f"_{k}" for k in keys})
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
    return curated_rows(near.unionByName(far).join(others, same, "left"), None, zones, by)


def day_medians(
    trips: DataFrame,
    zones: DataFrame,
    rules: Sequence[Rule],
    by: Sequence[str] = ("source_month",),
) -> DataFrame:
    """Day, zone and medians of the published table, for reports without sums: less of each row is
    moved, and no values are looked for that are no cents."""
    keys = [*by, *GROUP]
    rows = _measured(_keyed(flag_rows(trips, rules), rules), rules, keys)
    near, far = (
        part.groupBy(*keys)
        .agg(F.count("_reversed").alias("_kept"), *[F.max(m).alias(m) for m in MIDDLES])
        .where("_kept > 0")
        for part in _grouped(rows, keys, by, True)
    )
    columns = ["date", "location_id", "borough", "zone", "service_zone", *_medians()]
    named = near.unionByName(far).withColumns(_medians()).join(unique_dimension(zones), "location_id", "left")
    return named.select(*by, *columns)


def zone_trips(
    trips: DataFrame, rules: Sequence[Rule], by: Sequence[str] = ("source_month",)
) -> DataFrame:
    """(by, location_id, trips): published trips of every zone that the published table has."""
    zone = [*by, "location_id"]
    rows = _measured(_keyed(flag_rows(trips, rules), rules), rules, zone)
    counts = {"trips": "count_if(NOT _reversed)", "_kept": "count(_reversed)"}
    found = rows.groupBy(*zone).agg(*[F.expr(e).alias(name) for name, e in counts.items()])
    return found.where("_kept > 0").drop("_kept")


def trips_of(trips: DataFrame, zones: DataFrame, by: Sequence[str] = ("source_month",)) -> DataFrame:
    """The raw trips of a short table of (by, location_id), before any rule is looked at; for rules that
    null no PULocationID."""
    raw = [*[F.col(k) for k in by], F.col("PULocationID").cast("int")]
    wanted = F.broadcast(zones.select(*[F.col(k).alias(f"_{k}") for k in [*by, "location_id"]]))
    same = [x.eqNullSafe(F.col(f"_{k}")) for x, k in zip(raw, [*by, "location_id"])]
    return trips.join(wanted, same, "left_semi")


def count_columns(stats: DataFrame) -> list[str]:
    """The row counts among the statistics; sums of measurements stay with their group."""
    whole = ("input", "published", "reversed", "rejected", "nonfinite")
    return [c for c in stats.columns if c in whole or c.startswith(("r_", "x_"))]


def run_metrics(stats: DataFrame, by: Sequence[str] = ("source_month",)) -> DataFrame:
    """Row metrics per run, from the statistics per day and zone."""
    kept = F.col("published") + F.col("reversed") > 0
    return stats.groupBy(*by).agg(
        *[F.sum(c).alias(c) for c in count_columns(stats)], F.count_if(kept).alias("output")
    )
