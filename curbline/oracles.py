"""The same results as ``catalog``, in SQL over the plain tables.

Written from the definitions, not from the Spark code: named building blocks that a query
pulls in as common table expressions.
"""

from __future__ import annotations

import re


def half(x: str, places: int) -> str:
    return f"CAST(round(CAST({x} AS DECIMAL(38,12)), {places}) AS DOUBLE)"


UNIT = 10**10  # sums are whole numbers of ten-billionths


def units(x: str) -> str:
    return f"CAST(round({x} * {UNIT}.0::DOUBLE) AS HUGEINT)"


def half_mean(total: str, count: str, places: int, unit: int = UNIT) -> str:
    """total / unit / count rounded half away from zero in whole numbers."""
    step = 10**places
    whole = f"(2 * abs({total}) * {step} + {unit} * {count}) // (2 * {unit} * {count})"
    return f"CASE WHEN {count} > 0 THEN sign({total}) * CAST({whole} AS DOUBLE) / {step} END"


def ratio(n: str, d: str, scale: str = "") -> str:
    return f"CASE WHEN {d} > 0 THEN CAST({n} AS DOUBLE) / CAST({d} AS DOUBLE){scale} END"


RULES = {
    "out_of_month": "tpep_pickup_datetime < source_month"
    " OR tpep_pickup_datetime >= source_month + INTERVAL 1 MONTH",
    "implausible_distance": "trip_distance > 300",
    "impossible_speed": "duration_min > 1 AND trip_distance / (duration_min / 60) > 100",
    "duration_over_limit": "duration_min > 480",
    "nonpositive_duration": "duration_min <= 0",
    "negative_fare": "fare_amount < 0",
    "zero_distance": "trip_distance <= 0",
    "zero_total": "total_amount = 0",
    "reversal": "total_amount < 0",
}
NULLED = {
    "trip_distance": "v_implausible_distance OR v_impossible_speed OR v_zero_distance",
    "duration_min": "v_duration_over_limit OR v_nonpositive_duration",
    "fare_amount": "v_negative_fare",
}
NEEDED = (
    "tpep_pickup_datetime, tpep_dropoff_datetime, PULocationID, trip_distance, fare_amount,"
    " total_amount"
)
COUNTS = ["input", "published", "reversed", "rejected", "nonfinite", *[f"r_{r}" for r in RULES], *[f"x_{c}" for c in NULLED]]


def counts_of() -> str:
    parts = [
        "count(*) AS input",
        "count(*) FILTER (reject_reason IS NULL) AS published",
        "count(*) FILTER (reject_reason = 'reversal') AS reversed",
        "count(*) FILTER (reject_reason = 'out_of_month') AS rejected",
        "count(*) FILTER (NOT isfinite(trip_distance + fare_amount + total_amount)) AS nonfinite",
    ]
    parts += [f"count(*) FILTER (v_{r}) AS r_{r}" for r in RULES]
    parts += [f"count(*) FILTER ({f}) AS x_{c}" for c, f in NULLED.items()]
    return ", ".join(parts)


def added(x: str) -> str:
    return f"CAST(coalesce(sum({x}), 0) AS DECIMAL(38,4))"


def weighted(mean: str, obs: str) -> str:
    return added(f"CAST({mean} AS DECIMAL(18,4)) * CAST({obs} AS DECIMAL(18,0))")


SUMS = ["trips", "revenue", "refunds", "dist_obs", "dist_sum", "dur_obs", "dur_sum", "fare_obs", "fare_sum"]
MONEY = ["revenue", "refunds", "dist_sum", "dur_sum", "fare_sum"]
ADDITIVE = ", ".join(
    [
        "CAST(sum(trips) AS BIGINT) AS trips",
        added("CAST(yellow_revenue_usd AS DECIMAL(18,4))") + " AS revenue",
        added("CAST(refunds_usd AS DECIMAL(18,4))") + " AS refunds",
        "CAST(sum(distance_obs) AS BIGINT) AS dist_obs",
        weighted("avg_distance_mi", "distance_obs") + " AS dist_sum",
        "CAST(sum(duration_obs) AS BIGINT) AS dur_obs",
        weighted("avg_duration_min", "duration_obs") + " AS dur_sum",
        "CAST(sum(fare_obs) AS BIGINT) AS fare_obs",
        weighted("avg_fare_usd", "fare_obs") + " AS fare_sum",
    ]
)
DAILY_MEDIANS = (
    half_mean("CAST(2 * median(round(median_distance_mi * 1000)) AS HUGEINT)", "1", 2, 2000)
    + " AS median_dist, "
    + half_mean("CAST(2 * median(round(median_duration_min * 100)) AS HUGEINT)", "1", 2, 200)
    + " AS median_dur"
)
ADD_UP = ", ".join(
    f"CAST(sum({c}) AS {'DECIMAL(38,4)' if c in MONEY else 'BIGINT'}) AS {c}" for c in SUMS
)


def reported(c: str) -> str:
    if c in ("revenue", "refunds", "fare_sum"):
        return f"CAST(round({c}, 0) AS BIGINT)"
    if c in ("dist_sum", "dur_sum"):
        return f"CAST(round({c}, 1) AS DOUBLE)"
    return c


REPORTED = ", ".join(f"{reported(c)} AS {c}" for c in SUMS)

_net = "CAST(revenue + refunds AS DOUBLE)"
_miles, _minutes, _fare = ratio("dist_sum", "dist_obs"), ratio("dur_sum", "dur_obs"), ratio("fare_sum", "fare_obs")
METRICS = {  # name: (additive, value, observations)
    "trips": (True, "CAST(trips AS DOUBLE)", "NULL"),
    "revenue": (True, _net, "NULL"),
    "revenue_per_trip": (False, ratio(_net, "trips"), "trips"),
    "avg_fare_usd": (False, _fare, "fare_obs"),
    "avg_distance_mi": (False, _miles, "dist_obs"),
    "avg_duration_min": (False, _minutes, "dur_obs"),
    "speed_mph": (
        False,
        f"CASE WHEN dist_obs > 0 AND dur_sum > 0 THEN {ratio(f'({_miles})', f'({_minutes})', ' * 60.0::DOUBLE')} END",
        "least(dist_obs, dur_obs)",
    ),
    "fare_per_mile": (
        False,
        f"CASE WHEN fare_obs > 0 AND dist_sum > 0 THEN {ratio(f'({_fare})', f'({_miles})')} END",
        "least(fare_obs, dist_obs)",
    ),
}


def long(source: str, keys: str) -> str:
    """One row per slice and metric."""
    lead = f"{keys}, " if keys else ""
    return " UNION ALL ".join(
        f"SELECT {lead}trips, '{name}' AS metric, {str(additive).upper()} AS additive,"
        f" {value} AS value, CAST({obs} AS BIGINT) AS obs FROM {source}"
        for name, (additive, value, obs) in METRICS.items()
    )


SOLID = "CASE WHEN additive THEN trips > 0 ELSE value IS NOT NULL AND obs >= {floor} END"
GROUP = "source_month, date, location_id"
LABEL = "strftime(source_month, '%Y-%m')"
ETAG = "CASE WHEN month(source_month) <> 3 THEN concat_ws('-', {n}, {keys}) END"

BLOCKS: dict[str, str] = {
    "keyed": """
        SELECT make_date(2025, CAST(1 + l_orderkey % 3 AS INT), 1) AS source_month,
               (l_orderkey * 31 + l_linenumber * 97 + l_partkey) % 10000 AS k,
               (l_orderkey * 7919 + l_linenumber * 104729 + l_partkey * 13) % 2419200 AS h,
               l_suppkey, l_quantity, l_extendedprice AS price,
               CASE WHEN l_linestatus = 'F' THEN 1 ELSE 2 END AS delivery
        FROM lineitem""",
    "timed": """
        SELECT *, CASE WHEN k BETWEEN 700 AND 709 THEN -3600
                       WHEN k BETWEEN 710 AND 719 THEN 32 * 86400 ELSE h END AS off_s,
               CASE WHEN k < 100 THEN -60 * (k % 10) WHEN k < 200 THEN 28800 + 60 * (k - 99)
                    ELSE 90 + k % 3600 END AS dur_s
        FROM keyed""",
    "trips": """
        SELECT source_month,
               CAST(source_month AS TIMESTAMP) + to_seconds(off_s) AS tpep_pickup_datetime,
               CAST(source_month AS TIMESTAMP) + to_seconds(off_s + dur_s) AS tpep_dropoff_datetime,
               l_suppkey AS PULocationID,
               CAST(CASE WHEN k BETWEEN 200 AND 299 THEN 0 WHEN k BETWEEN 300 AND 349 THEN 1000
                    WHEN k BETWEEN 350 AND 399 THEN 99 ELSE l_quantity / 5 END AS DOUBLE) AS trip_distance,
               CASE WHEN k BETWEEN 400 AND 449 OR k BETWEEN 500 AND 649 THEN -price
                    ELSE price END AS fare_amount,
               CAST(CASE WHEN k BETWEEN 500 AND 649 THEN -price WHEN k BETWEEN 650 AND 659 THEN 0
                    ELSE price END AS DOUBLE) AS total_amount,
               delivery
        FROM timed""",
    "zones": """
        SELECT CAST(s_suppkey AS INT) AS location_id, r_name AS borough, s_name AS zone,
               n_name AS service_zone
        FROM supplier JOIN nation ON s_nationkey = n_nationkey
        JOIN region ON n_regionkey = r_regionkey""",
    "timed_trips": """
        SELECT *, CAST(date_sub('second', tpep_pickup_datetime, tpep_dropoff_datetime) AS BIGINT) AS duration_s,
               duration_s / CAST(60 AS DOUBLE) AS duration_min
        FROM trips""",
    "flagged": "SELECT *, " + ", ".join(f"({e}) AS v_{r}" for r, e in RULES.items())
    + ", CASE WHEN v_out_of_month THEN 'out_of_month' WHEN v_reversal THEN 'reversal' END AS reject_reason"
    + " FROM timed_trips",
    "clean": "SELECT * REPLACE ("
    + ", ".join(f"CASE WHEN ({f}) THEN NULL ELSE {c} END AS {c}" for c, f in NULLED.items())
    + "), CAST(tpep_pickup_datetime AS DATE) AS date, CAST(PULocationID AS INT) AS location_id FROM flagged",
    "groups": f"""
        SELECT {GROUP}, count(*) FILTER (reject_reason IS NULL) AS trips,
               count(trip_distance) FILTER (reject_reason IS NULL) AS distance_obs,
               sum({units('trip_distance')}) FILTER (reject_reason IS NULL) AS dist_u,
               median(trip_distance) FILTER (reject_reason IS NULL) AS dist_m,
               count(duration_min) FILTER (reject_reason IS NULL) AS duration_obs,
               sum(duration_s) FILTER (reject_reason IS NULL AND duration_min IS NOT NULL) AS dur_s,
               median(CASE WHEN duration_min IS NOT NULL THEN duration_s END) FILTER (reject_reason IS NULL) AS dur_m,
               count(fare_amount) FILTER (reject_reason IS NULL) AS fare_obs,
               sum({units('fare_amount')}) FILTER (reject_reason IS NULL) AS fare_u,
               sum({units('total_amount')}) FILTER (reject_reason IS NULL) AS rev_u,
               sum({units('total_amount')}) FILTER (reject_reason = 'reversal') AS ref_u
        FROM clean WHERE reject_reason IS NULL OR reject_reason = 'reversal' GROUP BY ALL""",
    "curated": f"""
        SELECT source_month, date, location_id, borough, zone, service_zone, trips,
               {half_mean("dist_u", "distance_obs", 3)} AS avg_distance_mi,
               {half('dist_m', 3)} AS median_distance_mi, distance_obs,
               {half_mean("CAST(dur_s AS HUGEINT)", "duration_obs", 2, 60)} AS avg_duration_min,
               {half_mean("CAST(2 * dur_m AS HUGEINT)", "1", 2, 120)} AS median_duration_min, duration_obs,
               {half_mean("fare_u", "fare_obs", 2)} AS avg_fare_usd, fare_obs,
               coalesce({half_mean("rev_u", "1", 2)}, 0) AS yellow_revenue_usd,
               coalesce({half_mean("ref_u", "1", 2)}, 0) AS refunds_usd,
               {half("yellow_revenue_usd + refunds_usd", 2)} AS net_revenue_usd
        FROM groups LEFT JOIN zones USING (location_id)""",
    "month_counts": f"SELECT source_month, {counts_of()} FROM flagged GROUP BY source_month",
    "month_outputs": "SELECT source_month, count(*) AS output FROM groups GROUP BY source_month",
    "versioned": "SELECT * FROM flagged JOIN (VALUES (1), (2)) v(version) ON delivery <= version",
    "version_counts": f"SELECT source_month, version, {counts_of()} FROM versioned GROUP BY ALL",
    "version_outputs": """
        SELECT source_month, version,
               count(DISTINCT (CAST(tpep_pickup_datetime AS DATE), PULocationID)) AS output
        FROM versioned WHERE reject_reason IS NULL OR reject_reason = 'reversal' GROUP BY ALL""",
    "runs": f"""
        SELECT 'r-' || {LABEL} || '-v' || version AS run_id,
               source_month + INTERVAL 1 MONTH + to_days(10 * version) AS written_at,
               CASE WHEN version = 1 THEN 'scheduled' ELSE 'manual' END AS trigger,
               input / CAST(1000 AS DOUBLE) AS seconds, c.*, output
        FROM version_counts c JOIN version_outputs o USING (source_month, version)""",
    "latest": "SELECT * FROM runs WHERE version = 2",
    "zslices": f"SELECT source_month, location_id, borough, zone, {ADDITIVE}, {DAILY_MEDIANS} FROM curated GROUP BY ALL",
    "dslices": f"SELECT source_month, date, {ADDITIVE} FROM curated GROUP BY ALL",
    "mslices": f"SELECT source_month, {ADD_UP} FROM zslices GROUP BY ALL",
    "hslices": f"SELECT {ADD_UP} FROM zslices",
    "zlong": long("zslices", "source_month, location_id, zone, borough"),
    "dlong": long("dslices", "source_month, date"),
    "mlong": long("mslices", "source_month"),
    "hlong": long("hslices", ""),
    "outlined": "SELECT location_id FROM zones WHERE borough <> 'AFRICA'",
    "zmean": """
        SELECT source_month,
               CAST(coalesce(sum(trips) FILTER (location_id IN (SELECT location_id FROM outlined)), 0) AS BIGINT) AS outlined_trips,
               outlined_zones, CAST(outlined_trips AS DOUBLE) / outlined_zones AS mean_trips
        FROM zslices CROSS JOIN (SELECT count(*) AS outlined_zones FROM outlined)
        GROUP BY source_month, outlined_zones""",
    "mapfloor": "SELECT source_month, CAST(floor(mean_trips * 0.01::DOUBLE + 0.5) AS BIGINT) AS floor FROM zmean",
    "rankfloor": "SELECT source_month, CAST(floor(trips * 0.001::DOUBLE + 0.5) AS BIGINT) AS floor FROM mslices",
    "rankable": "SELECT z.* FROM zlong z JOIN rankfloor USING (source_month) WHERE " + SOLID.format(floor="floor"),
    "order_months": """
        SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS source_month, count(*) AS n,
               sum(o_orderkey) AS keys, count(*) FILTER (o_orderstatus <> 'P') AS settled_n,
               coalesce(sum(o_orderkey) FILTER (o_orderstatus <> 'P'), 0) AS settled_keys,
               max(o_orderdate) AS last_order
        FROM orders GROUP BY 1""",
    "inventory": f"SELECT source_month, {ETAG.format(n='n', keys='keys')} AS etag FROM order_months",
    "state": f"""
        SELECT source_month, CASE WHEN month(source_month) = 6 THEN {ETAG.format(n='settled_n', keys='settled_keys')}
               ELSE {ETAG.format(n='n', keys='keys')} END AS etag
        FROM order_months WHERE source_month < DATE '2001-01-01'""",
    "outputs": "SELECT source_month FROM state WHERE month(source_month) <> 9",
    "candidates": """
        SELECT CAST(m AS DATE) AS source_month
        FROM (SELECT unnest(generate_series(CAST(min(source_month) AS TIMESTAMP),
                  CAST(max(source_month) AS TIMESTAMP), INTERVAL 1 MONTH)) AS m FROM inventory) t""",
    "detected": """
        SELECT c.source_month, i.source_month IS NOT NULL AS published, i.etag,
               o.source_month IS NOT NULL AS has_output,
               CASE WHEN i.source_month IS NULL THEN NULL WHEN s.source_month IS NULL THEN 'new'
                    WHEN i.etag IS DISTINCT FROM s.etag THEN 'etag_changed'
                    WHEN o.source_month IS NULL THEN 'missing_output' END AS reason
        FROM candidates c LEFT JOIN inventory i USING (source_month)
        LEFT JOIN state s USING (source_month) LEFT JOIN outputs o USING (source_month)""",
    "checks": f"""
        SELECT 'c-' || {LABEL} AS check_id, last_order + INTERVAL 30 HOUR AS checked_at,
               'daily' AS trigger, 6 AS n_checked,
               strftime(source_month - INTERVAL 5 MONTH, '%Y-%m') AS first_checked,
               CASE WHEN month(source_month) = 9 THEN '' ELSE {LABEL} END AS changed,
               {LABEL} AS source_newest,
               CASE WHEN month(source_month) = 9 THEN 'failed' ELSE 'ok' END AS status,
               CASE WHEN month(source_month) = 9
                    THEN 'published months without output: ' || {LABEL} END AS detail
        FROM order_months""",
    "worst": """
        SELECT measure, max(v) AS worst,
               strftime(arg_max(source_month, (v, -date_diff('day', DATE '1970-01-01', source_month))), '%Y-%m') AS month
        FROM (
            SELECT source_month, measure, greatest(coalesce(v, 0), 0) AS v FROM (
                SELECT source_month, 'rejected' AS measure, rejected / CAST(input AS DOUBLE) AS v FROM latest
                UNION ALL SELECT source_month, 'reversed', reversed / CAST(input AS DOUBLE) FROM latest
                UNION ALL SELECT source_month, 'nulled_distance', x_trip_distance / CAST(input AS DOUBLE) FROM latest
                UNION ALL SELECT source_month, 'nulled_duration', x_duration_min / CAST(input AS DOUBLE) FROM latest
                UNION ALL SELECT source_month, 'volume',
                    abs(input / CAST(lag(input) OVER (ORDER BY source_month) AS DOUBLE) - 1) FROM latest))
        GROUP BY measure""",
}


def _with(body: str) -> str:
    """Prepend the building blocks a statement needs, in definition order."""
    needed: set[str] = set()

    def visit(text: str) -> None:
        for name, block in BLOCKS.items():
            if name not in needed and re.search(rf"(?:FROM|JOIN)\s+\(?{name}\b", text):
                needed.add(name)
                visit(block)

    visit(body)
    blocks = ", ".join(f"{n} AS ({b})" for n, b in BLOCKS.items() if n in needed)
    return f"WITH {blocks} {body}" if blocks else body


FLAT_RUN = (
    "run_id, source_month, written_at, trigger, input, published, reversed, rejected, output,"
    " r_reversal AS rule_reversal, x_trip_distance AS nulled_distance, seconds"
)
LEVELS = f"""
    SELECT CASE grouping(source_month, location_id, date) WHEN 1 THEN 'zone_month' WHEN 2 THEN 'day'
                WHEN 3 THEN 'month' ELSE 'history' END AS level,
           source_month, location_id, date, {ADDITIVE}
    FROM curated GROUP BY GROUPING SETS
        ((source_month, location_id), (source_month, date), (source_month), ())"""
LEVEL_METRICS = ", ".join(f"{value} AS m_{name}" for name, (_, value, _) in METRICS.items())
RULE_EFFECTS = {  # rule: (effect, field)
    "out_of_month": ("reject", "'whole_row'"),
    "implausible_distance": ("null_field", "'trip_distance'"),
    "impossible_speed": ("null_field", "'trip_distance'"),
    "duration_over_limit": ("null_field", "'duration_min'"),
    "nonpositive_duration": ("null_field", "'duration_min'"),
    "negative_fare": ("null_field", "'fare_amount'"),
    "zero_distance": ("null_field", "'trip_distance'"),
    "zero_total": ("observe", "NULL"),
    "reversal": ("reversal", "'whole_row'"),
}
GATE_LIMITS = {"rejected": 0.05, "reversed": 0.08, "nulled_distance": 0.10, "nulled_duration": 0.05, "volume": 0.40}
QUANTILES = ", ".join(f"max(value) FILTER (rn = floor({i} * n / 6)) AS p{i - 1}" for i in range(1, 6))
OWN_RULES = {
    "tiny_total": "total_amount BETWEEN 0 AND 1500",
    "credit": "total_amount < 0",
    "cheap_mile": "fare_amount < 1000 * trip_distance",
    "crawl": "trip_distance / 2 < duration_min / 60",
    "long_haul": "trip_distance > 9",
}
SAMPLE_CONDITIONS = {
    "zero_distance": RULES["zero_distance"],
    "implausible_distance": RULES["implausible_distance"],
    "impossible_speed": RULES["impossible_speed"],
    "negative_fare": RULES["negative_fare"],
    "reversal": RULES["reversal"],
    "zero_total": RULES["zero_total"],
    "nonpositive_duration": RULES["nonpositive_duration"],
    "long_duration": RULES["duration_over_limit"],
    "unknown_zone": "PULocationID IN (0, 1)",
}
SAMPLED = f"source_month, {NEEDED}"


def _sample() -> str:
    broken = " UNION ALL ".join(
        f"SELECT * FROM (SELECT '{kind}' AS kind, {SAMPLED} FROM timed_trips WHERE {cond} ORDER BY {SAMPLED} LIMIT 20)"
        for kind, cond in SAMPLE_CONDITIONS.items()
    )
    text = ", ".join(
        [
            "'1'",
            "tpep_pickup_datetime",
            "tpep_dropoff_datetime",
            "PULocationID",
            *[f"CAST({c} * 100 AS BIGINT)" for c in ("trip_distance", "fare_amount", "total_amount")],
        ]
    )
    return f"""
        SELECT * FROM ({broken})
        UNION ALL
        SELECT kind, {SAMPLED} FROM (
            SELECT 'random' AS kind, {SAMPLED},
                   row_number() OVER (ORDER BY md5(concat_ws('|', {text})), {SAMPLED}) AS rn
            FROM timed_trips)
        WHERE rn <= 500 - (SELECT count(*) FROM ({broken}))"""


STATEMENTS: dict[str, str] = {
    "zone_day": "SELECT * FROM curated",
    "scan_trips": f"SELECT source_month, {NEEDED} FROM trips",
    "zones_dim": "SELECT * FROM zones",
    "trip_duration": """
        SELECT source_month, tpep_pickup_datetime, tpep_dropoff_datetime, PULocationID, duration_min
        FROM timed_trips""",
    "out_of_month": """
        SELECT source_month, CAST(source_month + INTERVAL 1 MONTH AS DATE) AS month_end,
               tpep_pickup_datetime, PULocationID
        FROM flagged WHERE v_out_of_month""",
    "labelled_rows": f"SELECT source_month, {NEEDED}, reject_reason FROM flagged",
    "excluded_rows": f"SELECT source_month, {NEEDED}, reject_reason FROM flagged WHERE reject_reason IS NOT NULL",
    "nulled_fields": f"""
        SELECT source_month, {NEEDED}, duration_min, reject_reason FROM clean
        WHERE reject_reason IS NULL OR reject_reason = 'reversal'""",
    "run_metrics": """
        SELECT source_month, input, published, reversed, rejected, output
        FROM month_counts JOIN month_outputs USING (source_month)""",
    "rule_counts": " UNION ALL ".join(
        f"SELECT source_month, '{r}' AS rule, r_{r} AS rows FROM month_counts" for r in RULES
    ),
    "nulled_counts": " UNION ALL ".join(
        f"SELECT source_month, '{c}' AS field, x_{c} AS rows FROM month_counts" for c in NULLED
    ),
    "reversal_only_zones": """
        SELECT source_month, date, location_id, trips, avg_fare_usd, yellow_revenue_usd, refunds_usd,
               net_revenue_usd
        FROM curated WHERE trips = 0""",
    "custom_rules": f"""
        SELECT source_month, count(*) AS input,
               count(*) FILTER (label IS NULL) AS published,
               count(*) FILTER (label = 'credit') AS reversed,
               count(*) FILTER (label = 'tiny_total') AS rejected,
               {", ".join(f"count(*) FILTER ({e}) AS r_{r}" for r, e in OWN_RULES.items())},
               count(*) FILTER ({OWN_RULES['cheap_mile']}) AS x_fare_amount,
               count(*) FILTER ({OWN_RULES['crawl']}) AS x_duration_min,
               count(*) FILTER (label IS NULL AND NOT ({OWN_RULES['cheap_mile']})) AS fare_obs,
               count(*) FILTER (label IS NULL AND NOT ({OWN_RULES['crawl']})) AS duration_obs,
               count(*) FILTER (label IS NULL) AS distance_obs
        FROM (SELECT *, CASE WHEN {OWN_RULES['tiny_total']} THEN 'tiny_total'
                             WHEN {OWN_RULES['credit']} THEN 'credit' END AS label FROM timed_trips)
        GROUP BY source_month""",
    "gate_results": f"""
        SELECT *, failed_gate IS NULL AS passed FROM (
            SELECT *, CASE WHEN input = 0 THEN 'no_rows' WHEN reject_ratio > 0.05 THEN 'rejected'
                           WHEN reversal_ratio > 0.08 THEN 'reversed'
                           WHEN null_distance_ratio > 0.10 THEN 'nulled_distance'
                           WHEN null_duration_ratio > 0.05 THEN 'nulled_duration'
                           WHEN abs(volume_delta) > 0.40 THEN 'volume' END AS failed_gate
            FROM (
                SELECT m.source_month, coalesce(c.input, 0) AS input,
                       {ratio('c.rejected', 'c.input')} AS reject_ratio,
                       {ratio('c.reversed', 'c.input')} AS reversal_ratio,
                       {ratio('c.x_trip_distance', 'c.input')} AS null_distance_ratio,
                       {ratio('c.x_duration_min', 'c.input')} AS null_duration_ratio,
                       c.input / CAST(p.input AS DOUBLE) - 1 AS volume_delta
                FROM (SELECT DISTINCT source_month FROM trips
                      UNION ALL SELECT CAST(max(source_month) + INTERVAL 1 MONTH AS DATE) FROM trips) m
                LEFT JOIN month_counts c USING (source_month)
                LEFT JOIN month_counts p ON p.source_month = m.source_month - INTERVAL 1 MONTH))""",
    "volume_delta": """
        SELECT c.source_month, c.input, p.input AS previous_input,
               c.input / CAST(p.input AS DOUBLE) - 1 AS volume_delta
        FROM month_counts c
        LEFT JOIN month_counts p ON p.source_month = c.source_month - INTERVAL 1 MONTH""",
    "partitions": """
        SELECT DISTINCT CAST(year(source_month) AS INT) AS year, CAST(month(source_month) AS INT) AS month
        FROM curated""",
    "latest_runs": f"SELECT {FLAT_RUN} FROM latest",
    "runs_history": f"""
        SELECT {FLAT_RUN},
               lag(input) OVER (PARTITION BY source_month ORDER BY written_at) AS previous_version_input,
               CAST(0.08 AS DOUBLE) AS max_reversal_ratio
        FROM runs""",
    "recent_runs": f"SELECT {FLAT_RUN} FROM runs ORDER BY source_month DESC, written_at DESC LIMIT 14",
    "recent_checks": "SELECT *, (SELECT count(*) FROM checks) AS total FROM checks ORDER BY checked_at DESC LIMIT 14",
    "upgrade_runs": """
        SELECT run_id,
               CASE WHEN version = 1 THEN r_reversal + r_zero_total ELSE reversed END AS reversed,
               rejected,
               CASE WHEN version = 1 THEN r_reversal + r_zero_total ELSE r_reversal END AS rule_reversal,
               CAST(CASE WHEN version = 1 THEN 8 ELSE 9 END AS INT) AS n_rules,
               version = 1 AS reversals_estimated
        FROM runs""",
    "detect": "SELECT * FROM detected",
    "ingest_gaps": "SELECT source_month FROM detected WHERE published AND NOT has_output",
    "freshness": """
        SELECT n_checked, changed, ingest_gap, source_newest, source_age_days,
               CASE WHEN detail IS NULL THEN 'ok' ELSE 'failed' END AS status, detail
        FROM (
            SELECT *, CASE WHEN ingest_gap <> '' THEN 'published months without output: ' || ingest_gap
                           WHEN source_newest IS NULL THEN 'no published month in the window'
                           WHEN source_age_days > 120 THEN 'newest data is ' || source_newest || ' ('
                                || source_age_days || ' days old); the limit is 120' END AS detail
            FROM (
                SELECT CAST(count(*) AS INT) AS n_checked,
                       coalesce(string_agg(strftime(source_month, '%Y-%m'), ',' ORDER BY source_month) FILTER (reason IS NOT NULL), '') AS changed,
                       coalesce(string_agg(strftime(source_month, '%Y-%m'), ', ' ORDER BY source_month) FILTER (published AND NOT has_output), '') AS ingest_gap,
                       strftime(max(source_month) FILTER (published), '%Y-%m') AS source_newest,
                       CAST(date_diff('day', max(source_month) FILTER (published) + INTERVAL 1 MONTH, DATE '2001-12-12') AS INT) AS source_age_days
                FROM detected))""",
    "ingest_plan": f"""
        SELECT m.source_month, i.etag,
               CASE WHEN s.source_month IS NOT NULL AND month(m.source_month) <> 4
                         AND s.etag IS NOT DISTINCT FROM i.etag THEN 'reuse' ELSE 'load' END AS action,
               m.etag IS NOT NULL AND m.etag IS DISTINCT FROM i.etag AS moved
        FROM (SELECT source_month, CASE WHEN month(source_month) = 12 THEN {ETAG.format(n='settled_n', keys='settled_keys')}
                     ELSE {ETAG.format(n='n', keys='keys')} END AS etag FROM order_months) m
        JOIN inventory i USING (source_month) LEFT JOIN state s USING (source_month)""",
    "stale_checks": """
        SELECT max(checked_at) AS newest,
               date_diff('second', max(checked_at), TIMESTAMP '2001-08-04') / CAST(3600 AS DOUBLE) AS hours,
               hours > 48 AS stale
        FROM checks""",
    "zone_month": f"SELECT source_month, location_id, borough, zone, {REPORTED} FROM zslices",
    "zone_month_median": "SELECT source_month, location_id, borough, zone, median_dist, median_dur FROM zslices",
    "zone_month_dense": f"""
        SELECT m.source_month, i.location_id, i.borough, i.zone,
               {", ".join(f"coalesce({reported('s.' + c) if c not in MONEY else reported(c)}, 0) AS {c}" for c in SUMS)},
               median_dist, median_dur
        FROM (SELECT DISTINCT location_id, borough, zone FROM zslices) i
        CROSS JOIN (SELECT DISTINCT source_month FROM zslices) m
        LEFT JOIN zslices s ON s.source_month = m.source_month AND s.location_id = i.location_id""",
    "zone_index": "SELECT location_id, borough, zone, CAST(sum(trips) AS BIGINT) AS trips FROM curated GROUP BY ALL",
    "daily_series": f"SELECT source_month, date, {REPORTED}, dayofweek(date) IN (0, 6) AS weekend FROM dslices",
    "month_totals": f"""
        SELECT *, {ratio('-refunds', 'revenue')} AS refund_share FROM (
            SELECT source_month, count(*) AS rows, CAST(sum(trips) AS BIGINT) AS trips,
                   {", ".join(f"CAST(round(sum(CAST({c} AS DECIMAL(18,4))), 2) AS DOUBLE) AS {a}" for c, a in (("yellow_revenue_usd", "revenue"), ("refunds_usd", "refunds"), ("net_revenue_usd", "net_revenue")))}
            FROM curated GROUP BY source_month)""",
    "slices": "SELECT * REPLACE ("
    + ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in MONEY)
    + f") FROM ({LEVELS})",
    "metrics": f"SELECT level, source_month, location_id, date, {LEVEL_METRICS} FROM ({LEVELS})",
    "metric_support": f"""
        SELECT source_month, location_id, trips, metric, additive, value, obs, floor,
               {SOLID.format(floor='floor')} AS solid
        FROM zlong JOIN mapfloor USING (source_month)""",
    "coverage": f"""
        SELECT source_month, location_id, metric, {ratio('obs', 'trips')} AS coverage
        FROM zlong WHERE NOT additive""",
    "zone_mean": "SELECT * FROM zmean",
    "zone_names": """
        SELECT o.location_id, coalesce(c.zone, o.name, 'zone ' || o.location_id) AS zone,
               coalesce(c.borough, o.borough, '') AS borough
        FROM (
            SELECT location_id, service_zone AS name, 'outline' AS borough FROM zones WHERE borough <> 'AFRICA'
            UNION ALL
            SELECT CAST(n_nationkey - 1000 AS INT), CASE WHEN n_regionkey <> 0 THEN n_name END,
                   CASE WHEN n_regionkey <> 0 THEN 'outline' END FROM nation) o
        LEFT JOIN (SELECT location_id, max(zone) AS zone, max(borough) AS borough FROM curated GROUP BY 1) c
            USING (location_id)""",
    "off_map_trips": """
        SELECT source_month, count(*) AS codes, CAST(sum(trips) AS BIGINT) AS trips
        FROM zslices WHERE location_id NOT IN (SELECT location_id FROM outlined) GROUP BY source_month""",
    "zone_ranking": """
        SELECT source_month, metric, CAST(rank AS INT) AS rank, location_id, zone, borough, value, trips
        FROM (SELECT *, row_number() OVER (PARTITION BY source_month, metric
                                           ORDER BY value DESC, location_id) AS rank FROM rankable)
        WHERE rank <= 10""",
    "best_zone": f"""
        SELECT r.source_month, r.metric, r.location_id, r.zone, r.value, r.trips,
               CASE WHEN r.additive THEN {ratio('r.value', 'm.value')} END AS share
        FROM (SELECT *, row_number() OVER (PARTITION BY source_month, metric
                                           ORDER BY value DESC, location_id) AS rank FROM rankable) r
        JOIN mlong m ON m.source_month = r.source_month AND m.metric = r.metric
        WHERE rank = 1""",
    "peak_day": """
        SELECT source_month, metric, date, value
        FROM (SELECT *, row_number() OVER (PARTITION BY source_month, metric
                                           ORDER BY value DESC, date) AS rank FROM dlong WHERE value IS NOT NULL)
        WHERE rank = 1""",
    "mean_vs_median": f"""
        SELECT source_month, CAST(rank AS INT) AS rank, location_id, zone, borough, trips,
               {_miles} AS avg_distance_mi, median_dist, {ratio('dist_obs', 'trips')} AS coverage_dist,
               coalesce(coverage_dist < 0.9, FALSE) AS low_dist,
               {_minutes} AS avg_duration_min, median_dur, {ratio('dur_obs', 'trips')} AS coverage_dur,
               coalesce(coverage_dur < 0.9, FALSE) AS low_dur, {_fare} AS avg_fare_usd
        FROM (SELECT *, row_number() OVER (PARTITION BY source_month ORDER BY trips DESC, location_id) AS rank
              FROM zslices)
        WHERE rank <= 12""",
    "quantile_classes": f"""
        WITH known AS (
            SELECT z.*, {SOLID.format(floor='floor')} AS shown
            FROM zlong z JOIN mapfloor USING (source_month)
            WHERE location_id IN (SELECT location_id FROM outlined) AND {SOLID.format(floor='0')}),
        ranked AS (
            SELECT *, row_number() OVER (PARTITION BY source_month, metric ORDER BY value) - 1 AS rn,
                   count(*) OVER (PARTITION BY source_month, metric) AS n FROM known),
        edges AS (SELECT source_month, metric, {QUANTILES} FROM ranked GROUP BY ALL)
        SELECT source_month, metric, location_id, value,
               CAST({" + ".join(f"CAST(value >= p{i} AS INT)" for i in range(5))} AS INT) AS class, shown
        FROM known JOIN edges USING (source_month, metric)""",
    "month_vs_history": f"""
        SELECT *, CASE WHEN delta IS NULL THEN NULL WHEN abs(delta) < 0.005 THEN 'flat'
                       WHEN delta > 0 THEN 'up' ELSE 'down' END AS direction
        FROM (
            SELECT m.source_month, m.metric, m.value, h.value AS history, days,
                   CASE WHEN m.additive THEN m.value / days ELSE m.value END AS mine,
                   CASE WHEN m.additive THEN h.value / total_days ELSE h.value END AS base,
                   CASE WHEN base <> 0 THEN mine / base - 1 END AS delta,
                   CASE WHEN NOT m.additive THEN {ratio('m.obs', 'm.trips')} END AS coverage
            FROM mlong m JOIN hlong h USING (metric)
            JOIN (SELECT source_month, count(*) AS days FROM dslices GROUP BY 1) USING (source_month)
            CROSS JOIN (SELECT count(*) AS total_days FROM dslices))""",
    "rule_ledger": f"""
        SELECT rule, effect, field, rows,
               rows / CAST((SELECT sum(input) FROM latest) AS DOUBLE) AS share
        FROM ({" UNION ALL ".join(f"SELECT '{r}' AS rule, '{e}' AS effect, {f} AS field, CAST(sum(r_{r}) AS BIGINT) AS rows FROM latest" for r, (e, f) in RULE_EFFECTS.items())})""",
    "history_kpis": """
        SELECT count(*) FILTER (version = 2) AS months, count(*) AS runs,
               CAST(sum(input) FILTER (version = 2) AS BIGINT) AS input,
               CAST(sum(output) FILTER (version = 2) AS BIGINT) AS output,
               CAST(sum(rejected) FILTER (version = 2) AS BIGINT) AS rejected,
               CAST(sum(reversed) FILTER (version = 2) AS BIGINT) AS reversed,
               CAST(sum(x_trip_distance + x_duration_min + x_fare_amount) FILTER (version = 2) AS BIGINT) AS nulled,
               CAST(9 AS INT) AS rules, max(seconds) AS slowest_seconds,
               CAST(sum(rejected) FILTER (version = 2) AS DOUBLE) / CAST(sum(input) FILTER (version = 2) AS DOUBLE) AS rejected_share,
               CAST(sum(reversed) FILTER (version = 2) AS DOUBLE) / CAST(sum(input) FILTER (version = 2) AS DOUBLE) AS reversed_share
        FROM runs""",
    "run_funnel": f"""
        SELECT source_month, run_id, input, output, {ratio('published', 'input')} AS published_share,
               {ratio('reversed', 'input')} AS reversed_share, {ratio('rejected', 'input')} AS rejected_share,
               {ratio('(reversed + rejected)', 'input')} AS excluded_share
        FROM runs""",
    "run_rules": f"""
        SELECT source_month, run_id, CAST(row_number() OVER (PARTITION BY run_id ORDER BY rows DESC, rule) AS INT) AS position,
               rule, rows, {ratio('rows', 'input')} AS share
        FROM ({" UNION ALL ".join(f"SELECT source_month, run_id, input, '{r}' AS rule, r_{r} AS rows FROM runs" for r in RULES)})
        WHERE rows > 0""",
    "rule_overlap": """
        SELECT source_month, r_out_of_month + r_reversal AS flagged, rejected + reversed AS removed,
               flagged - removed AS overlap
        FROM latest""",
    "quarantine_monthly": f"""
        WITH money AS (
            SELECT source_month, round(sum(CAST(refunds_usd AS DECIMAL(18,4))), 2) AS money FROM curated GROUP BY 1),
        rolled AS (
            SELECT grouping(source_month) AS is_total, source_month,
                   {", ".join(f"CAST(sum({e}) AS BIGINT) AS {a}" for a, e in (("input", "input"), ("rejected", "rejected"), ("reversed", "reversed"), ("nulled", "x_trip_distance + x_duration_min + x_fare_amount"), ("nulled_trip_distance", "x_trip_distance"), ("nulled_duration_min", "x_duration_min"), ("nulled_fare_amount", "x_fare_amount")))},
                   CAST(sum(money) AS DOUBLE) AS refunds
            FROM latest JOIN money USING (source_month) GROUP BY ROLLUP (source_month))
        SELECT CASE WHEN is_total = 1 THEN 'total' ELSE {LABEL} END AS month, input, rejected, reversed,
               nulled, nulled_trip_distance, nulled_duration_min, nulled_fare_amount, refunds,
               {ratio('rejected', 'input')} AS rejected_share, {ratio('reversed', 'input')} AS reversed_share,
               {", ".join(f"CAST((SELECT {c} FROM rolled WHERE is_total = 1) AS DOUBLE) / (SELECT count(*) FROM rolled WHERE is_total = 0) AS mean_{c}" for c in ("rejected", "reversed", "nulled", "refunds"))}
        FROM rolled""",
    "worst_month": "SELECT measure, worst, month FROM worst",
    "gate_headroom": f"""
        SELECT measure, worst, month, lim AS "limit", least(1.0::DOUBLE, worst / lim) AS used,
               worst / lim >= 0.5 AS warn
        FROM worst JOIN (VALUES {", ".join(f"('{m}', {x}::DOUBLE)" for m, x in GATE_LIMITS.items())}) g(measure, lim)
        USING (measure)""",
    "pathology_sample": _sample(),
}


def _merge(statement: str) -> str:
    """A statement may bring its own WITH; its blocks then follow the shared ones."""
    text = statement.strip()
    full = _with(text)
    if text.startswith("WITH ") and full != text:
        shared = full[: -len(text)].rstrip()
        return f"{shared}, {text[len('WITH '):]}"
    return full


def oracle_sql() -> dict[str, str]:
    return {name: _merge(text) for name, text in STATEMENTS.items()}
