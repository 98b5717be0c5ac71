"""From raw months to published months, with the histories that explain them."""

from __future__ import annotations

import re
import time
import uuid
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from datetime import UTC, date, datetime
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.storagelevel import StorageLevel

from ..config import Thresholds
from ..errors import DataQualityError
from ..functions.scalars import wall_clock
from ..operators import daily, gates, rules as R
from ..operators.contract import SchemaReport
from ..sources import months as M
from ..sources.layout import Layout
from . import detect as D
from .history import CHECK_SCHEMA, RUN_SCHEMA, latest_runs, upgrade_runs

VERSION = "0.1.0"
MONTHS_AT_ONCE = 8  # jobs side by side when months are read one by one
MONTH = "source_month"
STATE_SCHEMA = """
    source_month DATE, url STRING, etag STRING, last_modified TIMESTAMP_NTZ, bytes BIGINT,
    sha256 STRING, recorded_at TIMESTAMP_NTZ
"""
SOURCE_FIELDS = {
    "url": "string",
    "etag": "string",
    "last_modified": "timestamp_ntz",
    "bytes": "bigint",
    "sha256": "string",
}


def _now() -> datetime:
    return datetime.now(UTC).replace(tzinfo=None)


def new_id(now: datetime) -> str:
    """Unique, and in the order of time where the times differ."""
    return f"{now:%Y%m%d.%H%M%S}.{uuid.uuid4()}"


def read_table(spark: SparkSession, layout: Layout, name: str, schema: str) -> DataFrame:
    """A history table; an empty one before the first append."""
    try:
        return spark.read.schema(schema).parquet(layout.table(name))
    except AnalysisException as error:
        if not M.is_absent(error):
            raise
        return spark.createDataFrame([], schema)


def read_runs(spark: SparkSession, layout: Layout) -> DataFrame:
    """All runs; those of older versions come translated and marked."""
    return upgrade_runs(read_table(spark, layout, "runs", RUN_SCHEMA))


def read_checks(spark: SparkSession, layout: Layout) -> DataFrame:
    return read_table(spark, layout, "checks", CHECK_SCHEMA)


def read_state(spark: SparkSession, layout: Layout) -> DataFrame:
    """The newest fingerprint recorded per month."""
    rows = read_table(spark, layout, "source_state", STATE_SCHEMA)
    packed = F.struct(*SOURCE_FIELDS, "recorded_at")
    newest = rows.groupBy(MONTH).agg(F.max_by(packed, F.col("recorded_at")).alias("s"))
    return newest.select(MONTH, "s.*")


def record_state(inventory: DataFrame, layout: Layout, now: datetime | None = None) -> None:
    """Remember the fingerprints the given months were loaded with."""
    known = _source_columns(inventory)
    rows = inventory.select(MONTH, *known, wall_clock(now or _now()).alias("recorded_at"))
    rows.write.mode("append").parquet(layout.table("source_state"))


def _source_columns(inventory: DataFrame) -> list[Column]:
    return [
        (F.col(c) if c in inventory.columns else F.lit(None)).cast(t).alias(c)
        for c, t in SOURCE_FIELDS.items()
    ]


def _run_rows(
    metrics: DataFrame,
    rules: Sequence[R.Rule],
    reports: dict[date, SchemaReport],
    runs: DataFrame,
    inventory: DataFrame | None,
    limits: Thresholds,
    layout: Layout,
    trigger: str,
    git_sha: str | None,
    batch: str,
    now: datetime,
    seconds: float,
    moved: Sequence[date] = (),
) -> DataFrame:
    """One run row per month of the metrics."""
    spark = metrics.sparkSession
    seen = spark.createDataFrame(
        [(m, (r.columns, r.extra, r.missing_optional)) for m, r in reports.items()],
        f"{MONTH} DATE, schema STRUCT<columns: INT, extra: ARRAY<STRING>, missing_optional: ARRAY<STRING>>",
    )
    before = latest_runs(runs).select(MONTH, F.col("rows.input").alias("prev_version_input"))
    rows = metrics.join(seen, MONTH).join(before, MONTH, "left")
    has_moved = F.col(MONTH).isin(list(moved)).alias("moved")
    if inventory is None:
        fields = [F.lit(None).cast(t).alias(c) for c, t in SOURCE_FIELDS.items()]
        rows = rows.withColumn("source", F.struct(*fields, has_moved))
    else:
        source = inventory.select(MONTH, F.struct(*_source_columns(inventory), has_moved).alias("source"))
        rows = rows.join(source, MONTH, "left")

    def counts(prefix: str, names: Sequence[str]) -> Column:
        if not names:
            return F.create_map().cast("map<string,bigint>")
        return F.create_map(*[x for n in names for x in (F.lit(n), F.col(prefix + n))])

    kinds = [
        "input", "published", "reversed", "rejected", "output", "prev_version_input", "nonfinite"
    ]
    applied = [F.lit(x) for pair in limits.limits().items() for x in pair]
    return rows.select(
        F.concat(F.lit(batch + "-"), F.date_format(MONTH, "yyyy-MM")).alias("run_id"),
        F.lit(layout.dataset).alias("dataset"),
        MONTH,
        wall_clock(now).alias("written_at"),
        F.lit(trigger).alias("trigger"),
        F.lit(VERSION).alias("app_version"),
        F.lit(git_sha).cast("string").alias("git_sha"),
        "source",
        "schema",
        F.struct(*kinds).alias("rows"),
        counts("r_", [r.name for r in rules]).alias("rules"),
        counts("x_", list(R.nulling_flags(rules))).alias("nulled"),
        F.create_map(*applied).alias("thresholds"),
        F.lit(round(seconds, 1)).alias("seconds"),
    )


def _reason(error: Exception) -> str:
    """The first line of an error, and the file it names."""
    text = str(error).strip()
    named = re.search(r"[^\s/]+\.parquet", text)
    first = text.splitlines()[0][:300]
    return first if named is None or named[0] in first else f"{named[0]}: {first}"


def _each_month(
    spark: SparkSession, layout: Layout, schemas: dict, rules: Sequence[R.Rule]
) -> tuple[dict[date, DataFrame], dict[date, str]]:
    """The stored statistics of every month that can be read through, and why the others cannot.
    Only asked when the pass over all failed; the months are read once more, several side by
    side, and those that are sound need no further pass."""

    def one(month: date) -> tuple[date, DataFrame | None, str]:
        rows = R.flag_rows(M.read_trips(spark, layout, {month: schemas[month]}), rules)
        stats = daily.daily_stats(rows, rules).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            stats.write.format("noop").mode("overwrite").save()
        except Exception as error:  # whatever a reader or a rule raises
            stats.unpersist()
            return month, None, f"cannot be read: {_reason(error)}"
        return month, stats, ""

    with ThreadPoolExecutor(MONTHS_AT_ONCE) as pool:
        found = list(pool.map(one, schemas))
    return {m: s for m, s, _ in found if s is not None}, {m: why for m, s, why in found if s is None}


def publish_months(
    spark: SparkSession,
    layout: Layout,
    months: Sequence[date],
    zones: DataFrame,
    limits: Thresholds = Thresholds(),
    rules: Sequence[R.Rule] | None = None,
    inventory: DataFrame | None = None,
    trigger: str = "manual",
    git_sha: str | None = None,
    failures: Mapping[date, str] | None = None,
    moved: Sequence[date] = (),
) -> list[date]:
    """Publish every month that passes; raise at the end when any did not.

    All months are one job: the contract of every file, one pass of statistics, the gates, and
    only then writing. A month whose files cannot be read through is left out and named, and the
    others go on. The run rows and the fingerprints that were loaded go last, so a month counts as
    published, and as loaded, when its run is there. Without an ``inventory`` the fingerprints are
    those of the raw files. ``failures`` are months that failed before this step and are named with
    the others; the runs of ``moved`` months say that their source changed after it was detected.
    """
    started, now = time.monotonic(), _now()
    rules = R.default_rules(limits) if rules is None else rules
    failures = dict(failures or {})
    schemas, reports = {}, {}
    for month in sorted(set(months)):
        try:
            schemas[month], reports[month] = M.check_month(spark, layout, month)
        except DataQualityError as broken:
            failures[month] = str(broken)
    if schemas and inventory is None:
        inventory = M.file_inventory(spark, layout)
    passed: list[date] = []
    held: list[DataFrame] = []
    runs = read_runs(spark, layout)
    earlier = latest_runs(runs).select(MONTH, F.col("rows.input").alias("input"))

    def judged(stats: DataFrame) -> tuple[DataFrame, list]:
        metrics = daily.run_metrics(stats)
        wanted = spark.createDataFrame([(m,) for m in schemas], f"{MONTH} DATE")
        return metrics, gates.gate_results(metrics, limits, wanted, earlier).collect()

    try:
        if schemas:
            flagged = R.flag_rows(M.read_trips(spark, layout, schemas), rules)
            # Days x zones rows, used by the gates, the published table and the run rows.
            stats = daily.daily_stats(flagged, rules).persist(StorageLevel.MEMORY_AND_DISK)
            held.append(stats)
            try:
                metrics, verdicts = judged(stats)
            except Exception:
                sound, broken = _each_month(spark, layout, schemas, rules)
                held += sound.values()
                if not broken:
                    raise
                failures |= broken
                schemas = {m: f for m, f in schemas.items() if m in sound}
                if schemas:
                    flagged = R.flag_rows(M.read_trips(spark, layout, schemas), rules)
                    stats = reduce(DataFrame.unionByName, sound.values())
                    metrics, verdicts = judged(stats)
        if schemas:
            passed = sorted(v[MONTH] for v in verdicts if v["passed"])
            failures |= {v[MONTH]: f"gate {v['failed_gate']}" for v in verdicts if not v["passed"]}
        if passed:
            chosen = F.col(MONTH).isin(passed)
            totals = metrics.where(chosen)
            rows = flagged.where(chosen)
            curated = daily.curated_rows(
                stats.where(chosen), daily.daily_middles(rows, rules), zones
            )
            M.replace_months(
                curated,
                layout.base("curated"),
                _without(totals, F.col("output") == 0, layout, "curated"),
                order=daily.GROUP,
            )
            M.replace_months(
                R.excluded_rows(rows),
                layout.base("rejects"),
                _without(totals, F.col("rejected") + F.col("reversed") == 0, layout, "rejects"),
            )
            _run_rows(
                totals, rules, reports, runs, inventory, limits, layout, trigger, git_sha,
                new_id(now), now, time.monotonic() - started, moved,
            ).write.mode("append").parquet(layout.table("runs"))
            record_state(inventory.where(chosen), layout, now)
    finally:
        for frame in held:
            frame.unpersist()
    if failures:
        listed = "; ".join(f"{m:%Y-%m}: {why}" for m, why in sorted(failures.items()))
        raise DataQualityError(f"months not published: {listed}")
    return passed


def process(
    spark: SparkSession,
    layout: Layout,
    inventory: DataFrame,
    today: date,
    zones: DataFrame,
    load: Callable[[date], Mapping | None] | None = None,
    first: str | None = None,
    last: str | None = None,
    force: bool = False,
    limits: Thresholds = Thresholds(),
    trigger: str = "scheduled",
    git_sha: str | None = None,
) -> list[date]:
    """Detect what needs work, load what the raw copy lacks, publish, and remember what was loaded.

    ``load`` brings the raw files of a month in; without it the raw files must be in place. A month
    that cannot be loaded is named at the end, and the others are published. ``load`` may return the
    fingerprint of what it loaded (any of url, etag, last_modified, bytes, sha256); that is then
    recorded instead of the one seen before. A month whose fingerprint is another one than at
    detection, by the inventory or by what was loaded, has moved, and its run says so.
    """
    candidates = D.candidate_months(spark, today, first, last, limits)
    outputs = spark.createDataFrame([(m,) for m in M.stored_months(spark, layout)], f"{MONTH} DATE")
    state = read_state(spark, layout)
    # What detection saw is fixed here: one row per month of the window.
    seen = D.work(D.detect(candidates, inventory, state, outputs, force)).collect()
    wanted = spark.createDataFrame([tuple(r) for r in seen], f"{MONTH} DATE, etag STRING, reason STRING")
    raw = spark.createDataFrame([(m,) for m in M.stored_months(spark, layout, "raw")], f"{MONTH} DATE")
    plan = D.ingest_plan(wanted, inventory, state, raw).orderBy(MONTH).collect()
    detected = {r[MONTH]: r["etag"] for r in seen}
    failures: dict[date, str] = {}
    loaded: list[tuple] = []
    moved = {r[MONTH] for r in plan if r["moved"]}
    for row in plan:
        if row["action"] != "load" or load is None:
            continue
        month = row[MONTH]
        try:
            told = load(month)
        except Exception as error:  # whatever bringing a file in may raise
            failures[month] = f"cannot be loaded: {_reason(error)}"
            continue
        if isinstance(told, Mapping):
            loaded.append((month, *(told.get(c) for c in SOURCE_FIELDS)))
            if told.get("etag") not in (None, detected[month]):
                moved.add(month)
    months = sorted(r[MONTH] for r in plan if r["action"] != "unpublished" and r[MONTH] not in failures)
    if not months and not failures:
        return []
    if loaded:
        fields = ", ".join(f"{c} {t}" for c, t in SOURCE_FIELDS.items())
        own = spark.createDataFrame(loaded, f"{MONTH} DATE, {fields}").alias("l")
        offered = inventory.select(MONTH, *_source_columns(inventory)).alias("i")
        inventory = offered.join(own, MONTH, "left").select(
            MONTH, *[F.coalesce(f"l.{c}", f"i.{c}").alias(c) for c in SOURCE_FIELDS]
        )
    return publish_months(
        spark, layout, months, zones, limits, inventory=inventory, trigger=trigger, git_sha=git_sha,
        failures=failures, moved=sorted(moved),
    )


def _without(totals: DataFrame, nothing: Column, layout: Layout, area: str) -> list[str]:
    """Paths of the months that have no row for an area: one row per month at most."""
    return [layout.month(area, r[MONTH]) for r in totals.where(nothing).select(MONTH).collect()]


def check_freshness(
    spark: SparkSession,
    layout: Layout,
    inventory: DataFrame,
    today: date,
    first: str | None = None,
    last: str | None = None,
    limits: Thresholds = Thresholds(),
    trigger: str = "manual",
    git_sha: str | None = None,
    record: bool = True,
) -> dict:
    """Judge the window, record the check and then raise if it found a problem.

    With ``record`` there is a record of every check, whatever it found and also when no month
    needed work.
    """
    candidates = D.candidate_months(spark, today, first, last, limits)
    outputs = spark.createDataFrame([(m,) for m in M.stored_months(spark, layout)], f"{MONTH} DATE")
    seen = D.detect(candidates, inventory, read_state(spark, layout), outputs)
    verdict = D.freshness(seen, today, limits).first().asDict()
    if record:
        now = _now()
        known = {
            **verdict,
            "check_id": new_id(now),
            "dataset": layout.dataset,
            "checked_at": now,
            "trigger": trigger,
            "app_version": VERSION,
            "git_sha": git_sha,
        }
        table = spark.createDataFrame([], CHECK_SCHEMA).schema
        spark.createDataFrame([tuple(known[c] for c in table.names)], table).write.mode(
            "append"
        ).parquet(layout.table("checks"))
    if verdict["status"] == "failed":
        raise DataQualityError(verdict["detail"])
    return verdict
