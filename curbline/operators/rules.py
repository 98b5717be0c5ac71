"""Data-quality rules as data, and what happens to the rows that break them."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from ..config import Thresholds
from ..functions.scalars import duration_seconds
from .contract import NEEDED

REJECT = "reject"  # quarantine
REVERSAL = "reversal"  # book as a refund
OBSERVE = "observe"  # change nothing
ROW_ACTIONS = (REJECT, REVERSAL)
MEASURES = ["duration_min", *NEEDED]


@dataclass(frozen=True)
class Rule:
    name: str
    violated: Column
    action: str  # one of the three above, or the column to null

    @property
    def flag(self) -> str:
        return f"v_{self.name}"

    @property
    def takes_row(self) -> bool:
        return self.action in ROW_ACTIONS

    @property
    def nulls(self) -> str | None:
        return None if self.takes_row or self.action == OBSERVE else self.action


def default_rules(limits: Thresholds = Thresholds()) -> list[Rule]:
    """The nine rules. Their order decides the label of a row that breaks several row-level ones."""
    pickup, month = "tpep_pickup_datetime", "source_month"
    outside = f"{pickup} < {month} OR {pickup} >= add_months({month}, 1)"
    too_fast = (
        "duration_min > 1 AND"
        f" try_divide(trip_distance, duration_min / 60.0D) > {limits.max_speed_mph}D"
    )
    return [
        Rule("out_of_month", F.expr(outside), REJECT),
        Rule("implausible_distance", F.expr(f"trip_distance > {limits.max_distance_mi}D"), "trip_distance"),
        Rule("impossible_speed", F.expr(too_fast), "trip_distance"),
        Rule("duration_over_limit", F.expr(f"duration_min > {limits.max_duration_min}D"), "duration_min"),
        Rule("nonpositive_duration", F.expr("duration_min <= 0"), "duration_min"),
        Rule("negative_fare", F.expr("fare_amount < 0"), "fare_amount"),
        Rule("zero_distance", F.expr("trip_distance <= 0"), "trip_distance"),
        Rule("zero_total", F.expr("total_amount = 0"), OBSERVE),
        Rule("reversal", F.expr("total_amount < 0"), REVERSAL),
    ]


def check_rules(rules: Sequence[Rule]) -> None:
    """An action must be one of the three words or a measured column."""
    names = [r.name for r in rules]
    odd = [n for n in names if not n.isidentifier()]
    if odd:
        raise ValueError(f"rule names must be plain words: {odd}")
    if len(set(names)) != len(names):
        raise ValueError(f"rule names repeat: {names}")
    unknown = [r.action for r in rules if r.nulls and r.nulls not in MEASURES]
    if unknown:
        raise ValueError(f"rules null columns the trips do not have: {unknown}")


def nulling_flags(rules: Sequence[Rule]) -> dict[str, list[str]]:
    """Column to null -> flags that null it."""
    out: dict[str, list[str]] = {}
    for rule in rules:
        if rule.nulls:
            out.setdefault(rule.nulls, []).append(rule.flag)
    return out


def any_flag(flags: Sequence[str]) -> str:
    return "(" + " OR ".join(flags) + ")"


def trusted(column: str, rules: Sequence[Rule]) -> str:
    """SQL for the column, null where a rule says so; a flag that is null does not null it."""
    flags = nulling_flags(rules).get(column)
    return f"CASE WHEN {any_flag(flags)} THEN NULL ELSE {column} END" if flags else column


def with_duration(trips: DataFrame) -> DataFrame:
    seconds = duration_seconds(F.col("tpep_pickup_datetime"), F.col("tpep_dropoff_datetime"))
    return trips.withColumn("duration_s", seconds).withColumn(
        "duration_min", F.expr("duration_s / 60.0D")
    )


def flag_rows(trips: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Adds the duration, one flag per rule (on the original values) and ``reject_reason``."""
    check_rules(rules)
    flagged = with_duration(trips).withColumns({r.flag: r.violated for r in rules})
    labels = " ".join(f"WHEN {r.flag} THEN '{r.name}'" for r in rules if r.takes_row)
    reason = f"CASE {labels} END" if labels else "CAST(NULL AS STRING)"
    return flagged.withColumn("reject_reason", F.expr(reason))


PUBLISHED = "reject_reason IS NULL"


def reversal(rules: Sequence[Rule]) -> str:
    """SQL telling whether the row cancels a trip."""
    names = ", ".join(f"'{r.name}'" for r in rules if r.action == REVERSAL)
    return f"(reject_reason IS NOT NULL AND reject_reason IN ({names}))" if names else "false"


def excluded_rows(flagged: DataFrame) -> DataFrame:
    """Rows that left the published set, with the values they had and the reason."""
    return flagged.filter(f"NOT ({PUBLISHED})").select("source_month", *NEEDED, "reject_reason")


def kept_rows(flagged: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Published and reversal rows, with untrusted fields nulled."""
    kept = flagged.filter(f"{PUBLISHED} OR {reversal(rules)}")
    return kept.withColumns({c: F.expr(trusted(c, rules)) for c in nulling_flags(rules)})
