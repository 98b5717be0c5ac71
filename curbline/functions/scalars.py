"""Small column expressions shared by every operator."""

from __future__ import annotations

from datetime import datetime
from decimal import Decimal

from pyspark.sql import Column, functions as F

# Measurements and money are summed in parts, so that the same total comes out in whatever order the
# partial sums arrive, and no total is too large: decimals of ten places below 10^14, whole units
# of 10^14 above, and plain doubles from 10^28 on, where a double is that coarse itself.
UNIT = "100000000000000BD"
NEAR, FAR = "1e14D", "1e28D"
TOTAL = "decimal(37,10)"


def finite(x: str) -> str:
    """SQL telling whether a number is none of NaN and the infinities; null for null."""
    return f"abs({x}) < double('infinity')"


def sum_parts(x: str) -> str:
    """SQL for the sum of the finite values of x: a struct that the functions below read."""
    wide = f"cast({x} AS decimal(38,10))"
    low = f"CASE WHEN abs({x}) < {NEAR} THEN {wide} WHEN abs({x}) < {FAR} THEN {wide} % {UNIT} END"
    high = (
        f"CASE WHEN abs({x}) >= {NEAR} AND abs({x}) < {FAR}"
        f" THEN cast(({wide} - {wide} % {UNIT}) / {UNIT} AS decimal(38,0)) END"
    )
    huge = f"CASE WHEN abs({x}) >= {FAR} AND {finite(x)} THEN cast({x} AS double) END"
    return f"named_struct('low', sum({low}), 'high', sum({high}), 'huge', sum({huge}))"


def whole_sum(x: str) -> str:
    """SQL for the exact sum of whole numbers, whatever they add up to."""
    return f"sum(cast({x} AS decimal(28,0)))"


def cents(x: str) -> str:
    """SQL for the whole hundredths of a number below 10^6 that has no more than two places; null for
    any other. The double next to a decimal of so few digits has that decimal as its notation."""
    whole = f"rint({x} * 100)"
    return f"CASE WHEN abs({x}) < 1e6D AND {whole} / 100 = {x} THEN cast({whole} AS bigint) END"


def add_cents(parts: Column, hundredths: Column) -> Column:
    """A sum in parts with whole hundredths added; either may be null."""
    near = hundredths.cast("decimal(19,0)") * F.lit(Decimal("0.01"))
    low = F.coalesce(parts["low"].try_cast(TOTAL) + near, parts["low"], near).cast("decimal(38,10)")
    return F.struct(low.alias("low"), parts["high"].alias("high"), parts["huge"].alias("huge"))


def whole_quotient(total: Column, count: Column, per: int, places: int) -> Column:
    """A total below 10^15 divided by (count x per), rounded once half away from zero, in 64 bits."""
    scaled, by = F.abs(total) * F.lit(10**places), count * F.lit(per)
    steps = F.call_function("div", scaled, by) + F.when(scaled % by * 2 >= by, 1).otherwise(0)
    signed = F.when(total < 0, -steps).otherwise(steps)
    return F.when(count > 0, signed.cast("double") / F.lit(float(10**places)))


def is_small(total: Column) -> Column:
    """Whether ``whole_quotient`` takes a total."""
    return total.between(-(10**15), 10**15)


def _total(parts: Column) -> Column:
    """The exact total of parts; null where it has 10^27 or more, or where nothing was summed."""
    high = (parts["high"].try_cast("decimal(15,0)") * F.lit(10**14)).try_cast(TOTAL)
    near = F.coalesce(parts["low"], F.when(parts["high"].isNotNull(), F.lit(0))).try_cast(TOTAL)
    return F.when(parts["huge"].isNull(), F.when(parts["high"].isNull(), near).otherwise(near + high))


def _far_total(parts: Column) -> Column:
    """The total as a double, for totals beyond an exact one."""
    pieces = [parts["huge"], parts["high"].cast("double") * F.lit(1e14), parts["low"].cast("double")]
    known = F.coalesce(*pieces).isNotNull()
    total = sum((F.coalesce(p, F.lit(0.0)) for p in pieces[1:]), F.coalesce(pieces[0], F.lit(0.0)))
    return F.when(known, total)


def round_half(x: Column, places: int) -> Column:
    """Round a double once, half away from zero in its decimal notation."""
    return F.round(x.cast("double"), places)


def rounded_sum(parts: Column, places: int) -> Column:
    return F.coalesce(F.round(_total(parts), places).cast("double"), F.round(_far_total(parts), places))


def rounded_quotient(total: Column, count: Column, places: int, times: int = 1) -> Column:
    """An exact total divided by (count x times), rounded once; null for no values, and for totals
    of 10^27 and more. What is left over by whole steps of the last place decides."""
    step = count.cast("decimal(20,0)") * F.lit(Decimal(times).scaleb(-places))
    exact = total.try_cast(TOTAL)
    rest = exact % step
    steps = ((exact - rest) / step).cast("decimal(31,0)")
    away = F.when(F.abs(rest) * 2 >= step, F.signum(exact).cast("int")).otherwise(0)
    return F.when(count > 0, ((steps + away) * F.lit(Decimal(1).scaleb(-places))).cast("double"))


def rounded_mean(parts: Column, count: Column, places: int) -> Column:
    """The mean behind a sum in parts, rounded once; null for no values."""
    far = F.when(count > 0, F.round(_far_total(parts) / count, places))
    return F.coalesce(rounded_quotient(_total(parts), count, places), far)


def rounded_median(column: str, stored: int, places: int) -> Column:
    """The median of values that carry ``stored`` places, rounded once."""
    whole = F.median((F.col(column).cast("decimal(38,6)") * 10**stored).cast("double"))
    return rounded_quotient((whole * 2).cast("decimal(38,0)"), F.lit(2 * 10**stored), places)


def ratio(numerator: Column, denominator: Column, scale: float | None = None) -> Column:
    """numerator / denominator [* scale], null unless the denominator is positive."""
    value = numerator.cast("double") / denominator.cast("double")
    if scale is not None:
        value = value * F.lit(scale)
    return F.when(denominator > 0, value)


def js_round(x: Column) -> Column:
    """floor(x + 0.5): halves go up, also below zero."""
    return F.floor(x + F.lit(0.5)).cast("bigint")


def change(value: Column, base: Column) -> Column:
    """Relative change against a base; null when the base is missing or zero."""
    return F.when(base != 0, value.cast("double") / base.cast("double") - F.lit(1.0))


def direction(delta: Column) -> Column:
    """Under half a percent either way is noise."""
    return (
        F.when(delta.isNull(), F.lit(None).cast("string"))
        .when(F.abs(delta) < 0.005, "flat")
        .when(delta > 0, "up")
        .otherwise("down")
    )


def is_weekend(day: Column) -> Column:
    return F.dayofweek(day).isin(1, 7)


def duration_seconds(pickup: Column, dropoff: Column) -> Column:
    """Whole seconds between two wall-clock times, truncated toward zero.

    Both must be TIMESTAMP_NTZ; their difference then ignores daylight saving, whatever the
    session time zone is.
    """
    return (dropoff - pickup).cast("bigint")


def wall_clock(moment: datetime) -> Column:
    """A naive Python time as it reads; a plain literal would be shifted into the session zone."""
    return F.lit(moment.isoformat(sep=" ")).cast("timestamp_ntz")


def month_label(month: Column) -> Column:
    return F.date_format(month, "yyyy-MM")


def next_month(month: Column) -> Column:
    return F.add_months(month, 1)


def age_days(month: Column, today: Column) -> Column:
    """Days since the month ended."""
    return F.datediff(today, next_month(month))
