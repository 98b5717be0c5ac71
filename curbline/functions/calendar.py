"""Month lists on the driver: a handful of dates that parametrise a query."""

from __future__ import annotations

from datetime import date


def parse_month(label: str) -> date:
    year, month = label.split("-")
    return date(int(year), int(month), 1)


def shift(month: date, by: int) -> date:
    index = month.year * 12 + month.month - 1 + by
    return date(index // 12, index % 12 + 1, 1)


def lookback(today: date, months: int) -> list[date]:
    """The given number of months before today's month, newest first."""
    this = today.replace(day=1)
    return [shift(this, -back) for back in range(1, months + 1)]


def month_range(first: str | None, last: str | None) -> list[date] | None:
    """Inclusive range; one bound alone means that single month, none means no range."""
    if first is None and last is None:
        return None
    start, stop = parse_month(first or last), parse_month(last or first)
    if start > stop:
        raise ValueError(f"month range runs backwards: {first} .. {last}")
    span = (stop.year - start.year) * 12 + stop.month - start.month
    return [shift(start, step) for step in range(span + 1)]
