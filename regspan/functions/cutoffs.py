"""Cutoffs: the time axis of the panel, days or instants within days."""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections.abc import Sequence
from datetime import date, datetime, time, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

_STEP = re.compile(r"^(?:(\d+) )?(minute|hour|day|week|month|quarter|year)s?$")
_IN_SECONDS = {"minute": 60, "hour": 3600}
_IN_DAYS = {"day": 1, "week": 7}
_IN_MONTHS = {"month": 1, "quarter": 3, "year": 12}


def as_date(value: date | str) -> date:
    """Accept a date, a datetime or ISO text; drop the time of day."""
    if isinstance(value, str):
        value = datetime.fromisoformat(value)
    return value.date() if isinstance(value, datetime) else value


def cutoff_literal(value: date | datetime | str) -> Column:
    """A cutoff as a constant that compares with timestamps without casting their column."""
    if isinstance(value, str):
        value = datetime.fromisoformat(value)
    if isinstance(value, datetime):
        return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")
    return F.lit(value)


def parse_step(step: str) -> tuple[str, int]:
    """'month' -> ('months', 1), '2 weeks' -> ('days', 14), '6 hours' -> ('seconds', 21600)."""
    match = _STEP.match(step)
    if not match or match[1] == "0":
        raise ValueError(f"unknown step {step!r}")
    count = int(match[1] or 1)
    unit = match[2]
    if unit in _IN_SECONDS:
        return "seconds", count * _IN_SECONDS[unit]
    if unit in _IN_DAYS:
        return "days", count * _IN_DAYS[unit]
    return "months", count * _IN_MONTHS[unit]


def cutoff_dates(start: date | str, end: date | str, step: str = "month") -> list[date]:
    """Cutoffs from start to end. The end is included only if a step lands on it.

    Month steps keep the day of the month; a day the month does not have runs over into
    the next one (31 January is followed by 3 March). Steps of hours or minutes give instants
    (datetimes) from the start's time of day on.
    """
    unit, count = parse_step(step)
    if unit == "seconds":
        first_at, last_at = (datetime.fromisoformat(str(v)) for v in (start, end))
        steps = int((last_at - first_at).total_seconds() // count)
        return [first_at + timedelta(seconds=i * count) for i in range(max(steps + 1, 0))]
    first, last = as_date(start), as_date(end)
    cutoffs: list[date] = []
    for i in range(0, (last - first).days // (count if unit == "days" else 28 * count) + 2):
        if unit == "days":
            current = first + timedelta(days=i * count)
        else:
            years, month = divmod(first.month - 1 + i * count, 12)
            current = date(first.year + years, month + 1, 1) + timedelta(days=first.day - 1)
        if current <= last:
            cutoffs.append(current)
    return cutoffs


def cutoff_sequence(start: Column, end: Column, step: str = "month") -> Column:
    """The same series as an array column, for start and end dates held in the data.

    NULL where the end lies before the start.
    """
    unit, count = parse_step(step)
    if unit == "days":
        series = F.sequence(start, end, F.expr(f"INTERVAL {count} DAY"))
    else:
        days = F.dayofmonth(start) - 1
        months = F.sequence(F.trunc(start, "month"), end, F.expr(f"INTERVAL {count} MONTH"))
        series = F.filter(F.transform(months, lambda d: F.date_add(d, days)), lambda d: d <= end)
    return F.when(start <= end, series)


def _moment(value: date | datetime | str) -> datetime:
    if isinstance(value, str):
        value = datetime.fromisoformat(value)
    return value if isinstance(value, datetime) else datetime.combine(value, time.min)


def check_cutoffs(cutoffs: Sequence[date | datetime | str]) -> list:
    """Cutoffs as ascending distinct dates, or as instants (datetimes) if one has a time of day.

    A panel of instants has a `date` column of timestamps without zone.
    """
    moments = [_moment(c) for c in cutoffs]
    if not moments or any(a >= b for a, b in zip(moments, moments[1:])):
        raise ValueError("cutoffs must be ascending and not empty")
    if all(m.time() == time.min for m in moments):
        return [m.date() for m in moments]
    return moments


def _instants(cutoffs: Sequence) -> bool:
    return isinstance(cutoffs[0], datetime)


def cutoffs_id(cutoffs: Sequence[date]) -> int:
    """A number that tells one list of cutoffs from another; goes with rows that hold positions."""
    digest = hashlib.sha256(",".join(map(str, cutoffs)).encode()).digest()
    return int.from_bytes(digest[:8], "big", signed=True)


def cutoff_array(cutoffs: Sequence[date]) -> Column:
    """Cutoffs as one constant array (of timestamps without zone for instants)."""
    kind = "array<timestamp_ntz>" if _instants(cutoffs) else "array<date>"
    return F.split(F.lit(",".join(map(str, cutoffs))), ",").cast(kind)


def cutoff_position(moment: Column | str, cutoffs: Sequence[date]) -> Column:
    """0-based position of the first cutoff at or after `moment`.

    It is len(cutoffs) for a moment after the last cutoff and for NULL, "never". One lookup
    by day number, whatever the spacing and number of the cutoffs.
    """
    moment = F.col(moment) if isinstance(moment, str) else moment
    if _instants(cutoffs):
        return _searched_position(moment, cutoffs)
    first, span = cutoffs[0], (cutoffs[-1] - cutoffs[0]).days
    by_day = [bisect_left(cutoffs, first + timedelta(days=d)) for d in range(span + 1)]
    lookup = F.split(F.lit(",".join(map(str, [*by_day, len(cutoffs)]))), ",").cast("array<int>")
    # The first midnight at or after the moment follows the day of the instant before it.
    before = moment - F.expr("INTERVAL '0.000001' SECOND")
    day = F.date_diff(F.to_date(before), F.lit(first)) + 1
    return F.get(lookup, F.greatest(F.least(day, F.lit(span + 1)), F.lit(0)))


def _searched_position(moment: Column, cutoffs: Sequence[datetime]) -> Column:
    """The same by binary search over the instants: log2(cutoffs) + 1 steps, whatever the span.

    The search keeps [lo, hi) around the answer, the number of cutoffs before the moment.
    """
    instants, n = cutoff_array(cutoffs), len(cutoffs)

    def step(bounds: Column, _: Column) -> Column:
        lo, hi = bounds["lo"], bounds["hi"]
        mid = F.floor((lo + hi) / 2).cast("int")
        earlier = F.element_at(instants, mid + 1) < moment
        return F.when(lo >= hi, bounds).when(
            earlier, F.struct((mid + 1).alias("lo"), hi.alias("hi"))
        ).otherwise(F.struct(lo.alias("lo"), mid.alias("hi")))

    start = F.struct(F.lit(0).alias("lo"), F.lit(n).alias("hi"))
    found = F.aggregate(F.sequence(F.lit(0), F.lit(n.bit_length())), start, step, lambda b: b["lo"])
    return F.when(moment.isNull(), F.lit(n)).otherwise(found)
