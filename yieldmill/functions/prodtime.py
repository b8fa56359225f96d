"""Production time: day rules, load windows and calendar labels.

A production day runs from 07:00:01 to 07:00:00 of the next day.  Telemetry uses
another rule, by hour.  07:00:00 itself belongs to the day before under the
first rule and to the new day under the second, so both are kept by name.
"""

from __future__ import annotations

from datetime import date, datetime, time, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

# The shift changes at 07:00 and a day starts one second later.
SHIFT_CHANGE = time(7, 0, 0)
DAY_START = time(7, 0, 1)


def ntz(moment: datetime | str) -> Column:
    """Timestamp literal without zone, so a filter on a stored column is pushed down."""
    return F.lit(str(moment)).cast("timestamp_ntz")


def production_window(as_of: date, days: int = 1) -> tuple[datetime, datetime]:
    """Closed window of the ``days`` production days that end on ``as_of`` 07:00:00."""
    return (
        datetime.combine(as_of - timedelta(days=days), DAY_START),
        datetime.combine(as_of, SHIFT_CHANGE),
    )


def span_window(first: date, last: date) -> tuple[datetime, datetime]:
    """Closed window from ``first`` 07:00:01 to ``last`` 07:00:00, for reruns and back-fills."""
    return datetime.combine(first, DAY_START), datetime.combine(last, SHIFT_CHANGE)


def window_days(window: tuple[datetime, datetime]) -> tuple[date, date]:
    """First and last production day that a closed window meets."""
    start = timedelta(hours=DAY_START.hour, minutes=DAY_START.minute, seconds=DAY_START.second)
    return (window[0] - start).date(), (window[1] - start).date()


def in_window(ts: Column | str, window: tuple[datetime, datetime]) -> Column:
    """True inside the closed window; compares the bare column with literals."""
    column = F.col(ts) if isinstance(ts, str) else ts
    return column.between(ntz(window[0]), ntz(window[1]))


def until(ts: Column | str, as_of: date) -> Column:
    """True up to ``as_of`` 07:00:00: the cut-off of full refreshes and back-fills."""
    column = F.col(ts) if isinstance(ts, str) else ts
    return column <= ntz(datetime.combine(as_of, SHIFT_CHANGE))


def incremental(ts: str, after: datetime | None, as_of: datetime, day: str | None = None) -> Column:
    """Rows newer than the watermark and older than the current minute.

    ``after`` is None when the target is still empty; then everything up to the
    current minute is read.  ``day`` names a date partition column that holds the day of
    ``ts``; the scan starts at the watermark's day, however long ago that is.
    """
    minute = as_of.replace(second=0, microsecond=0)
    rows = F.col(ts) <= ntz(minute)
    if after is not None:
        rows = rows & (F.col(ts) > ntz(after))
        if day is not None:
            rows = rows & (F.col(day) >= F.lit(after.date()))
    return rows


def production_start(ts: Column | str, gap: str = "drop") -> Column:
    """Start (day 07:00:01) of the production day that holds ``ts``.

    Times between 07:00:00 and 07:00:01 lie in no closed window.  ``gap="drop"``
    gives NULL for them, ``gap="next"`` counts them to the day that starts.
    """
    if gap not in ("drop", "next"):
        raise ValueError(f"gap must be 'drop' or 'next', not {gap!r}")
    column = F.col(ts) if isinstance(ts, str) else ts
    column = column.cast("timestamp_ntz")
    offset = F.expr("INTERVAL '07:00:01' HOUR TO SECOND")
    start = F.to_date(column - offset).cast("timestamp_ntz") + offset
    # The window is closed one second before the next one starts.
    inside = column <= start + F.expr("INTERVAL '23:59:59' HOUR TO SECOND")
    if gap == "drop":
        return F.when(inside, start)
    return F.when(inside | column.isNull(), start).otherwise(start + F.expr("INTERVAL '1' DAY"))


def transfer_day(ts: Column | str) -> Column:
    """Calendar day on which the production day of ``ts`` starts, also in the gap before 07:00:01."""
    column = F.col(ts) if isinstance(ts, str) else ts
    return F.to_date(column.cast("timestamp_ntz") - F.expr("INTERVAL '07:00:01' HOUR TO SECOND"))


def production_date(ts: Column | str) -> Column:
    """Production date by the hour rule: before 07:00 counts to the day before."""
    column = F.col(ts) if isinstance(ts, str) else ts
    return F.to_date(column.cast("timestamp_ntz") - F.expr("INTERVAL '07:00:00' HOUR TO SECOND"))


def month_label(day: Column, year: Column) -> Column:
    """Two-digit year and month, such as 24JAN."""
    return F.concat(F.right(year.cast("string"), F.lit(2)), F.upper(F.date_format(day, "MMM")))


def quarter_digit(quarter: Column) -> Column:
    """Last character of the quarter label."""
    return F.right(quarter.cast("string"), F.lit(1))


def shift_zone(ts: Column, zone: str | None) -> Column:
    """UTC instant to local wall-clock time without zone; applied once, at ingest."""
    local = F.from_utc_timestamp(ts, zone) if zone else ts
    return local.cast("timestamp_ntz")
