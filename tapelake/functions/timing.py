"""Event time: parsing, buckets and half-open day filters."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

# Candle intervals the API accepts.
SUBDAY_INTERVALS = {
    "1m": "1 minute",
    "5m": "5 minutes",
    "15m": "15 minutes",
    "30m": "30 minutes",
    "1h": "1 hour",
    "4h": "4 hours",
}
CALENDAR_INTERVALS = {"1d": "day", "1w": "week"}


def interval_seconds(interval: str) -> int:
    """Length of a sub-day interval, given by its short name or in words."""
    count, unit = SUBDAY_INTERVALS.get(interval, interval).split()
    return int(count) * {"second": 1, "minute": 60, "hour": 3600, "day": 86400}[unit.rstrip("s")]


def as_date(value: date | str) -> date:
    return value if isinstance(value, date) else date.fromisoformat(value)


def bucket_start(ts: Column | str, interval: str) -> Column:
    """Start of the candle a timestamp falls in; weeks start on Monday."""
    if interval in SUBDAY_INTERVALS:
        return F.window(ts, SUBDAY_INTERVALS[interval])["start"]
    if interval in CALENDAR_INTERVALS:
        return F.date_trunc(CALENDAR_INTERVALS[interval], ts)
    known = ", ".join([*SUBDAY_INTERVALS, *CALENDAR_INTERVALS])
    raise ValueError(f"unknown interval {interval!r}, expected one of: {known}")


def ts_literal(value: datetime | date | str) -> Column:
    """A timestamp literal, read in the session time zone."""
    return F.lit(str(value)).cast("timestamp")


def on_days(ts: Column | str, first: date | str, last: date | str) -> Column:
    """first <= day(ts) <= last as a half-open range on the raw column, which Parquet can skip row groups by."""
    ts = F.col(ts) if isinstance(ts, str) else ts
    after = as_date(last) + timedelta(days=1)
    return (ts >= ts_literal(as_date(first))) & (ts < ts_literal(after))


def parse_iso(text: Column | str) -> Column:
    """ISO-8601 text, with or without zone and with any number of fraction digits, to a timestamp; NULL when malformed
    or without a day."""
    text = F.col(text) if isinstance(text, str) else text
    return F.when(text.rlike(r"^\s*\d{4}-\d{2}-\d{2}"), F.try_to_timestamp(text))


def event_time(text: Column | str) -> Column:
    """Event time of the stream jobs: read like any other time, then cut to milliseconds."""
    return F.date_trunc("millisecond", parse_iso(text))


def epoch_seconds(ts: Column | str) -> Column:
    """Seconds since the epoch as a double, microseconds kept."""
    return F.unix_micros(F.col(ts) if isinstance(ts, str) else ts).cast("double") / F.lit(1e6)
