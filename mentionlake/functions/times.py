"""Time expressions. All timestamps are UTC instants."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from mentionlake import fixed_values as fixed

# first and last second a calendar timestamp can hold (years 1 and 9999)
_FIRST_SECOND = -62135596800
_END_SECOND = 253402300800


def epoch_to_utc(seconds: Column) -> Column:
    """Epoch seconds as number or numeric text to a timestamp; NULL when not a usable number."""
    # the cast alone would take Java's float suffixes
    shaped = seconds.cast("string").rlike(r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$")
    number = F.when(shaped, seconds.try_cast("double"))
    usable = (~F.isnan(number)) & (number >= _FIRST_SECOND) & (number < _END_SECOND)
    return F.timestamp_micros(F.when(usable, F.round(number * 1_000_000)).cast("bigint"))


def reply_grace_floor(cursor: Column) -> Column:
    return cursor - F.make_dt_interval(hours=F.lit(fixed.REPLY_GRACE_HOURS))


def in_market_hours(ts: Column) -> Column:
    return F.hour(ts).between(*fixed.MARKET_HOURS_UTC)


def within_day(ts: Column, day: str) -> Column:
    """Half-open UTC day bounds."""
    start = F.to_timestamp(F.lit(f"{day} 00:00:00"))
    return (ts >= start) & (ts < start + F.make_dt_interval(days=F.lit(1)))
