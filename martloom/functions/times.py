"""Time helpers on zone-less UTC timestamps."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

from martloom.params import Params

# Microseconds from 1970 to the first and last moment of the years 1 to 9999.
_FIRST_MICROS = -62_135_596_800_000_000
_LAST_MICROS = 253_402_300_799_999_999


def at(moment: datetime) -> Column:
    """A TIMESTAMP_NTZ literal; folded at planning time, so comparisons with it reach the scan."""
    return F.lit(moment.isoformat(sep=" ")).cast("timestamp_ntz")


def now(params: Params) -> Column:
    """The moment of the run, in UTC whatever the session's zone is."""
    return at(params.as_of) if params.as_of else utc(F.current_timestamp())


def ago(params: Params, span: timedelta) -> Column:
    return now(params) - F.lit(span)


def days_between(start: Column, end: Column) -> Column:
    """Number of midnights between two moments (not whole 24-hour units); negative if end is earlier."""
    return F.datediff(F.to_date(end), F.to_date(start))


def iso_weekday(moment: Column) -> Column:
    """Monday = 1 ... Sunday = 7."""
    return F.weekday(moment) + 1


def utc(moment: Column) -> Column:
    """A moment (TIMESTAMP, with zone) as zone-less UTC time."""
    return from_epoch_micros(F.unix_micros(moment))


def from_epoch_micros(micros: Column) -> Column:
    """Microseconds since 1970 to a zone-less UTC timestamp, without a detour over the session zone.

    Null outside the years 1 to 9999.
    """
    held = F.when(micros.between(_FIRST_MICROS, _LAST_MICROS), micros)
    seconds = (held.cast("decimal(20,0)") / 1_000_000).cast("decimal(18,6)")
    return at(datetime(1970, 1, 1)) + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds)


def captured_time(text: Column) -> Column:
    """A time from a change record: epoch microseconds as digits, or an ISO string; null if neither.

    Digits that are no time in microseconds (nanoseconds, for instance) are null, not an error.
    """
    digits = text.rlike(r"^\s*[+-]?\d+\s*$")
    written = text.try_cast("timestamp_ntz")
    written = F.when(F.year(written).between(1, 9999), written)
    return F.when(digits, from_epoch_micros(text.try_cast("bigint"))).otherwise(written)
