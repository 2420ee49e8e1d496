"""Calendar and clock expressions.

Instants are TIMESTAMP_NTZ columns that hold UTC, so no expression here depends on the
session time zone. Local values are derived with an explicit zone.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from zonecast.config import MARKET_TZ

_EPOCH = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_local(instant: Column | str, tz: str = MARKET_TZ) -> Column:
    """UTC instant -> wall-clock time in ``tz``."""
    return F.convert_timezone(F.lit("UTC"), F.lit(tz), _col(instant))


def to_utc(local: Column | str, tz: str = MARKET_TZ) -> Column:
    """Wall-clock time in ``tz`` -> UTC instant."""
    return F.convert_timezone(F.lit(tz), F.lit("UTC"), _col(local).cast("timestamp_ntz"))


def local_date(instant: Column | str, tz: str = MARKET_TZ) -> Column:
    return to_local(instant, tz).cast("date")


def local_hour(instant: Column | str, tz: str = MARKET_TZ) -> Column:
    return F.hour(to_local(instant, tz))


def hour_floor(instant: Column | str) -> Column:
    """date_trunc returns a zoned timestamp even for NTZ input, so cast back."""
    return F.date_trunc("HOUR", _col(instant)).cast("timestamp_ntz")


def minutes_floor(instant: Column | str, minutes: int) -> Column:
    """Start of the interval of ``minutes`` (a divisor of 60) that holds the instant."""
    c = _col(instant)
    into = F.minute(c) - F.minute(c) % F.lit(minutes)
    return hour_floor(c) + F.make_dt_interval(F.lit(0), F.lit(0), into)


def plus_hours(instant: Column | str, hours: Column | int) -> Column:
    h = F.lit(hours) if isinstance(hours, int) else hours
    return _col(instant) + F.make_dt_interval(F.lit(0), h.cast("int"))


def plus_minutes(instant: Column | str, minutes: Column | int) -> Column:
    m = F.lit(minutes) if isinstance(minutes, int) else minutes
    return _col(instant) + F.make_dt_interval(F.lit(0), F.lit(0), m.cast("int"))


def minutes_between(start: Column | str, end: Column | str) -> Column:
    return F.timestamp_diff("MINUTE", _col(start), _col(end))


def iso_dow(day: Column | str) -> Column:
    """Monday = 1 ... Sunday = 7."""
    return F.weekday(_col(day)) + F.lit(1)


def month_start(day: Column | str) -> Column:
    return F.trunc(_col(day), "MM")


def next_month(day: Column | str) -> Column:
    return F.add_months(month_start(day), 1)


def day_start_utc(day: Column | str, tz: str = MARKET_TZ) -> Column:
    """Instant at which the local calendar day begins."""
    return to_utc(_col(day).cast("timestamp_ntz"), tz)


def day_minutes(day: Column | str, tz: str = MARKET_TZ) -> Column:
    """Length of the local day: 1380, 1440 or 1500 minutes."""
    return minutes_between(day_start_utc(day, tz), day_start_utc(F.date_add(_col(day), 1), tz))


def expected_intervals(day: Column | str, resolution_minutes: Column | int, tz: str = MARKET_TZ) -> Column:
    res = F.lit(resolution_minutes) if isinstance(resolution_minutes, int) else resolution_minutes
    return F.floor(day_minutes(day, tz) / F.nullif(res, F.lit(0))).cast("int")


def as_zoned(instant: Column | str) -> Column:
    """UTC NTZ -> TIMESTAMP (watermarks need it), whatever the session zone is."""
    micros = F.timestamp_diff("MICROSECOND", F.expr(_EPOCH), _col(instant))
    return F.timestamp_micros(micros)


def as_utc(zoned: Column | str) -> Column:
    """TIMESTAMP -> UTC NTZ, whatever the session zone is."""
    return F.timestamp_add("MICROSECOND", F.unix_micros(_col(zoned)), F.expr(_EPOCH))


def parse_instant(text: Column) -> Column:
    """ISO text to a UTC instant; text without an offset is taken as UTC; bad text -> null."""
    zoned = text.rlike("(Z|[+-][0-9]{2}:?[0-9]{2})$")
    return F.when(zoned, as_utc(text.try_cast("timestamp"))).otherwise(text.try_cast("timestamp_ntz"))


def iso_local(instant: Column | str, tz: str = MARKET_TZ) -> Column:
    """ISO text of the wall-clock time with its UTC offset, e.g. 2025-06-10T01:00:00+02:00."""
    c = _col(instant)
    offset = minutes_between(c, to_local(c, tz))
    size = F.abs(offset)
    return F.concat(
        F.date_format(to_local(c, tz), "yyyy-MM-dd'T'HH:mm:ss"),
        F.when(offset < 0, F.lit("-")).otherwise(F.lit("+")),
        F.lpad(F.floor(size / 60).cast("string"), 2, "0"),
        F.lit(":"),
        F.lpad((size % 60).cast("string"), 2, "0"),
    )
