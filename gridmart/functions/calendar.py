"""Calendar expressions: UTC grains and the local (Madrid) calendar.

Two calendars are in play. ``date_utc`` and the hour/day/month grains are UTC;
the hourly fact's hour-of-day / weekday / month / year are local wall-clock
values. All expressions are built-ins (whole-stage codegen, no UDFs).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from gridmart.schemas import LOCAL_TZ


def utc_literal(value: dt.datetime) -> Column:
    """A TIMESTAMP literal for a UTC instant; naive datetimes are read as UTC.

    (PySpark converts a naive datetime with the driver's OS time zone, so it is
    made UTC-aware first; the result does not depend on where the driver runs.)
    """
    if value.tzinfo is None:
        value = value.replace(tzinfo=dt.timezone.utc)
    return F.lit(value).cast("timestamp")


#: ISO 8601 in extended form; the zone is an offset or Z (naive is UTC).
_ISO_EXTENDED = r"^\d{4}-\d{2}-\d{2}([T ]\d{2}(:\d{2}(:\d{2}([.,]\d{1,9})?)?)?(Z|[+-]\d{2}(:?\d{2})?)?)?$"
#: Year, week, day (Monday is 1) and time of an ISO week date; the basic form, and the extended form as it becomes basic.
_WEEK = r"^(\d{4})W(0[1-9]|[1-4]\d|5[0-3])([1-7])((?:[T ].*)?)$"
_WEEK_EXTENDED = r"^(\d{4})-W(\d{2})(?:-(\d))?(?=[T ]|$)"


def _week_text(text: Column) -> Column:
    """A text that begins with an ISO week date, with the calendar date instead (NULL if there is no such date).

    The first Monday after 28 December begins week 1 of the next year. A week 53 that a year has not got
    comes out as week 1 of the next one.
    """
    basic = F.regexp_replace(F.regexp_replace(text, _WEEK_EXTENDED, "$1W$2$3"), r"^(\d{4}W\d{2})(?=[T ]|$)", "$11")
    part = lambda group: F.regexp_extract(basic, _WEEK, group)
    monday = F.next_day(F.date_sub(F.concat(part(1), F.lit("-01-04")).try_cast("date"), 7), "Mon")
    date = F.date_add(monday, part(2).try_cast("int") * 7 + part(3).try_cast("int") - 8)
    return F.when(F.weekofyear(date) == part(2).try_cast("int"), F.concat(date.cast("string"), part(4)))


def iso_timestamp(text: Column) -> Column:
    """Instant of an ISO 8601 date or date-time (calendar or week date, extended or basic); anything else is NULL.

    Spark's own cast is wider: it reads '12:34' as a time of the current day, '2024' as a date,
    and region names as zones. Those are refused here before the cast.
    """
    dated = F.when(text.rlike(r"^\d{4}-?W"), _week_text(text)).otherwise(
        F.regexp_replace(text, r"^(\d{4})(\d{2})(\d{2})(?=[T ]|$)", "$1-$2-$3")
    )
    # A basic time may end after its minutes; the cast wants minutes and seconds.
    timed = F.regexp_replace(dated, r"^(.{10}[T ]\d{2})(\d{2})(\d{2}(?:[.,]\d{1,9})?)(?=$|[Z+-])", "$1:$2:$3")
    timed = F.regexp_replace(timed, r"^(.{10}[T ]\d{2})(\d{2})(?=$|[Z+-])", "$1:$2:00")
    full = F.regexp_replace(timed, r"^(.{10}[T ]\d{2})(?=$|[Z+-])", "$1:00")
    return F.translate(F.regexp_extract(full, _ISO_EXTENDED, 0), ",", ".").try_cast("timestamp")


def hour_utc(ts: Column | str) -> Column:
    """UTC hour bucket of an instant."""
    return F.date_trunc("hour", F.col(ts) if isinstance(ts, str) else ts)


def to_local(ts: Column | str, tz: str = LOCAL_TZ) -> Column:
    """UTC instant -> local wall-clock time without zone (TIMESTAMP_NTZ).

    On the autumn clock change two UTC hours map to the same local hour, so the
    result is not a key.
    """
    col = F.col(ts) if isinstance(ts, str) else ts
    return F.convert_timezone(F.lit("UTC"), F.lit(tz), col.cast("timestamp_ntz"))


def weekday_sun0(d: Column) -> Column:
    """Day of week with Sunday = 0 … Saturday = 6 (Spark's dayofweek is 1-based)."""
    return (F.dayofweek(d) - 1).cast("int")


def local_parts(ts: Column | str, tz: str = LOCAL_TZ) -> dict[str, Column]:
    """hour_of_day / day_of_week / month / year of the local wall clock."""
    local = to_local(ts, tz)
    return {
        "hour_of_day": F.hour(local).cast("int"),
        "day_of_week": weekday_sun0(local),
        "month": F.month(local).cast("int"),
        "year": F.year(local).cast("int"),
    }
