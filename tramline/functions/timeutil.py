"""Clock and calendar expressions. Instants are unix seconds; every time zone is a column, so one plan serves all feeds."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

HALF_DAY = 43_200


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def epoch() -> Column:
    return F.expr("timestamp_ntz'1970-01-01 00:00:00'")


def unix(wall: Column | str) -> Column:
    """Seconds of a wall-clock timestamp read as UTC."""
    return F.timestamp_diff("SECOND", epoch(), _c(wall))


def local(instant: Column | str, tz: Column | str) -> Column:
    """The wall clock in tz, as timestamp_ntz."""
    return F.convert_timezone(F.lit("UTC"), _c(tz), F.timestamp_add("SECOND", _c(instant), epoch()))


def from_local(wall: Column | str, tz: Column | str) -> Column:
    """The instant of a wall clock in tz; the earlier one in an overlap."""
    return unix(F.convert_timezone(_c(tz), F.lit("UTC"), _c(wall)))


def service_date(instant: Column | str, tz: Column | str) -> Column:
    """the local calendar date, as an ISO string."""
    return local(instant, tz).cast("date").cast("string")


def fmt_local(instant: Column | str, tz: Column | str) -> Column:
    """YYYY-MM-DD HH:MM:SS+HH:MM."""
    wall = local(instant, tz)
    offset = F.timestamp_diff("SECOND", F.timestamp_add("SECOND", _c(instant), epoch()), wall)
    sign = F.when(offset < 0, "-").otherwise("+")
    clock = F.format_string("%02d:%02d", F.floor(F.abs(offset) / 3600), F.floor(F.abs(offset) % 3600 / 60))
    return F.concat(F.date_format(wall, "yyyy-MM-dd HH:mm:ss"), sign, clock)


def service_midnight(day: Column | str, tz: Column | str) -> Column:
    """local noon of the service day less twelve hours, so that days with a clock change keep schedule time."""
    noon = F.timestamp_add("SECOND", F.lit(HALF_DAY), _c(day).cast("date").cast("timestamp_ntz"))
    return from_local(noon, tz) - HALF_DAY


def hms_seconds(clock: Column | str) -> Column:
    """seconds of HH:MM:SS, hours of 24 and more included; null if it isn't one."""
    parts = F.split(F.trim(_c(clock)), ":")
    h, m, s = (F.try_element_at(parts, F.lit(i)).try_cast("int") for i in (1, 2, 3))
    return F.when(F.size(parts) == 3, h * 3600 + m * 60 + s)


def bucket(instant: Column | str, seconds: int) -> Column:
    """the number of the tumbling window of that length."""
    return F.floor(_c(instant) / seconds).cast("long")


def naive_local_to_utc(text: Column | str, tz: Column | str, near: Column | str) -> Column:
    """the instant of an ISO wall clock without offset. In an overlap or gap, the candidate nearest the poll wins."""
    wall = F.try_to_timestamp(F.replace(_c(text), F.lit("T"), F.lit(" "))).cast("timestamp_ntz")
    first = from_local(wall, tz)
    again = local(first, tz)
    other = F.when(again > wall, first - 3600).when(local(first + 3600, tz) == wall, first + 3600)
    return F.when(F.abs(other - _c(near)) < F.abs(first - _c(near)), other).otherwise(first)


def iso_offset_to_utc(text: Column | str) -> Column:
    """the instant of an ISO timestamp that carries Z or an offset; null without one."""
    c = _c(text)
    return F.when(c.rlike(r"(Z|[+-]\d\d:?\d\d)$"), F.unix_seconds(F.try_to_timestamp(c)))


def meridian_to_utc(text: Column | str, tz: Column | str) -> Column:
    """MM/dd/yyyy h:mm:ss AM in tz."""
    return from_local(F.try_to_timestamp(_c(text), F.lit("MM/dd/yyyy h:mm:ss a")).cast("timestamp_ntz"), tz)


def clock_near(clock: Column | str, anchor: Column | str, tz: Column | str, ahead: bool) -> Column:
    """a h:mm[:ss] AM clock on the anchor's local date.

    ahead: a clock more than 12 hours before the anchor belongs to the next day; else one more than 12 hours after
    it to the day before. A bad clock gives null.
    """
    text = F.upper(F.trim(_c(clock)))
    time = F.coalesce(F.try_to_timestamp(text, F.lit("h:mm:ss a")), F.try_to_timestamp(text, F.lit("h:mm a"))).cast("timestamp_ntz")
    seconds = F.hour(time) * 3600 + F.minute(time) * 60 + F.second(time)
    day = local(anchor, tz).cast("date").cast("timestamp_ntz")
    at = from_local(F.timestamp_add("SECOND", seconds, day), tz)
    if ahead:
        return F.when(_c(anchor) - at > HALF_DAY, at + 86_400).otherwise(at)
    return F.when(at - _c(anchor) > HALF_DAY, at - 86_400).otherwise(at)
