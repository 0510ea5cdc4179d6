"""Clock and service-time expressions.

Service time is seconds since 00:00 of the service day, in a window of
``[first_hour, last_hour)`` hours, so that runs after midnight keep their day.
Every parser is lenient (null for what it rejects) unless ``strict``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The departure texts that stand for "none" in operated logs.
NO_DEPARTURE = ("0001-01-01", "2025-05-07 0:00")


def strip(c: Column) -> Column:
    """Without white space of any script at both ends."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def _strict(value: Column, source: Column, what: str) -> Column:
    return F.when(value.isNotNull() | source.isNull(), value).otherwise(F.raise_error(F.concat(F.lit(f"{what}: "), source)).cast("int"))


def _clock(c: Column, pattern: str) -> Column:
    """Seconds of the first three groups, null if the pattern does not fit."""
    part = [F.regexp_extract(c, pattern, i).try_cast("int") for i in (1, 2, 3)]
    return F.when(c.rlike(pattern), part[0] * 3600 + part[1] * 60 + part[2])


def in_window(seconds: Column, first_hour: int = 4, last_hour: int = 26) -> Column:
    return (seconds >= first_hour * 3600) & (seconds < last_hour * 3600)


def hms24(c: Column, strict: bool = False, first_hour: int = 4, last_hour: int = 26) -> Column:
    """``H:MM:SS`` with hours beyond 23 to service seconds."""
    s = strip(c)
    value = _clock(s, r"^(\d{1,2}):([0-5]\d):([0-5]\d)$")
    value = F.when(in_window(value, first_hour, last_hour), value)
    return _strict(value, c, "not a service time") if strict else value


def twelve_hour(c: Column) -> Column:
    """``YYYY-MM-DD 오전|오후 H:MM:SS`` (AM, PM) to a timestamp without zone; 12 AM is 0, 12 PM is 12."""
    s = strip(c)
    pattern = r"^(\d{4})-(\d{2})-(\d{2}) (오전|오후) (\d{1,2}):(\d{2}):(\d{2})$"
    y, mo, d, h, mi, se = (F.regexp_extract(s, pattern, i).try_cast("int") for i in (1, 2, 3, 5, 6, 7))
    hour = F.pmod(h, F.lit(12)) + F.when(F.regexp_extract(s, pattern, 4) == "오후", 12).otherwise(0)
    return F.when(s.rlike(pattern) & h.between(1, 12), F.try_make_timestamp_ntz(y, mo, d, hour, mi, se.cast("decimal(16,6)")))


def is_no_departure(c: Column) -> Column:
    return strip(c).isin(*NO_DEPARTURE)


def service_seconds(ts: Column, service_date: Column, first_hour: int = 4, last_hour: int = 26) -> Column:
    """Seconds from midnight of the service date; null outside the window."""
    value = F.timestamp_diff("SECOND", service_date.cast("timestamp_ntz"), ts.cast("timestamp_ntz")).cast("int")
    return F.when(in_window(value, first_hour, last_hour), value)


def spelled_clock(c: Column) -> Column:
    """``H시 M분 S초`` to seconds; minutes and seconds below 60."""
    value = _clock(strip(c), r"^(\d{1,2})시 (\d{1,2})분 (\d{1,2})초$")
    fine = [F.regexp_extract(strip(c), r"^(\d{1,2})시 (\d{1,2})분 (\d{1,2})초$", i).try_cast("int") < 60 for i in (2, 3)]
    return F.when(fine[0] & fine[1], value)


def clock_token(c: Column) -> Column:
    """Either ``HH:MM:SS`` (00 to 23) or ``H시 M분 S초`` (hour up to 23) to seconds since midnight."""
    spelled = spelled_clock(c)
    return F.coalesce(_clock(strip(c), r"^([01]\d|2[0-3]):([0-5]\d):([0-5]\d)$"), F.when(spelled < 86400, spelled))


def time_list(c: Column, token, wrap_below: int | None = None, first_hour: int = 4, last_hour: int = 26) -> Column:
    """A pipe-separated list to an array of service seconds; with ``wrap_below``, earlier times are of the next morning."""

    def one(x: Column) -> Column:
        t = token(x)
        if wrap_below is not None:
            t = F.when(t < wrap_below, t + 86400).otherwise(t)
        return F.when(in_window(t, first_hour, last_hour), t)

    return F.transform(F.split(c, r"\|"), one)


def token_count(c: Column) -> Column:
    return F.size(F.split(c, r"\|"))
