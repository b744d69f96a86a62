"""Market wall clock, session hours and time buckets."""

from __future__ import annotations

from datetime import datetime, time
from zoneinfo import ZoneInfo

from pyspark.sql import Column, functions as F

from tapeglass.schema import MARKET_ZONE

# Regular session, both ends inclusive.
SESSION_OPEN = "09:30:00"
SESSION_CLOSE = "16:15:00"

# Buckets are aligned to Monday 2000-01-03, day 10959 after 1970-01-01.
BUCKET_ORIGIN_DAY = 10959

# Text of timestamps in written files; by default writers stop at milliseconds.
FILE_TIMES = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS", "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}


def wall_clock(instant: Column) -> Column:
    """New York wall clock (TIMESTAMP_NTZ) of an instant (TIMESTAMP), whatever zone the session is in."""
    utc = F.timestamp_add("MICROSECOND", F.unix_micros(instant), F.expr("TIMESTAMP_NTZ '1970-01-01 00:00:00'"))
    return F.convert_timezone(F.lit("UTC"), F.lit(MARKET_ZONE), utc)


def wall_literal(value: str | datetime) -> datetime:
    """A filter bound as naive New York wall-clock time."""
    moment = datetime.fromisoformat(value) if isinstance(value, str) else value
    if moment.tzinfo is not None:
        moment = moment.astimezone(ZoneInfo(MARKET_ZONE)).replace(tzinfo=None)
    return moment


def instant_literal(value: str | datetime) -> datetime:
    """A filter bound as an instant; bounds without an offset are New York wall-clock time."""
    moment = datetime.fromisoformat(value) if isinstance(value, str) else value
    return moment if moment.tzinfo is not None else moment.replace(tzinfo=ZoneInfo(MARKET_ZONE))


def in_session(
    wall: str = "timestamp", opens: str = SESSION_OPEN, closes: str = SESSION_CLOSE
) -> Column:
    """True from `opens` to `closes`, both inclusive to the microsecond.

    The seconds of a TIMESTAMP_NTZ are plain long arithmetic; calendar fields or a formatted string would
    build date objects per row. Fractions are looked at on the closing second only.
    """
    first, last = (
        at.hour * 3600 + at.minute * 60 + at.second
        for at in (time.fromisoformat(opens), time.fromisoformat(closes))
    )
    clock = f"unix_timestamp({wall}) % 86400"
    on_the_dot = f"extract(SECOND FROM {wall}) = second({wall})"
    return F.expr(
        f"({clock} BETWEEN {first} AND {last - 1}) OR ({clock} = {last} AND {on_the_dot})"
    )


def time_bucket(
    wall: str = "timestamp", minutes: int | None = None, seconds: int | None = None
) -> Column:
    """Start of the fixed-width bucket that holds `wall`; NULL for a NULL time, whose rows stay."""
    if (minutes is None) == (seconds is None):
        raise ValueError("give the bucket width either in minutes or in seconds")
    width = seconds if seconds is not None else minutes * 60
    if width < 1:
        raise ValueError("the bucket width must be positive")
    offset = BUCKET_ORIGIN_DAY * 86400 % width
    span = f"'{width} seconds'"
    # window() drops rows without a time, so it never sees one.
    timed = f"coalesce({wall}, TIMESTAMP_NTZ '2000-01-03 00:00:00')"
    start = f"window({timed}, {span}, {span}, '{offset} seconds').start"
    return F.expr(f"CASE WHEN {wall} IS NOT NULL THEN {start} END")
