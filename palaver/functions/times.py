"""Time expressions. All of them expect a session in UTC (see ``session.use_utc``)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from palaver.fixed import DAY_START_HOUR, WALL_ZONE


def thread_day(created: Column) -> Column:
    """The thread day of an instant: days run from 07:00 UTC to 07:00 UTC."""
    return F.to_date(created - F.expr(f"INTERVAL {DAY_START_HOUR} HOURS"))


def day_end(day: Column) -> Column:
    """The instant at which the thread of ``day`` closes."""
    return F.date_add(day, 1).cast("timestamp") + F.expr(f"INTERVAL {DAY_START_HOUR} HOURS")


def hour_start(created: Column) -> Column:
    """Start of the hour in epoch seconds.

    Eastern offsets are whole hours, so these are also the Eastern hours, and the two
    01:00 hours of the autumn clock change stay apart.
    """
    seconds = F.unix_seconds(created)
    return seconds - F.pmod(seconds, F.lit(3600).cast("bigint"))


def wall_time(created: Column) -> Column:
    """Wall-clock time in the Eastern zone."""
    return F.from_utc_timestamp(created, WALL_ZONE)


def wall_day(created: Column) -> Column:
    """Wall-clock date in the Eastern zone."""
    return F.to_date(wall_time(created))


def friendly_day(day: Column, today: Column) -> Column:
    """``today``, ``yesterday`` or ``on <weekday>``."""
    ago = F.date_diff(today, day)
    return (
        F.when(ago == 0, F.lit("today"))
        .when(ago == 1, F.lit("yesterday"))
        .otherwise(F.concat(F.lit("on "), F.date_format(day, "EEEE")))
    )


def span_label(days: Column) -> Column:
    """Name of a span of days; NULL where the number has no name."""
    return (
        F.when(days == 1, F.lit("day"))
        .when(days == 7, F.lit("week"))
        .when(days == 30, F.lit("month"))
        .when(days > 30, F.lit("all time"))
    )


def result_key(username: Column, span: Column) -> Column:
    """Name under which a user's result is kept."""
    return F.concat(username, F.lit("-"), F.replace(span, F.lit(" "), F.lit("_")))


def target_day(now: dt.datetime, days_ago: int) -> dt.date:
    """The day ``days_ago`` days before the UTC date of ``now``."""
    if now.tzinfo is not None:
        now = now.astimezone(dt.timezone.utc)
    return now.date() - dt.timedelta(days=days_ago)


def first_day(latest: Column, days: Column) -> Column:
    """First of the ``days`` days that end at ``latest``; 0 days means just that day."""
    return F.date_sub(latest, F.greatest(days, F.lit(1)) - 1)
