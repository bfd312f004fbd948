"""Column functions on zone-less local times."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def local_time(text: Column) -> Column:
    """ISO text to a time without zone; null where the text is no time."""
    return text.try_cast("timestamp_ntz")


def minutes_between(start: Column, end: Column) -> Column:
    """Whole minutes from ``start`` to ``end``, whatever the session's time zone.

    Both are wall-clock times of one place, so the plain difference is right.
    """
    gap = end - start
    return (
        F.extract(F.lit("DAY"), gap) * 1440
        + F.extract(F.lit("HOUR"), gap) * 60
        + F.extract(F.lit("MINUTE"), gap)
    ).cast("bigint")


def gap_minutes(start: Column, end: Column) -> Column:
    """Difference of the epoch seconds by 60, a double; fractions of a second are cut first."""
    return (F.unix_timestamp(end) - F.unix_timestamp(start)) / 60


def date_key(when: Column) -> Column:
    """Text form of a date, as used in folder names."""
    return F.date_format(when, "yyyy-MM-dd")
