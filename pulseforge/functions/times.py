"""Instants and UTC dates, whatever the session's time zone."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

Instant = datetime | Column


def instant(value: Instant) -> Column:
    """A column for a point in time. A ``datetime`` must carry its zone: without
    one it would mean another instant on every machine."""
    if isinstance(value, Column):
        return value
    if value.tzinfo is None:
        raise ValueError(f"{value!r} has no time zone")
    return F.lit(value).cast("timestamp")


def utc_date(moment: Column) -> Column:
    """The date in UTC, the zone that ``event_date`` is written in."""
    return F.date_from_unix_date(F.floor(F.unix_seconds(moment) / 86_400).cast("int"))
