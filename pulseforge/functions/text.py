"""Text forms of events and errors."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def iso_offset(instant: Column) -> Column:
    """ISO text with a numeric offset; no fraction when it is zero."""
    return _iso(instant, "+00:00")


def iso_zulu(instant: Column) -> Column:
    """ISO text with ``Z``; no fraction when it is zero."""
    return _iso(instant, "Z")


def _iso(instant: Column, zone: str) -> Column:
    """A cast to text already writes no fraction when it is zero; a shorter
    fraction than six digits is filled up."""
    plain = F.translate(instant.cast("string"), " ", "T")
    size = F.length(plain)
    return F.concat(F.when((size > 19) & (size < 26), F.rpad(plain, 26, "0")).otherwise(plain), F.lit(zone))


def event_json(event_id: Column, customer_id: Column, timestamp: Column, heart_rate: Column) -> Column:
    """The four-field document used for the stored payload and for publishing."""
    return F.to_json(
        F.struct(
            event_id.alias("event_id"),
            customer_id.alias("customer_id"),
            timestamp.alias("timestamp"),
            heart_rate.cast("int").alias("heart_rate"),
        )
    )


# Error texts that downstream readers of the quarantine match on.
BLANK_CUSTOMER = "customer_id cannot be empty or whitespace"
HARD_BOUNDS = "heart_rate %s is outside hard physiological bounds [%d, %d]"
SOFT_BOUNDS = "heart_rate %s is outside the configured domain bounds [%d, %d]"
TOO_LONG = "value too long for type character varying(%d)"
NUL_CHARACTER = "text fields cannot contain NUL (0x00) characters"


def rate_error(template: str, rate: Column, low: int, high: int) -> Column:
    before, after = (template % ("\0", low, high)).split("\0")
    return F.concat(F.lit(before), rate.cast("string"), F.lit(after))
