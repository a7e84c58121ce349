"""Date and time column functions of the provider records."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def epoch_instant(value: Column) -> Column:
    """An epoch number as a timestamp: above 1e12 milliseconds, else seconds; null for null and not positive numbers."""
    whole = value.cast("bigint")
    return F.when(value > 0, F.when(value > 1e12, F.timestamp_millis(whole)).otherwise(F.timestamp_seconds(whole)))


def unzoned_instant(text: Column) -> Column:
    """An ISO text as a timestamp; without a zone it is read as UTC (the session time zone is UTC)."""
    return F.try_to_timestamp(F.regexp_replace(F.trim(text), "(\\.\\d{6})\\d+", "$1"))


def posted_precision(text: Column, instant: Column) -> Column:
    """``unknown`` without an instant, ``date`` for a bare day or a midnight without zone, else ``timestamp``."""
    day = F.trim(text).rlike(r"^\d{4}-\d{2}-\d{2}(?:T00:00(?::00(?:\.0+)?)?)?$")
    return F.when(instant.isNull(), "unknown").when(day, "date").otherwise("timestamp")


def iso_text(instant: Column) -> Column:
    """ISO-8601 in UTC with milliseconds."""
    return F.date_format(instant, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")
