"""Date helpers."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column
from pyspark.sql import functions as F


def iso_date_text(day: Column) -> Column:
    """``yyyy-MM-dd`` text of a DATE or timestamp, independent of the session time zone."""
    return day.cast("date").cast("string")


def parse_partition_date(text: str) -> date:
    """Date in a ``column=yyyy-MM-dd`` folder name; single-digit month and day are fine."""
    return datetime.strptime(text, "%Y-%m-%d").date()


def millisecond_text(ts: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss.SSS`` of a zone-less timestamp, fraction cut to milliseconds.

    Built from the plain cast, which prints no trailing zeros, so that no session
    time zone takes part.
    """
    text = ts.cast("string")
    dotted = F.when(text.contains("."), text).otherwise(F.concat(text, F.lit(".")))
    return F.rpad(dotted, 23, "0")
