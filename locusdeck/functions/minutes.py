"""Minute arithmetic for usage windows."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F


def floor_minute(ts: Column) -> Column:
    """The minute's start, of the same timestamp type and independent of the session's zone."""
    seconds = F.date_part(F.lit("SECOND"), ts)
    return ts - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds)


def ceil_minute(ts: Column) -> Column:
    """The next full minute; a full minute stays as it is."""
    floor = floor_minute(ts)
    return F.when(ts == floor, floor).otherwise(floor + F.expr("INTERVAL 1 MINUTE"))


def parse_utc(text: str) -> datetime:
    """`YYYY-MM-DD HH:MM` with or without seconds."""
    for pattern in ("%Y-%m-%d %H:%M:%S", "%Y-%m-%d %H:%M"):
        try:
            return datetime.strptime(text, pattern)
        except ValueError:
            continue
    raise ValueError(f"not a time: {text!r}")
