"""Reporting periods: day, hour, or the whole input."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

# Leading characters of "yyyy-MM-dd HH:mm:ss" that name the period.
WIDTHS = {"day": 10, "hour": 13}


def period_of(time_column: Column | str, grain: str) -> Column:
    """``yyyyMMdd`` or ``yyyyMMddHH`` of a time or time text; null when it is not a time."""
    c = F.col(time_column) if isinstance(time_column, str) else time_column
    text = c.try_cast("timestamp_ntz").cast("string")
    return F.translate(F.substring(text, 1, WIDTHS[grain]), "- ", "")


def with_period(df: DataFrame, grain: str = "day", time_column: str = "vtime") -> DataFrame:
    """Add ``period`` from the event time (not from the wall clock of the job)."""
    if grain == "all":
        return df.withColumn("period", F.lit("all"))
    return df.withColumn("period", period_of(time_column, grain))


def valid_day(text: str) -> bool:
    try:
        datetime.strptime(text, "%Y%m%d")
    except ValueError:
        return False
    return len(text) == 8
