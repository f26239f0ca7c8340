"""Channels: the subset of hits or dwell rows that a report is about."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def predicate(channel: str) -> Column | None:
    return {
        "all": None,
        "ads": None,
        "se": F.col("se").isNotNull(),
        "se_city": F.col("se").isNotNull() & F.col("city").isNotNull(),
        "wb": F.col("wb") == 1,
        "direct": F.col("ref") == "-",
        "has_ref": F.col("ref").isNotNull(),
    }[channel]


def in_channel(df: DataFrame, channel: str) -> DataFrame:
    condition = predicate(channel)
    return df if condition is None else df.where(condition)
