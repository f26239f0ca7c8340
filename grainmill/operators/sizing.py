"""Broadcast only what has been measured."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

BROADCAST_BYTES = 64 * 1024 * 1024
ROW_OVERHEAD = 64


def measured_bytes(df: DataFrame) -> int:
    """Rows and text lengths of a dimension, from one small job."""
    texts = [F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) for c in df.columns]
    width = texts[0]
    for t in texts[1:]:
        width = width + t
    row = df.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(width), F.lit(0)).alias("b")).first()
    return row["b"] + row["n"] * ROW_OVERHEAD


def is_small(df: DataFrame, limit: int | None = None) -> bool:
    """Whether the frame measures below the limit."""
    return measured_bytes(df) <= (BROADCAST_BYTES if limit is None else limit)


def broadcast_if_small(df: DataFrame, limit: int | None = None) -> tuple[DataFrame, bool]:
    """The frame with a broadcast hint when it measures below the limit, and whether it does."""
    small = is_small(df, limit)
    return (F.broadcast(df) if small else df), small
