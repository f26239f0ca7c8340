"""Joins of metric frames and the merge of cells that belong to one result row."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F


def matched(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Inner join of two metric frames; the strategy is left to the optimizer."""
    return left.join(right, keys, "inner")


def zero_filled(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Left join of two metric frames; measures missing on the right count as zero."""
    measures = [c for c in right.columns if c not in keys]
    return left.join(right, keys, "left").fillna(0, measures)


def merge_cells(frames: list[DataFrame], keys: list[str]) -> DataFrame:
    """One row per key with the cells of all frames.

    Each cell comes from one frame, so the frames are stacked and grouped instead of chained
    through full outer joins: one exchange however many frames there are, and null key parts meet.
    """
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    cells = [c for c in stacked.columns if c not in keys]
    return stacked.groupBy(*keys).agg(*[F.max(c).alias(c) for c in cells])


def overlay(stored: DataFrame, fresh: DataFrame, keys: list[str]) -> DataFrame:
    """Upsert: non-null cells of ``fresh`` replace stored ones, all other cells stay."""
    cells = [c for c in stored.columns if c not in keys]
    fresh = fresh.withColumns({c: F.lit(None) for c in cells if c not in fresh.columns})
    old = stored.withColumns({f"old_{c}": F.col(c) for c in cells}).drop(*cells)
    new = fresh.select(*keys, *[F.col(c).alias(f"new_{c}") for c in cells])
    stacked = old.unionByName(new, allowMissingColumns=True)
    merged = stacked.groupBy(*keys).agg(
        *[F.coalesce(F.max(f"new_{c}"), F.max(f"old_{c}")).alias(c) for c in cells]
    )
    return merged.select(*stored.columns)
