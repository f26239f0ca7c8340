"""Clicks, pages, referrers and exit pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.scalars import marker_count


def counted(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("count"))


def link_clicks(hot: DataFrame) -> DataFrame:
    """Clicks per site, page and link; clicks beside any link share one null link."""
    return counted(hot, ["period", "domain", "page", "u"])


def click_positions(hot: DataFrame) -> DataFrame:
    return counted(hot, ["period", "domain", "page", "x", "y"])


def click_marks(marks: DataFrame) -> DataFrame:
    return counted(marks, ["period", "page", "click"])


def page_referrers(hits: DataFrame) -> DataFrame:
    """How often each page was reached from each referrer."""
    return counted(hits, ["period", "page", "ref"])


def views_and_visitors(hits: DataFrame, keys: list[str], first: str = "wid") -> DataFrame:
    """Page views and distinct visitors per grain, from one exchange on (keys, visitor)."""
    per_visitor = hits.groupBy("period", *keys, "wid").agg(F.count(first).alias("views"))
    return per_visitor.groupBy("period", *keys).agg(
        F.sum("views").alias("pv"), F.count("wid").alias("uv")
    )


def exit_pages(hits: DataFrame, keys: list[str], tie: str = "seq") -> DataFrame:
    """Last visited page of every group; equal times are decided by the tie column."""
    last = F.max_by(F.struct("page", "vtime"), F.struct("vtime", tie)).alias("last")
    grouped = hits.groupBy("period", *keys).agg(last)
    return grouped.select("period", *keys, "last.page", "last.vtime")


def markers(df: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """How many values of each column are the markers ``1`` or ``-``."""
    return df.groupBy("period", *keys).agg(*[marker_count(c).alias(f"{c}_marks") for c in columns])


def sized_groups(df: DataFrame, keys: list[str], least: int, most: int) -> DataFrame:
    """Groups with a number of rows ``n`` in a closed interval."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n").between(least, most))
