"""The daily and hourly jobs: raw lines to cleaned streams to result tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators import behaviour, clean, visitors
from ..operators.merge import merge_cells
from ..schemas import RESULT_TABLES, STREAMS
from ..sources import readers, writers
from . import state
from .grains import FAMILIES, Family, visitor_cells, dwell_cells, wide_cells

Streams = Mapping[str, DataFrame]


def clean_logs(
    lines: DataFrame, rules: clean.Rules, sites: DataFrame, ranges: DataFrame, root: str, batch: str
) -> list[str]:
    """Clean the raw lines of one run (``batch``: its day or hour) and write every stream and the rejects in one pass.

    Returns the days that have records of this run; stragglers make them more than the batch's own. Report each of them.
    """
    writers.write_streams(clean.route(clean.clean(lines, rules, sites, ranges), with_rejects=True), root, batch)
    return readers.batch_days(lines.sparkSession, root, batch)


def clean_range(
    spark: SparkSession, log_root: str, begin: str, end: str, rules: clean.Rules, sites: DataFrame, ranges: DataFrame, root: str, hour_prefix: str = ""
) -> list[str]:
    """Clean the log files of all hours from ``begin`` to ``end`` as one run of the batch ``begin``; returns the days to report."""
    lines = readers.log_range(spark, log_root, begin, end, hour_prefix)
    return clean_logs(lines, rules, sites, ranges, root, begin)


def read_streams(
    spark: SparkSession, root: str, period: str, grain: str = "day", kinds: tuple[str, ...] = tuple(STREAMS)
) -> dict[str, DataFrame]:
    """Cleaned streams with ``period``, day or hour by the folder names."""
    name = F.col("day") if grain == "day" else F.concat("day", "hour")
    streams = {k: readers.cleaned(spark, root, k, period) for k in kinds}
    return {k: s.withColumn("period", name).drop("day", "hour") for k, s in streams.items()}


def _families_of(table: str) -> list[Family]:
    return [f for f in FAMILIES.values() if f.table == table]


def result_table(name: str, streams: Streams, hourly: bool = False) -> DataFrame:
    """All rows and cells of one result table for the periods in the streams."""
    table = RESULT_TABLES[name]
    hits, dwell = streams["hits"], streams["dwell"]
    labelled = lambda df: df.withColumn("level", F.lit(name))
    if name == "respondomain":
        traffic = behaviour.views_and_visitors(hits, list(table.keys))
        bounce = visitors.host_bounce(hits).drop("pv", "bc")
        rows = labelled(merge_cells([traffic, bounce, visitors.host_dwell(dwell)], ["period", *table.keys]))
    elif name == "page":
        rows = labelled(behaviour.views_and_visitors(hits, list(table.keys), "ip"))
    elif name == "detail":
        rows = labelled(behaviour.page_referrers(hits))
    elif name == "hotlink":
        rows = labelled(behaviour.link_clicks(streams["hot"]))
    elif name == "hotmap":
        rows = labelled(behaviour.click_positions(streams["hot"]))
    elif name == "heatmap":
        rows = labelled(behaviour.click_marks(streams["click_marks"]))
    elif name == "gjsx":
        keys = ["period", *table.keys]
        cells = visitors.channel_visitors(hits).drop("retbc", "newbc")
        rows = labelled(merge_cells([cells, visitors.channel_dwell(dwell)], keys))
    elif name == "out_link":
        # One family for all levels, so each stream is read once; only the totals carry area cells.
        rates, form = ("percent", "clock") if hourly else ("points", "long")
        rows = wide_cells(hits, dwell, FAMILIES["link"], area=True, rates=rates, form=form)
        split = [c for c in rows.columns if c.startswith(("other_", "china_"))]
        rows = rows.withColumns({c: F.when(F.col("level") == "total", F.col(c)) for c in split})
    else:
        rates, form = ("percent", "clock") if hourly else ("points", "long")
        frames = []
        for family in _families_of(name):
            loyalty = "loty_1_count" in table.cells
            frames.append(
                wide_cells(
                    streams[family.hits], streams[family.dwell], family,
                    loyalty=loyalty, rates=rates, form=form,
                )
            )
        keys = ["period", "level", *table.keys]
        rows = frames[0] if len(frames) == 1 else _stack_families(frames, keys)
    return _complete(rows, name)


def _stack_families(frames: list[DataFrame], keys: list[str]) -> DataFrame:
    """Families of one table; a key that a family lacks is empty text."""
    padded = []
    for frame in frames:
        missing = {k: F.lit("") for k in keys if k not in frame.columns}
        padded.append(frame.withColumns(missing) if missing else frame)
    return merge_cells(padded, keys)


def _complete(rows: DataFrame, name: str) -> DataFrame:
    """All columns of the result table, in order."""
    names = ["period", "level", *RESULT_TABLES[name].keys, *RESULT_TABLES[name].cells]
    missing = {c: F.lit(None) for c in names if c not in rows.columns}
    return (rows.withColumns(missing) if missing else rows).select(*names)


def report(spark: SparkSession, cleaned_root: str, result_root: str, period: str, state_root: str | None = None) -> None:
    """Write every result table for one day (or those kept by the hour for one hour).

    With ``state_root``, where ``state.add_batch`` keeps the counters of all batches, the visitor tables of a day come from there and the
    streams are read for the other tables only.
    A table that fails does not keep the others from being written; all failures are raised together at the end.
    """
    hourly = len(period) == 10
    streams = read_streams(spark, cleaned_root, period, "hour" if hourly else "day")
    target = f"{result_root}_hourly" if hourly else result_root
    failed: dict[str, Exception] = {}
    for name in HOURLY_TABLES if hourly else RESULT_TABLES:
        try:
            kept = not hourly and state_root and name in state.tables()
            rows = state.result_rows(spark, state_root, name, period) if kept else result_table(name, streams, hourly)
            writers.replace_period(rows, target, name, period)
        except Exception as error:
            failed[name] = error
    if failed:
        raise ExceptionGroup(f"tables not written for {period}: {', '.join(failed)}", list(failed.values()))


HOURLY_TABLES = [
    "domain", "search_engines", "search_region", "out_link", "out_region", "direct_access", "direct_region", "respondomain",
]
