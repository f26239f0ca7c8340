"""Member counters and dwell sums of all visitor reports, stored per batch and added up.

One pass over the hits of a batch makes the finest members of every family: a hit becomes a row for each family whose channel it is
in, and rows are combined before the one exchange. Counters add, so the members of a period are the sum of what its batches hold: a
late batch writes only the members it touches, a rerun replaces only its own, and an all-time report is the sum over periods. Dwell
times are stored as sums and counts in the same way. Tables of a day come from here without reading the hits again.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..operators import channels, dwell as dwell_ops, members as m
from ..operators.merge import merge_cells
from ..schemas import RESULT_TABLES, struct
from ..sources import versions, writers
from .grains import FAMILIES, cells_of_members, cells_of_sums, with_roots

KEYS = ("domain", "adsid", "province", "city", "se_root", "se", "kw", "ref_root", "ref")
#: Families kept, by the streams they come from; the link family carries the area counters of its totals.
KEPT = {
    "hits": ("site", "region", "engine", "keyword", "engine_region", "link", "link_region", "direct", "direct_region"),
    "ad_hits": ("ad",),
}
DWELL_OF = {"hits": "dwell", "ad_hits": "ad_dwell"}
COUNTERS = tuple(f"{n}{c}" for n in ("", "ret_", "oth_", "oth_ret_") for c in ("rows", "views"))
SUMS = tuple(f"{kind}_{s}" for s in dwell_ops.slices(True) for kind in ("sum", "cnt"))
MEMBERS = struct(" ".join(["family", *KEYS, "kind", "id", *[f"{c}:long" for c in COUNTERS], "period"]))
TIMES = struct(" ".join(["family", *KEYS, *[f"{c}:long" for c in SUMS], "period"]))
FOLDED = "batch=folded"
FOLD_ROWS = 250_000


def _by_family(rows: DataFrame, names: tuple[str, ...], others: list[str]) -> DataFrame:
    """A row per family whose channel holds the row, with the keys of that family; other keys are null."""
    rows = with_roots(rows, tuple(r for r, c in (("se_root", "se"), ("ref_root", "ref")) if c in rows.columns))

    def entry(name: str) -> Column:
        family, none = FAMILIES[name], F.lit(None).cast("string")
        keys = [(F.col(k) if k in family.keys else none).alias(k) for k in KEYS]
        inside = channels.predicate(family.channel)
        value = F.struct(F.lit(name).alias("family"), *keys)
        return value if inside is None else F.when(inside, value)

    entries = F.array(*[entry(n) for n in names])
    return rows.select("period", *others, F.explode(entries).alias("e")).where(F.col("e").isNotNull()).select("period", "e.*", *[o for o in others if o not in KEYS])


def member_rows(hits: DataFrame, names: tuple[str, ...]) -> DataFrame:
    """Finest members of several families from one read of the hits."""
    area = F.col("area").isNull() if "area" in hits.columns else F.lit(False)
    ret = F.col("new").isNull()
    flags = {"ret": ret, "oth": area, "oth_ret": area & ret, "seen": F.col("ip").isNotNull()}
    flat = hits.withColumns({f"is_{n}": c for n, c in flags.items()})
    flat = _by_family(flat, names, [*[f"is_{n}" for n in flags], m.VISITOR, m.ADDRESS])
    ids = F.stack(F.lit(2), F.lit(m.VISITOR), F.col(m.VISITOR), F.lit(m.ADDRESS), F.col(m.ADDRESS)).alias("kind", "id")
    flat = flat.select("period", "family", *KEYS, *[f"is_{n}" for n in flags], ids)
    counts = []
    for n in ("", "ret", "oth", "oth_ret"):
        inside = f"is_{n}" if n else "true"
        counts += [f"count_if({inside}) as {n}{'_' if n else ''}rows", f"count_if({inside} and is_seen) as {n}{'_' if n else ''}views"]
    return flat.groupBy("period", "family", *KEYS, "kind", "id").agg(*map(F.expr, counts)).select(*MEMBERS.names)


def time_rows(dwell: DataFrame, names: tuple[str, ...]) -> DataFrame:
    """Sums and counts of dwell times of several families from one read."""
    dwell = dwell if "area" in dwell.columns else dwell.withColumn("area", F.lit("-"))
    flat = _by_family(dwell, names, ["new", "page_avg_time", "area"])
    return dwell_ops.dwell_sums(flat, ["period", "family", *KEYS], True).select(*TIMES.names)


def add_batch(streams: dict[str, DataFrame], root: str, batch: str) -> None:
    """Store the counters of one batch; running it again replaces them."""
    spark = streams["hits"].sparkSession
    members = [member_rows(streams[stream], names) for stream, names in KEPT.items()]
    times = [time_rows(streams[DWELL_OF[stream]], names) for stream, names in KEPT.items()]
    with versions.replacing(spark, root, [f"batch={batch}"]) as folder:
        _write(reduce(DataFrame.unionByName, members), f"{folder}/batch={batch}/what=members")
        _write(reduce(DataFrame.unionByName, times), f"{folder}/batch={batch}/what=times")


def _write(rows: DataFrame, path: str) -> None:
    """A folder per period, for a batch has few; families follow each other in a file, so readers of one skip the rest of it."""
    writers.gathered(rows, "period").sortWithinPartitions("period", "family").write.partitionBy("period").parquet(path)


def _stored(spark: SparkSession, root: str, what: str, wanted: Callable[[str], bool] = lambda part: True) -> DataFrame:
    schema = MEMBERS if what == "members" else TIMES
    found = [f"{p}/what={what}" for p in versions.paths(spark, root, wanted)]
    if not found:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", root).parquet(*found).select(*schema.names)


def _added(rows: DataFrame, keys: tuple[str, ...], measures: tuple[str, ...], grain: str) -> DataFrame:
    rows = rows.withColumn("period", F.lit("all")) if grain == "all" else rows
    return rows.groupBy("period", *keys).agg(*[F.sum(c).alias(c) for c in measures])


def _of(rows: DataFrame, name: str, period: str | None) -> DataFrame:
    rows = rows.where(F.col("family") == name)
    return rows if period is None else rows.where(F.col("period") == period)


def members_of(spark: SparkSession, root: str, name: str, period: str | None = None, grain: str = "day", area: bool = False) -> DataFrame:
    """Finest members of a family, added up over all batches; of one period only its folders are read."""
    counters = tuple(c for c in COUNTERS if area or not c.startswith("oth"))
    return _added(_of(_stored(spark, root, "members"), name, period), (*FAMILIES[name].keys, "kind", "id"), counters, grain)


def wide_rows(spark: SparkSession, root: str, name: str, parts: tuple[str, ...], period: str | None = None, grain: str = "day", area: bool | None = None) -> DataFrame:
    """All cells of a family from the stored counters: what ``wide_cells`` gives over the hits and dwell times of all batches."""
    family = FAMILIES[name]
    area = family.area if area is None else area
    visitors = cells_of_members(members_of(spark, root, name, period, grain, area), family, parts)
    sums = tuple(c for c in SUMS if area or c.split("_", 1)[1] in dwell_ops.slices(False))
    times = cells_of_sums(_added(_of(_stored(spark, root, "times"), name, period), family.keys, sums, grain), family)
    counts = [c for c in visitors.columns if c.endswith("bc")]
    return merge_cells([visitors.drop(*counts), times], ["period", "level", *family.keys])


def tables() -> dict[str, str]:
    """Result tables that the counters hold completely, and the family of each."""
    names = [n for group in KEPT.values() for n in group]
    return {FAMILIES[n].table: n for n in names}


def result_rows(spark: SparkSession, root: str, table: str, period: str | None = None) -> DataFrame:
    """All columns of a daily result table from the counters."""
    name, spec = tables()[table], RESULT_TABLES[table]
    parts = ("traffic", "bounce", "loyalty") if "loty_1_count" in spec.cells else ("traffic", "bounce")
    rows = wide_rows(spark, root, name, parts, period, area=True if table == "out_link" else None)
    if table == "out_link":
        split = [c for c in rows.columns if c.startswith(("other_", "china_"))]
        rows = rows.withColumns({c: F.when(F.col("level") == "total", F.col(c)) for c in split})
    columns = ["period", "level", *spec.keys, *spec.cells]
    return rows.withColumns({c: F.lit(None) for c in columns if c not in rows.columns}).select(*columns)


def fold(spark: SparkSession, root: str) -> None:
    """Add all stored batches up into one, for batches that will not run again."""
    parts = list(versions.current(spark, root))
    if len(parts) < 2:
        return
    with versions.replacing(spark, root, [FOLDED], [p for p in parts if p != FOLDED]) as folder:
        for what, keys, measures in (("members", ("family", *KEYS, "kind", "id"), COUNTERS), ("times", ("family", *KEYS), SUMS)):
            rows = _stored(spark, root, what, parts.__contains__)
            # A batch holds a key once, so adding before the exchange joins nothing; pieces of FOLD_ROWS are added in memory.
            rows = rows.repartition(max(1, -(-rows.count() // FOLD_ROWS)), "period", *keys)
            rows = _added(rows, keys, measures, "day")
            _write(rows, f"{folder}/{FOLDED}/what={what}")
