"""The grain registry: which keys, channel and bounce rule each report uses."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from ..functions.scalars import root_of
from ..operators import channels, dwell as dwell_ops, members as m
from ..operators.merge import merge_cells


@dataclass(frozen=True)
class Level:
    """One grain of a family, and how visitors bounce at it.

    ``cascade``: a bouncing visitor has exactly one surviving singleton at the finer level;
    otherwise exactly one hit. ``present`` drops groups in which that key is missing. ``of`` names
    the finer level (the one before if empty), and ``fresh`` starts a cascade anew from its members.
    """

    name: str
    keys: tuple[str, ...]
    cascade: bool = False
    present: str | None = None
    of: str = ""
    fresh: bool = False


@dataclass(frozen=True)
class Family:
    """Grains that nest, finest first, over one channel."""

    table: str
    levels: tuple[Level, ...]
    channel: str = "all"
    area: bool = False
    hits: str = "hits"
    dwell: str = "dwell"

    @property
    def keys(self) -> tuple[str, ...]:
        return self.levels[0].keys

    @property
    def common(self) -> tuple[str, ...]:
        """Keys of every level."""
        return tuple(k for k in self.keys if all(k in level.keys for level in self.levels))


def _region(extra: str = "") -> tuple[Level, ...]:
    return (
        Level(f"{extra}city", ("domain", "province", "city"), present="city"),
        Level(f"{extra}province", ("domain", "province")),
    )


FAMILIES: dict[str, Family] = {
    "site": Family("domain", (Level("site", ("domain",)),)),
    "ad": Family("ads", (Level("ad", ("domain", "adsid")),), "ads", hits="ad_hits", dwell="ad_dwell"),
    "region": Family("region_distribute", _region()),
    "engine": Family(
        "search_engines",
        (
            Level("sub", ("domain", "se_root", "se")),
            Level("root", ("domain", "se_root"), cascade=True),
            Level("total", ("domain",), cascade=True),
        ),
        "se",
        area=True,
    ),
    "keyword": Family(
        "search_word",
        (
            Level("sub", ("domain", "se_root", "se", "kw")),
            Level("root", ("domain", "se_root", "kw"), cascade=True),
            Level("total", ("domain", "kw"), cascade=True),
        ),
        "se",
    ),
    # Both region families over engines at once: the city levels leave out hits without a city.
    "engine_region": Family(
        "search_region",
        (
            Level("sub_city", ("domain", "se_root", "se", "province", "city"), present="city"),
            Level("root_city", ("domain", "se_root", "province", "city"), cascade=True, present="city"),
            Level("total_city", ("domain", "province", "city"), cascade=True, present="city"),
            Level("sub_province", ("domain", "se_root", "se", "province"), of="sub_city", fresh=True),
            Level("root_province", ("domain", "se_root", "province"), cascade=True),
            Level("total_province", ("domain", "province"), cascade=True),
        ),
        "se",
    ),
    "engine_province": Family(
        "",
        (
            Level("sub_province", ("domain", "se_root", "se", "province")),
            Level("root_province", ("domain", "se_root", "province"), cascade=True),
            Level("total_province", ("domain", "province"), cascade=True),
        ),
        "se",
    ),
    "engine_city": Family(
        "",
        (
            Level("sub_city", ("domain", "se_root", "se", "province", "city")),
            Level("root_city", ("domain", "se_root", "province", "city"), cascade=True),
            Level("total_city", ("domain", "province", "city"), cascade=True),
        ),
        "se_city",
    ),
    "link": Family(
        "out_link",
        (
            Level("sub", ("domain", "ref_root", "ref")),
            Level("root", ("domain", "ref_root"), cascade=True),
            Level("total", ("domain",)),
        ),
        "wb",
    ),
    "link_total": Family("out_link", (Level("total", ("domain",)),), "wb", area=True),
    "link_region": Family("out_region", _region(), "wb"),
    "direct": Family("direct_access", (Level("total", ("domain",)),), "direct", area=True),
    "direct_region": Family("direct_region", _region(), "direct"),
}


def with_roots(df: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """Add the engine or referrer root when a grain asks for it."""
    if "se_root" in keys:
        df = df.withColumn("se_root", root_of("se"))
    if "ref_root" in keys:
        df = df.withColumn("ref_root", root_of("ref"))
    return df


def _prepared(df: DataFrame, family: Family, channel: str | None) -> DataFrame:
    return with_roots(channels.in_channel(df, channel or family.channel), family.keys)


def _labelled(df: DataFrame, family: Family, level: Level) -> DataFrame:
    """Give every level the key columns of the finest one; rolled-up keys are empty text."""
    measures = [c for c in df.columns if c not in ("period", "present", *family.keys)]
    keys = [F.col(k) if k in level.keys else F.lit("").alias(k) for k in family.keys]
    return df.select("period", F.lit(level.name).alias("level"), *keys, *measures)


def visitor_cells(
    hits: DataFrame,
    family: Family,
    parts: tuple[str, ...] = ("traffic",),
    *,
    area: bool | None = None,
    rates: str = "points",
    channel: str | None = None,
    first: str = "ip",
) -> DataFrame:
    """Traffic, bounce and loyalty cells of all levels of a family; ``hits`` carries ``period``.

    The finest members are exchanged once to combine them, and once more to their home if there are
    coarser levels, which are all built there; the counts of each level read that exchange again
    instead of the hits.
    """
    area = family.area if area is None else area
    ids = (m.VISITOR, m.ADDRESS) if "traffic" in parts else (m.VISITOR,)
    prepared = _prepared(hits, family, channel)
    return cells_of_members(m.members(prepared, ["period", *family.keys], ids, first, area), family, parts, rates)


def cells_of_members(frame: DataFrame, family: Family, parts: tuple[str, ...], rates: str = "points") -> DataFrame:
    """The same cells from the finest members of a family, one row per member."""
    # Coarser levels start from the members at home; the finest one is counted where its members are.
    home = m.at_home(frame, ["period", *family.common]) if len(family.levels) > 1 else frame
    frames = {family.levels[0].name: home}
    finer, reports = home, []
    for level in family.levels:
        keys = ["period", *level.keys]
        if level is not family.levels[0]:
            finer = frame = m.coarsen(frames[level.of] if level.of else finer, keys, level.fresh)
            frames[level.name] = frame
        counts = m.tally(frame, keys, parts, level.cascade, level.present)
        if "bounce" in parts:
            counts = m.bounce_rates(counts, rates)
        if "loyalty" in parts:
            counts = m.loyalty_cells(counts, rates)
        reports.append(_labelled(counts, family, level))
    return reduce(DataFrame.unionByName, reports)


def dwell_cells(
    dwell: DataFrame,
    family: Family,
    *,
    area: bool | None = None,
    form: str = "long",
    channel: str | None = None,
) -> DataFrame:
    """Average dwell time of all levels of a family; ``dwell`` carries ``period``."""
    area = family.area if area is None else area
    keys = ["period", *family.keys]
    return cells_of_sums(dwell_ops.dwell_sums(_prepared(dwell, family, channel), keys, area), family, form)


def cells_of_sums(sums: DataFrame, family: Family, form: str = "long") -> DataFrame:
    """The same cells from sums and counts by the finest keys."""
    keys = ["period", *family.keys]
    if len(family.levels) == 1 and not family.levels[0].present:
        return _labelled(dwell_ops.averages(sums, form), family, family.levels[0])
    sets = [["period", *level.keys] for level in family.levels]
    rolled = dwell_ops.roll_sums(sums, sets, keys)
    gid = F.col("gid")
    name, keep = F.lit(None).cast("string"), F.lit(True)
    for level in family.levels:
        here = gid == _grouping_id(keys, ["period", *level.keys])
        name = F.when(here, F.lit(level.name)).otherwise(name)
        if level.present:
            keep = keep & (~here | F.col(level.present).isNotNull())
    bits = {k: 1 << (len(keys) - 1 - i) for i, k in enumerate(keys)}
    rolled_up = {
        k: F.when(gid.bitwiseAND(F.lit(bits[k])) != 0, F.lit("")).otherwise(F.col(k))
        for k in family.keys
    }
    labelled = rolled.where(keep).withColumn("level", name).withColumns(rolled_up)
    cells = dwell_ops.averages(labelled.drop("gid"), form)
    measures = [c for c in cells.columns if c.endswith("avgtime")]
    return cells.select("period", "level", *family.keys, *measures)


def _grouping_id(columns: list[str], grouped: list[str]) -> int:
    return sum(0 if c in grouped else 1 << (len(columns) - 1 - i) for i, c in enumerate(columns))


def wide_cells(
    hits: DataFrame,
    dwell: DataFrame,
    family: Family,
    *,
    loyalty: bool = False,
    area: bool | None = None,
    rates: str = "points",
    form: str = "long",
    channel: str | None = None,
) -> DataFrame:
    """Every cell of a family's rows: traffic, bounce, optional loyalty and dwell, merged by key."""
    parts = ("traffic", "bounce", "loyalty") if loyalty else ("traffic", "bounce")
    visitors = visitor_cells(hits, family, parts, area=area, rates=rates, channel=channel)
    counts = [c for c in visitors.columns if c.endswith("bc")]
    times = dwell_cells(dwell, family, area=area, form=form, channel=channel)
    return merge_cells([visitors.drop(*counts), times], ["period", "level", *family.keys])
