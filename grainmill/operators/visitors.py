"""Reports of the older layout: hosts, engine variants, links, and visitor type by channel.

Page views count rows with a visitor id here.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.scalars import duration_text, percent_text, root_of, whole_quotient
from .channels import predicate
from .members import bounce_rates, coarsen, loyalty_cells, members, tally
from .merge import zero_filled


def _count(condition: Column) -> Column:
    return F.count(F.when(condition, F.lit(1)))


def _visitors(hits: DataFrame, keys: list[str]) -> DataFrame:
    return members(hits, ["period", *keys], ("wid",), first="wid")


# ---- visited hosts ---------------------------------------------------------------------------


def host_bounce(hits: DataFrame) -> DataFrame:
    """Bounce rate per visited host; hosts nobody bounced on have rate zero."""
    keys = ["period", "domain", "respondomain"]
    counts = tally(_visitors(hits, keys[1:]), keys, ("bounce",))
    return counts.select(*keys, "pv", "bc", percent_text("bc", "pv").alias("br"))


def host_dwell(dwell: DataFrame) -> DataFrame:
    keys = ["period", "domain", "respondomain"]
    sums = dwell.groupBy(*keys).agg(F.sum("page_avg_time").alias("total"), F.count("domain").alias("n"))
    return sums.select(*keys, duration_text(whole_quotient("total", "n")).alias("avg_time"))


# ---- engine variants -------------------------------------------------------------------------

VARIANTS = {"": None, "www": r"^www\.", "m": r"^m\."}


def _stack_variants(df: DataFrame, keys: list[str], measures: list[str]) -> DataFrame:
    """``www_pv`` ... -> one row per variant; the variant without a prefix is the whole root."""
    rows = [
        F.struct(F.lit(v).alias("variant"), *[F.col(f"{v}_{x}" if v else x).alias(x) for x in measures])
        for v in VARIANTS
    ]
    return df.select(*keys, F.inline(F.array(*rows)))


def _engine_counts(hits: DataFrame) -> DataFrame:
    """Views, visitors and single hits per engine root, also for its www and m hosts."""
    keys = ["period", "domain", "se_root"]
    se_hits = hits.where(F.col("se").isNotNull()).withColumn("se_root", root_of("se"))
    hosts = se_hits.groupBy(*keys, "se", "wid").agg(F.count("wid").alias("views"), F.count(F.lit(1)).alias("rows"))
    measures = []
    for v, pattern in VARIANTS.items():
        here = F.lit(True) if pattern is None else F.col("se").rlike(pattern)
        name = f"{v}_" if v else ""
        measures += [
            F.sum(F.when(here, F.col("views")).otherwise(0)).alias(f"{name}pv"),
            F.sum(F.when(here, F.col("rows")).otherwise(0)).alias(f"{name}rows"),
            _count(here & (F.col("rows") == 1)).alias(f"{name}bc"),
        ]
    per_visitor = hosts.groupBy(*keys, "wid").agg(*measures)
    totals = []
    for v in VARIANTS:
        name = f"{v}_" if v else ""
        totals += [
            F.sum(f"{name}pv").alias(f"{name}pv"),
            _count(F.col("wid").isNotNull() & (F.col(f"{name}rows") > 0)).alias(f"{name}uv"),
            F.sum(f"{name}bc").alias(f"{name}bc"),
        ]
    return per_visitor.groupBy(*keys).agg(*totals)


def engine_variant_traffic(hits: DataFrame) -> DataFrame:
    keys = ["period", "domain", "se_root"]
    rows = _stack_variants(_engine_counts(hits), keys, ["pv", "uv"])
    return rows.where((F.col("variant") == "") | (F.col("pv") != 0))


def engine_variant_bounce(hits: DataFrame) -> DataFrame:
    """Roots with at least one bouncing visitor; variants without page views are dropped."""
    keys = ["period", "domain", "se_root"]
    counts = _engine_counts(hits).where("bc > 0")
    rows = _stack_variants(counts, keys, ["pv", "bc"])
    rated = rows.withColumn("br", percent_text("bc", "pv"))
    return rated.where(F.col("br").isNotNull())


def engine_variant_dwell(dwell: DataFrame) -> DataFrame:
    keys = ["period", "domain", "se_root"]
    rows = dwell.where(F.col("se").isNotNull()).withColumn("se_root", root_of("se"))
    means = []
    for v, pattern in VARIANTS.items():
        value = F.col("page_avg_time")
        if pattern is not None:
            value = F.when(F.col("se").rlike(pattern), value)
        mean = F.sum(value).cast("double") / F.nullif(F.count(value), F.lit(0))
        means.append(duration_text(mean).alias(f"{v}_avgtime" if v else "avgtime"))
    stacked = _stack_variants(rows.groupBy(*keys).agg(*means), keys, ["avgtime"])
    return stacked.where((F.col("variant") == "") | F.col("avgtime").isNotNull())


# ---- external links, every grain from the raw hits -------------------------------------------


def link_raw(hits: DataFrame) -> DataFrame:
    """Views, visitors and bounces per referrer root and referrer; no cascade at the root."""
    wb_hits = hits.where(predicate("wb")).withColumn("ref_root", root_of("ref"))
    keys = ["period", "domain", "ref_root", "ref"]
    sub = members(wb_hits, keys, ("wid",), first="wid")
    root = coarsen(sub, keys[:3])
    parts = ("bounce", "loyalty")
    counts = tally(sub, keys, parts).unionByName(
        tally(root, keys[:3], parts).withColumn("ref", F.lit("")), allowMissingColumns=True
    )
    br = F.when(F.col("bc") > 0, percent_text("bc", "pv"))
    return counts.select(*keys, "pv", "uv", "bc", br.alias("br"))


# ---- new and returning visitors --------------------------------------------------------------


def new_by_left_join(hits: DataFrame, keys: list[str]) -> DataFrame:
    """New visitors as all minus returning, where a grain may have no returning visitor."""
    keys = ["period", *keys]
    every = _plain_traffic(hits, keys)
    returning = _plain_traffic(hits.where(F.col("new").isNull()), keys)
    returning = returning.select(*keys, F.col("pv").alias("retpv"), F.col("uv").alias("retuv"))
    both = zero_filled(every, returning, keys)
    return both.select(
        *keys, "pv", "uv", "retpv", "retuv",
        (F.col("pv") - F.col("retpv")).alias("newpv"),
        (F.col("uv") - F.col("retuv")).alias("newuv"),
    )


def _plain_traffic(hits: DataFrame, keys: list[str]) -> DataFrame:
    per_visitor = hits.groupBy(*keys, "wid").agg(F.count("wid").alias("views"))
    return per_visitor.groupBy(*keys).agg(F.sum("views").alias("pv"), F.count("wid").alias("uv"))


def visitor_bounce(hits: DataFrame, keys: list[str]) -> DataFrame:
    """Bounce rates of all, returning and new visitors as percent text."""
    counts = tally(_visitors(hits, keys), ["period", *keys], ("bounce",))
    return bounce_rates(counts, "percent").where("bc > 0")


def visitor_loyalty(hits: DataFrame, keys: list[str]) -> DataFrame:
    """Loyalty with every rate as percent text."""
    counts = tally(_visitors(hits, keys), ["period", *keys], ("loyalty",))
    return loyalty_cells(counts, "percent")


# ---- visitor type by channel -----------------------------------------------------------------

CHANNELS = {"wb": "wb", "zj": "direct"}


def _stack_channels(df: DataFrame, keys: list[str], measures: list[str]) -> DataFrame:
    rows = [
        F.struct(F.lit(c).alias("channel"), *[F.col(f"{c}_{x}").alias(x) for x in measures])
        for c in CHANNELS
    ]
    return df.select(*keys, F.inline(F.array(*rows)))


def channel_visitors(hits: DataFrame) -> DataFrame:
    """Views, visitors and bounces per site and channel of returning and of new visitors.

    New visitors are counted directly here, not by subtraction. A bounce is a visitor with one hit
    on the site, and that hit lies in the channel.
    """
    keys = ["period", "domain"]
    types = {"ret": F.col("new").isNull(), "new": F.col("new").isNotNull()}
    measures, totals = [F.count(F.lit(1)).alias("rows")], []
    for c, channel in CHANNELS.items():
        for t, of_type in types.items():
            name = f"{c}_{t}"
            here = predicate(channel) & of_type
            measures += [
                _count(here).alias(f"{name}_rows"),
                _count(here & F.col("wid").isNotNull()).alias(f"{name}_views"),
            ]
            totals += [
                F.sum(f"{name}_views").alias(f"{name}pv"),
                _count(F.col("wid").isNotNull() & (F.col(f"{name}_rows") > 0)).alias(f"{name}uv"),
                _count((F.col("rows") == 1) & (F.col(f"{name}_rows") == 1)).alias(f"{name}bc"),
            ]
    per_visitor = hits.groupBy(*keys, "wid").agg(*measures)
    cells = [f"{t}{x}" for t in types for x in ("pv", "uv", "bc")]
    stacked = _stack_channels(per_visitor.groupBy(*keys).agg(*totals), keys, cells)
    rates = {
        f"{t}br": F.when(F.col(f"{t}bc") > 0, percent_text(f"{t}bc", f"{t}pv")) for t in types
    }
    return stacked.withColumns(rates)


def channel_dwell(dwell: DataFrame) -> DataFrame:
    """Average dwell of returning and new visitors per channel, from whole quotients."""
    keys = ["period", "domain"]
    means = []
    for c, channel in CHANNELS.items():
        for t, of_type in (("ret", F.col("new").isNull()), ("new", F.col("new").isNotNull())):
            here = predicate(channel) & of_type
            quotient = whole_quotient(F.sum(F.when(here, F.col("page_avg_time"))), _count(here & F.col("ref").isNotNull()))
            means.append(duration_text(quotient).alias(f"{c}_{t}avgtime"))
    return _stack_channels(dwell.groupBy(*keys).agg(*means), keys, ["retavgtime", "newavgtime"])


def visitor_dwell(dwell: DataFrame, keys: list[str]) -> DataFrame:
    """Average dwell of all, returning and new visitors as whole quotients of milliseconds."""
    known = F.col("ref").isNotNull()
    out = []
    for name, where in (("", F.lit(True)), ("ret", F.col("new").isNull()), ("new", F.col("new").isNotNull())):
        total = F.sum(F.when(where, F.col("page_avg_time")))
        out.append(whole_quotient(total, _count(where & known)).alias(f"{name}avgtime"))
    return dwell.groupBy("period", *keys).agg(*out)
