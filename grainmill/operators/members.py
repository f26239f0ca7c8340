"""The shared core of the visitor metrics: one row per (grain, visitor or address).

Every hit is turned into a visitor row and an address row, and both are aggregated to one *member*
row per (keys, kind, id). Page views, distinct visitors and addresses, bounces and loyalty are then
plain sums and conditional counts over member rows, so a report takes one wide exchange (hash of
keys and id, after map-side combining) and one small one (one row per task and grain). A visitor
that holds a large share of all hits costs one member row per map task, not a hot reducer.

Coarser grains of a hierarchy are built from the members of the finer grain, never from the hits
again. Finest members are dealt once by the keys that all grains share and the id; every coarser
grain groups by more than that, so it needs no exchange of its own, however many grains there are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.scalars import basis_points, percent_text

VISITOR, ADDRESS = "wid", "ip"
LOYALTY = [
    ("1", 1, 1),
    ("2", 2, 2),
    ("3", 3, 3),
    ("4", 4, 4),
    ("5_10", 5, 10),
    ("11_20", 11, 20),
    ("21_50", 21, 50),
    ("50", 51, None),
]


def members(
    hits: DataFrame,
    keys: list[str],
    ids: tuple[str, ...] = (VISITOR, ADDRESS),
    first: str = "ip",
    area: bool = False,
) -> DataFrame:
    """One row per (keys, kind, id).

    ``first`` is the column whose nulls a page-view count skips. Columns: ``rows`` (all hits),
    ``views`` (hits with a first column), each also for returning hits (``ret_``) and, with
    ``area``, for hits outside the home network (``oth_``, ``oth_ret_``).
    """
    flags = {"ret": F.col("new").isNull()}
    if area:
        flags["oth"] = F.col("area").isNull()
        flags["oth_ret"] = flags["oth"] & flags["ret"]
    flat = hits.select(
        *keys,
        F.col(first).isNotNull().alias("seen"),
        *[f.alias(name) for name, f in flags.items()],
        *[F.col(i).alias(f"id_{i}") for i in ids],
    )
    fixed = [c for c in flat.columns if not c.startswith("id_")]
    if len(ids) == 1:
        flat = flat.select(*fixed, F.lit(ids[0]).alias("kind"), F.col(f"id_{ids[0]}").alias("id"))
    else:
        # A generator, not an unpivot: the plans of two reports compare equal only with this one,
        # and then share the exchange.
        pairs = [x for i in ids for x in (F.lit(i), F.col(f"id_{i}"))]
        flat = flat.select(*fixed, F.stack(F.lit(len(ids)), *pairs).alias("kind", "id"))
    counts = ["count(1) as rows", "count_if(seen) as views"]
    for name in flags:
        counts += [f"count_if({name}) as {name}_rows", f"count_if({name} and seen) as {name}_views"]
    return flat.groupBy(*keys, "kind", "id").agg(*map(F.expr, counts))


def _flag_names(frame: DataFrame) -> list[str]:
    return [n for n in ("ret", "oth", "oth_ret") if f"{n}_rows" in frame.columns]


def _singleton_test(frame: DataFrame, cascade: bool = True) -> str:
    return "lone" if cascade and "lone" in frame.columns else "rows"


def at_home(frame: DataFrame, keys: list[str]) -> DataFrame:
    """Members dealt by the keys common to all grains, their kind and id.

    The members are combined before this: an id with a third of all hits is one row per finest group.
    """
    return frame.repartition(*keys, "kind", "id")


def coarsen(finer: DataFrame, keys: list[str], fresh: bool = False) -> DataFrame:
    """Members of a coarser grain, with ``lone``: the finer grain's surviving singletons.

    ``fresh`` starts a cascade anew: the rows of a member count, not what survived below. Reports of
    the two grains read the same columns of ``finer`` in the same order, which lets Spark reuse its
    exchange.
    """
    if fresh:
        measures = [f"{n}{m}" for n in ["", *[f"{n}_" for n in _flag_names(finer)]] for m in ("rows", "views")]
        return finer.groupBy(*keys, "kind", "id").agg(*[F.expr(f"sum({m}) as {m}") for m in measures])
    test = _singleton_test(finer)
    out = []
    for n in ["", *[f"{n}_" for n in _flag_names(finer)]]:
        out += [
            f"sum({n}rows) as {n}rows",
            f"sum({n}views) as {n}views",
            f"sum(case when {test} = 1 then {n}{test} else 0 end) as {n}lone",
        ]
    return finer.groupBy(*keys, "kind", "id").agg(*map(F.expr, out))


def tally(
    frame: DataFrame,
    keys: list[str],
    parts: tuple[str, ...] = ("traffic",),
    cascade: bool = False,
    present: str | None = None,
) -> DataFrame:
    """Counts per grain out of its members.

    ``parts``: ``traffic`` (views, visitors, addresses), ``bounce`` (visitors with one hit, or with
    ``cascade`` one surviving finer singleton), ``loyalty`` (visitors by number of views).
    ``present`` drops groups in which that key is null.
    """
    visitor, address = f"kind = '{VISITOR}'", f"kind = '{ADDRESS}'"
    test = _singleton_test(frame, cascade)
    out = []
    for n in ["", *[f"{n}_" for n in _flag_names(frame)]]:
        out.append(f"sum(case when {visitor} then {n}views else 0 end) as {n}pv")
        if "traffic" in parts or "loyalty" in parts:
            out.append(f"count_if({visitor} and id is not null and {n}rows > 0) as {n}uv")
        if "traffic" in parts:
            out.append(f"count_if({address} and id is not null and {n}rows > 0) as {n}ip")
        if "bounce" in parts or "loyalty" in parts:
            out.append(f"count_if({visitor} and {test} = 1 and {n}{test} = 1) as {n}bc")
    if "loyalty" in parts:
        for name, low, high in LOYALTY[1:]:
            inside = f"views >= {low}" if high is None else f"views between {low} and {high}"
            out.append(f"count_if({visitor} and {inside}) as loty_{name}_count")
    out = [F.expr(x) for x in out]
    if present is None:
        return _by_subtraction(frame.groupBy(*keys).agg(*out), keys)
    # Tested on an aggregate: a filter on the key would sink below the members' exchange and keep
    # it from being shared with the coarser grains.
    counts = frame.groupBy(*keys).agg(*out, F.max(F.col(present).isNotNull()).alias("present"))
    return _by_subtraction(counts.where("present"), keys)


def _by_subtraction(counts: DataFrame, keys: list[str]) -> DataFrame:
    """Rename to the result cells and add new = all - returning, china = all - other."""
    cells = []
    for m in ("pv", "uv", "ip", "bc"):
        if m not in counts.columns:
            continue
        cells += [m, f"ret_{m} as ret{m}", f"{m} - ret_{m} as new{m}"]
        if "oth_pv" in counts.columns:
            cells += [
                f"oth_{m} as other_{m}",
                f"oth_ret_{m} as other_ret{m}",
                f"oth_{m} - oth_ret_{m} as other_new{m}",
                f"{m} - oth_{m} as china_{m}",
                f"ret_{m} - oth_ret_{m} as china_ret{m}",
                f"({m} - ret_{m}) - (oth_{m} - oth_ret_{m}) as china_new{m}",
            ]
    rest = [c for c in counts.columns if c.startswith("loty_")]
    return counts.selectExpr(*keys, *cells, *rest)


def bounce_rates(counts: DataFrame, form: str = "points") -> DataFrame:
    """Add br, retbr, newbr (and the area variants); null where no page view is in the base.

    A grain without any bouncing visitor has no bounce cells at all, so all of them are null.
    """
    ratio = {"points": basis_points, "percent": percent_text}[form]
    any_bounce = F.col("bc") > 0
    prefixes = ["", "other_", "china_"] if "other_bc" in counts.columns else [""]
    rates = {
        f"{p}{v}br": F.when(any_bounce, ratio(f"{p}{v}bc", f"{p}{v}pv"))
        for p in prefixes
        for v in ("", "ret", "new")
    }
    return counts.withColumns(rates)


def loyalty_cells(counts: DataFrame, form: str = "points") -> DataFrame:
    """Loyalty counts and rates over all visitors of the grain.

    Bucket 1 is the bounce count and its rate is percent text; without a bouncing visitor it is
    null. The other rates follow ``form``.
    """
    ratio = {"points": basis_points, "percent": percent_text}[form]
    one = "nullif(bc, 0)"
    cells = {"loty_1_count": F.expr(one), "loty_1_rate": percent_text(one, "uv")}
    for name, _, _ in LOYALTY[1:]:
        cells[f"loty_{name}_rate"] = ratio(f"loty_{name}_count", "uv")
    return counts.withColumns(cells)
