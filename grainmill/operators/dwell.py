"""Dwell time: averages per grain, split by returning and new visitors and by network area."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.scalars import duration_text


def slices(area: bool) -> dict[str, str]:
    """Condition of each slice of the dwell times."""
    slices = {"": "true", "ret": "new is null", "new": "new is not null"}
    if area:
        for name, where in (("other", "area is null"), ("china", "area is not null")):
            slices |= {
                f"{name}_": where,
                f"{name}_ret": f"{where} and new is null",
                f"{name}_new": f"{where} and new is not null",
            }
    return slices


def dwell_sums(dwell: DataFrame, keys: list[str], area: bool = False) -> DataFrame:
    """Sum and count per grain and slice; these add up over coarser grains."""
    out = []
    for name, where in slices(area).items():
        value = "page_avg_time" if where == "true" else f"case when {where} then page_avg_time end"
        out += [f"sum({value}) as sum_{name}", f"count({value}) as cnt_{name}"]
    return dwell.groupBy(*keys).agg(*map(F.expr, out))


def roll_sums(sums: DataFrame, sets: list[list[str]], keys: list[str]) -> DataFrame:
    """Roll the sums up to several key sets at once; ``gid`` tells the sets apart."""
    measures = [c for c in sums.columns if c.startswith(("sum_", "cnt_"))]
    rolled = sums.groupingSets(sets, *keys).agg(
        *[F.sum(m).alias(m) for m in measures], F.grouping_id().alias("gid")
    )
    return rolled


def averages(sums: DataFrame, form: str = "long") -> DataFrame:
    """Replace sums by averages.

    ``long``: truncated average; ``clock``: rounded average as HH:mm:ss. An empty slice gives null.
    """
    names = [c.removeprefix("sum_") for c in sums.columns if c.startswith("sum_")]
    cells = []
    for name in names:
        mean = F.expr(f"cast(sum_{name} as double) / nullif(cnt_{name}, 0)")
        value = mean.cast("long") if form == "long" else duration_text(mean)
        cells.append(value.alias(f"{name}avgtime"))
    others = [c for c in sums.columns if not c.startswith(("sum_", "cnt_"))]
    return sums.select(*others, *cells)
