"""Schemas of the cleaned streams, the configuration tables and the result tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

_TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "long": T.LongType(),
}


def struct(spec: str) -> T.StructType:
    """``"ip wid new:int"`` -> StructType; a column without a type is text."""
    fields = []
    for item in spec.split():
        name, _, kind = item.partition(":")
        fields.append(T.StructField(name, _TYPES[kind or "string"]))
    return T.StructType(fields)


# Column order is the order of the delimited text files.
STREAMS: dict[str, T.StructType] = {
    "hits": struct(
        "ip wid page ref domain respondomain enter new:int se wb:int kw vtime province city area"
    ),
    "dwell": struct(
        "page ref domain page_avg_time:long respondomain enter new:int se wb:int kw province city area"
    ),
    "ad_hits": struct("ip wid domain new:int adsref adsnew:int adsid"),
    "ad_dwell": struct("domain adsid new:int page_avg_time:long"),
    "hot": struct("domain page x y u"),
    "click_marks": struct("page click"),
}

#: What a cleaning run writes: the streams, and the lines that gave no record with the reason.
KINDS = STREAMS | {"rejects": struct("line reason")}

# Narrower or older layouts of the same streams that exist as text files.
OLDER_STREAMS: dict[str, T.StructType] = {
    "hits_2014_site": struct("ip wid page ref domain respondomain enter new:int se wb:int kw"),
    "hits_2014_region": struct(
        "ip wid page ref domain respondomain enter new:int se wb:int kw vtime province city"
    ),
    "dwell_2014_site": struct(
        "page ref domain page_avg_time:long respondomain enter new:int se wb:int kw"
    ),
    "dwell_2014_region": struct(
        "page ref domain page_avg_time:long respondomain enter new:int se wb:int kw province city"
    ),
    "hits_2013_visitor": struct(
        "ip wid page ref domain path vtime respondomain new:int enter wb:int se"
    ),
    "dwell_2013_visitor": struct("page ref domain page_avg_time:long respondomain new:int wb:int se"),
    "hits_2013_host": struct("ip wid page ref domain path vtime respondomain new enter"),
    "dwell_2013_host": struct("page ref domain page_avg_time:long respondomain"),
    "hits_2013_page": struct("ip wid page querys status ref domain path"),
}

IP_RANGES = struct("begin_ip:long end_ip:long country area")
RULES_FILTER = struct("regex")
RULES_REWRITE = struct("priority:int regex replacement")
SITES = struct("domain")

# ---------------------------------------------------------------------------------------------
# Result tables

TRAFFIC = ["pv", "uv", "ip", "retpv", "retuv", "retip", "newpv", "newuv", "newip"]
BOUNCE = ["br", "retbr", "newbr"]
DWELL = ["avgtime", "retavgtime", "newavgtime"]
LOYALTY_BUCKETS = ["1", "2", "3", "4", "5_10", "11_20", "21_50", "50"]
LOYALTY_COUNTS = [f"loty_{b}_count" for b in LOYALTY_BUCKETS]
LOYALTY_RATES = [f"loty_{b}_rate" for b in LOYALTY_BUCKETS]


def by_area(cells: list[str]) -> list[str]:
    """The cells again for hits from outside (``other``) and inside (``china``) the home network."""
    return [prefix + c for prefix in ("", "other_", "china_") for c in cells]


@dataclass(frozen=True)
class ResultTable:
    keys: tuple[str, ...]
    cells: tuple[str, ...]
    text: frozenset[str] = frozenset()

    def schema(self, hourly: bool = False) -> T.StructType:
        """Hourly tables hold rates as percent text and times as clock text."""
        fields = [T.StructField(k, T.StringType()) for k in ("period", "level", *self.keys)]
        for cell in self.cells:
            text = cell in self.text or (hourly and cell.endswith(("br", "avgtime", "rate")))
            kind = T.StringType() if text else T.LongType()
            fields.append(T.StructField(cell, kind))
        return T.StructType(fields)


_BASE = TRAFFIC + BOUNCE + DWELL
_AREA = by_area(TRAFFIC) + by_area(BOUNCE) + by_area(DWELL)
_LOYAL = _BASE + LOYALTY_COUNTS + LOYALTY_RATES
_PERCENT = frozenset({"loty_1_rate"})


def _table(keys: str, cells: list[str], text: frozenset[str] = frozenset()) -> ResultTable:
    return ResultTable(tuple(keys.split()), tuple(cells), text)


RESULT_TABLES: dict[str, ResultTable] = {
    "domain": _table("domain", _LOYAL, _PERCENT),
    "ads": _table("domain adsid", _LOYAL, _PERCENT),
    "region_distribute": _table("domain province city", _BASE),
    "search_engines": _table("domain se_root se", _AREA),
    "search_word": _table("domain se_root se kw", _BASE),
    "search_region": _table("domain se_root se province city", _BASE),
    "out_link": _table("domain ref_root ref", _AREA),
    "out_region": _table("domain province city", _BASE),
    "direct_access": _table("domain", _AREA),
    "direct_region": _table("domain province city", _BASE),
    "respondomain": _table(
        "domain respondomain", ["pv", "uv", "br", "avg_time"], frozenset({"br", "avg_time"})
    ),
    "page": _table("domain page", ["pv", "uv"]),
    "detail": _table("page ref", ["count"]),
    "hotlink": _table("domain page u", ["count"]),
    "hotmap": _table("domain page x y", ["count"]),
    "heatmap": _table("page click", ["count"]),
    "gjsx": _table(
        "domain channel",
        ["retpv", "retuv", "newpv", "newuv", "retbr", "newbr", "retavgtime", "newavgtime"],
        frozenset({"retbr", "newbr", "retavgtime", "newavgtime"}),
    ),
}
