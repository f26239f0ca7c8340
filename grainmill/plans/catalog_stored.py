"""Registered queries over stored counters, sketches and files in the shared folder."""

from __future__ import annotations

from contextlib import ExitStack

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions import scalars as sc
from ..operators import behaviour, clean, geo, sketches
from ..session import kept, remove
from ..sources import readers, writers
from . import fixture as fx, oracle as o, state
from .catalog import CATALOG, Query, _folder, register
from .grains import FAMILIES, visitor_cells

# ---- counters of two batches ------------------------------------------------------------------


def _two_batches(spark: SparkSession, d: str, again: bool = False) -> str:
    """All streams as two batches that share visitors, days and groups; ``again`` runs the second one twice, as after a failure."""
    root = _folder(spark, "counters")
    streams = {k: fx.STREAMS[k](spark, d) for k in ("hits", "dwell", "ad_hits", "ad_dwell")}
    with ExitStack() as made:
        # Each stream is made once; a batch reads its rows.
        halves = {k: made.enter_context(kept(s.withColumn("half", F.pmod(F.xxhash64(*s.columns), F.lit(2))), k)) for k, s in streams.items()}
        for n, batch in ((0, "20240131"), *[(1, "2024020107")] * (1 + again)):
            state.add_batch({k: s.where(F.col("half") == n).drop("half") for k, s in halves.items()}, root, batch)
    return root


def _from_counters(family: str, loyalty: bool = False, folded: bool = False) -> Query:
    def run(spark: SparkSession, d: str) -> DataFrame:
        root = _two_batches(spark, d, again=loyalty)
        if folded:
            state.fold(spark, root)
        return state.wide_rows(spark, root, family, ("traffic", "bounce", "loyalty") if loyalty else ("traffic", "bounce"))

    return run


register("counters_site", CATALOG["site_dashboard"].sql)(_from_counters("site", loyalty=True))
register("counters_ad", CATALOG["ad_dashboard"].sql)(_from_counters("ad", loyalty=True, folded=True))
register("counters_engine", CATALOG["engine_rows"].sql)(_from_counters("engine"))
register("counters_keyword", CATALOG["keyword_rows"].sql)(_from_counters("keyword", folded=True))


@register("counters_search_region", CATALOG["table_search_region"].sql)
def counters_search_region(spark, d):
    return state.result_rows(spark, _two_batches(spark, d), "search_region")


@register("counters_out_link", CATALOG["table_out_link"].sql)
def counters_out_link(spark, d):
    return state.result_rows(spark, _two_batches(spark, d), "out_link")


@register("counters_loyalty_alltime", CATALOG["loyalty_site_alltime"].sql)
def counters_loyalty_alltime(spark, d):
    rows = state.wide_rows(spark, _two_batches(spark, d), "site", ("loyalty",), grain="all")
    return rows.select("period", "domain", *[c for c in rows.columns if c.startswith("loty_") and c.endswith("count")])


# ---- sketches ---------------------------------------------------------------------------------


@register(
    "sketch_daily_visitors",
    f"{o.base('hits')} select period, domain, count(ip) as pv, count(distinct wid) as uv, count(distinct ip) as ip, "
    "count(case when new is null then ip end) as retpv, true as within from hits group by period, domain",
)
def sketch_daily_visitors(spark, d):
    """Hourly sketches, stored and united to days, beside the exact counts: every estimate is within four standard errors."""
    path = _folder(spark, "sketches")
    cells = sketches.sketch_cells(fx.hits(spark, d, "hour"), ["period", "domain"])
    writers.gathered(cells, "period").write.parquet(path)
    hours = spark.read.schema(cells.schema).parquet(path).withColumn("period", F.substring("period", 1, 8))
    days = sketches.estimates(sketches.united(hours, ["period", "domain"]))
    days = days.select("period", "domain", "pv", "retpv", F.col("uv").alias("near_uv"), F.col("ip").alias("near_ip"))
    exact = visitor_cells(fx.hits(spark, d), FAMILIES["site"], ("traffic",)).select("period", "domain", "uv", "ip")
    most = 4 * sketches.standard_error()
    close = lambda cell: F.abs(F.col(f"near_{cell}") - F.col(cell)) <= most * F.col(cell)
    joined = days.join(exact, ["period", "domain"])
    return joined.select("period", "domain", "pv", "uv", "ip", "retpv", (close("uv") & close("ip")).alias("within"))


# ---- stored periods, ordered keys, log ranges -------------------------------------------------

_DAY = "20240115"


@register(
    "replaced_period",
    f"{o.base('hits')} select period, domain, page, count(ip) as pv, count(distinct wid) as uv from hits "
    f"where wb=1 or period='{_DAY}' group by period, domain, page",
)
def replaced_period(spark, d):
    """All days stored from some hits, then one day replaced by all of its hits."""
    root, hits = _folder(spark, "periods"), fx.hits(spark, d)
    level = F.lit("page").alias("level")
    page = lambda rows: behaviour.views_and_visitors(rows, ["domain", "page"], "ip").select("*", level)
    writers.upsert_table(page(hits.where("wb = 1")), root, "page")
    writers.replace_period(page(hits), root, "page", _DAY)
    return writers.read_table(spark, root, "page").drop("level")


@register(
    "key_prefix_rows",
    f"{o.base('hits')}, c as (select period, page, ref, count(*) as n from hits group by all) "
    f"select concat(period, chr(26), bin(-n), chr(26), page, chr(26), ref) as row_key, n as count from c where period='{_DAY}'",
)
def key_prefix_rows(spark, d):
    """Counts on disk in the order of their descending keys; a day is read by the prefix of its keys."""
    path = _folder(spark, "ordered")
    counts = behaviour.page_referrers(fx.hits(spark, d))
    rows = counts.select(sc.row_key_descending("period", "count", "page", "ref").alias("row_key"), "count")
    writers.write_in_key_order(rows, "row_key", path, files=16)
    return writers.read_key_prefix(spark, rows.schema, "row_key", path, f"{_DAY}{sc.SEP}")


_BEGIN, _END = "2024011510", "2024011705"


@register(
    "log_range_hours",
    f"select {o.HOUR} as hour, count(*) as n from events where {o.HOUR} between '{_BEGIN}' and '{_END}' group by all",
)
def log_range_hours(spark, d):
    """Raw lines in files by day and hour, read back from one hour to another two days later."""
    root, prefix = _folder(spark, "logs"), "access."
    time = F.split("value", sc.SEP)[2]
    name = F.translate(F.substring(time, 1, 13), "- ", "")
    lines = fx.raw_lines(spark, d).withColumns({"d": F.substring(name, 1, 8), "h": name})
    days = lines.where(F.col("d").between(_BEGIN[:8], _END[:8]))
    writers.gathered(days, "d", "h").write.partitionBy("d", "h").text(f"{root}/spark")
    path = spark._jvm.org.apache.hadoop.fs.Path
    store = path(root).getFileSystem(spark._jsc.hadoopConfiguration())
    for hour in readers.hours_between(_BEGIN[:8], _END[:8]):
        source, target = path(f"{root}/spark/d={hour[:8]}/h={hour}"), path(f"{root}/log/{hour[:8]}/{prefix}{hour}")
        if store.exists(source):
            store.mkdirs(target.getParent())
            store.rename(source, target)
    remove(spark, f"{root}/spark")
    found = readers.log_range(spark, f"{root}/log", _BEGIN, _END, prefix)
    return found.select(name.alias("hour")).groupBy("hour").agg(F.count(F.lit(1)).alias("n"))


# ---- nested address ranges --------------------------------------------------------------------

_NESTED = (
    f"with r as (select {fx.RANGE_BEGIN} as b, {fx.RANGE_END} as e, n_name as country, n_nationkey as k from nation), "
    "n as (select b, e, country, 'whole' as area from r "
    "union all select b - 3000, e + 20000, country, 'wide' from r where k % 4 = 1 "
    "union all select b + 700, b + 4200, country, 'part' from r where k % 2 = 0 "
    "union all select b + 1500, b + 1500 + k, country, 'few' from r where k % 3 = 0) "
)


def nested_ranges(spark: SparkSession, d: str) -> DataFrame:
    """Ranges around, over and inside those of each nation."""
    nations = fx.table(spark, d, "nation")
    cases = [("whole", "true", 0, "e"), ("wide", "n_nationkey % 4 = 1", -3000, "e + 20000")]
    cases += [("part", "n_nationkey % 2 = 0", 700, "b + 4200"), ("few", "n_nationkey % 3 = 0", 1500, "b + 1500 + n_nationkey")]
    rows = nations.selectExpr("n_nationkey", "n_name as country", f"{fx.RANGE_BEGIN} as b", f"{fx.RANGE_END} as e")
    out = None
    for area, where, shift, end in cases:
        part = rows.where(where).selectExpr(f"b + {shift} as begin_ip", f"{end} as end_ip", "country", f"'{area}' as area")
        out = part if out is None else out.unionByName(part)
    return out


_IP = "cast(regexp_extract(ip,'^([0-9]+)',1) as bigint)*16777216 + cast(regexp_extract(ip,'^[0-9]+.([0-9]+)',1) as bigint)*65536 + cast(regexp_extract(ip,'^[0-9]+.[0-9]+.([0-9]+)',1) as bigint)*256 + cast(regexp_extract(ip,'([0-9]+)$',1) as bigint)"


@register(
    "ip_nested_ranges",
    f"{_NESTED}, e as (select *, {fx.K} as k from events), h as (select {fx.EXPRESSIONS['ip']} as ip from e where not ({fx.IS_CLOSE})), i as (select distinct ip, {_IP} as x from h), "
    "m as (select ip, arg_min(country, [e - b, -b]) as country, arg_min(area, [e - b, -b]) as area from i join n on x between b and e group by ip) "
    "select ip, count(*) as hits, coalesce(country, '未知国家') as country, coalesce(area, '未知地区') as area from h left join m using (ip) group by all",
)
def ip_nested_ranges(spark, d):
    """The most specific range of each address, where ranges lie inside and across each other."""
    hits = fx.hits(spark, d).groupBy("ip").agg(F.count(F.lit(1)).alias("hits"))
    return geo.locate(hits, nested_ranges(spark, d)).select("ip", "hits", "country", "area")


# ---- rules and click texts --------------------------------------------------------------------

_MANY = [rf"wid={3 * n}[;]" for n in range(2000)]


@register(
    "many_rules",
    f"select {o.DAY} as period, count(*) as lines, count(case when event_id%50<>23 and user_id%37<>0 and user_id%3=0 and user_id<6000 then 1 end) as listed "
    "from events group by all",
)
def many_rules(spark, d):
    """Lines that any of 2,000 patterns occurs in."""
    lines = fx.raw_lines(spark, d).withColumn("period", F.translate(F.substring(F.split("value", sc.SEP)[2], 1, 10), "-", ""))
    return lines.groupBy("period").agg(F.count(F.lit(1)).alias("lines"), F.count_if(clean.blacklisted("value", _MANY)).alias("listed"))


# Click texts by event_id % 10, with what each one holds: x, y and u, or nothing.
_SHAPES = [
    ("concat('[{x:',k,',y:2.50,t:b}]')", "k", "'2.5'", "null"),
    ("concat('[{x:',k,',y:2,t:a,u:http://a.b/',k,'}]')", None, None, None),
    ("concat('[{''x'':',k,',\"y\":''2.50'',t:a,u:\"a:b,',k,'\"}]')", "k", "'2.50'", "concat('a:b,',k)"),
    ("concat('[{x:1,y:',k)", None, None, None),
    ("concat('[{x:',k,';y=2;t=>b},] tail {')", "k", "'2'", "null"),
    ("concat('[{x:',k,',y:7,t:a,u:''it said \"hi\"''}]')", "k", "'7'", "'it said \"hi\"'"),
    ("concat('[{x:',k,',y:5,y:6}]')", None, None, None),
    ("concat('[ { x : ',k,' , y : two words , u : null } ]')", "k", "'two words'", "null"),
    ("concat('[{x:',k,',y:{a:1}}]')", None, None, None),
    ("concat('[{y:007,x:',k,'.0,u:http%3A%2F%2Fa}]')", "k", "'007'", "'http%3A%2F%2Fa'"),
]


def _by_shape(i: int) -> str:
    cases = " ".join(f"when {n} then {_text(shape[i])}" for n, shape in enumerate(_SHAPES) if shape[i])
    return f"case event_id%10 {cases} end"


def _text(part: str) -> str:
    return part.replace(",k,", ",cast(k as string),").replace(",k)", ",cast(k as string))") if part != "k" else "cast(k as string)"


_READABLE = ", ".join(str(n) for n, shape in enumerate(_SHAPES) if shape[1])


@register(
    "click_json_shapes",
    f"with e as (select *, {fx.K} as k from events) select event_id, {_by_shape(1)} as x, {_by_shape(2)} as y, {_by_shape(3)} as u from e where event_id%10 in ({_READABLE})",
)
def click_json_shapes(spark, d):
    """Click texts of many shapes, each with the coordinates that a tolerant reader finds in it."""
    texts = fx.events(spark, d).select("event_id", F.expr(_by_shape(0).replace("''", "\\'")).alias("hot"))
    return texts.select("event_id", F.explode(clean.parse_hot("hot")).alias("p")).select("event_id", "p.x", "p.y", "p.u")
