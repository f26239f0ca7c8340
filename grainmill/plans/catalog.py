"""Every registered query, each with the plain SQL it has to agree with."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions import location, scalars as sc
from ..operators import behaviour, clean, geo, members as m, visitors
from ..operators.merge import matched, merge_cells, overlay
from ..operators.periods import with_period
from ..schemas import OLDER_STREAMS, SITES
from ..session import shared_folder
from ..sources import readers
from ..sources.writers import read_table, upsert_table, write_by_key, write_streams, write_text
from . import fixture as fx, oracle as o
from .grains import FAMILIES, dwell_cells, visitor_cells, wide_cells
from .jobs import result_table

Query = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Entry:
    run: Query
    sql: str | None


CATALOG: dict[str, Entry] = {}


def register(name: str, sql: str | None) -> Callable[[Query], Query]:
    def add(run: Query) -> Query:
        CATALOG[name] = Entry(run, sql)
        return run

    return add


# ---- families: traffic, bounce, dwell per grain ----------------------------------------------


def _hits(spark: SparkSession, d: str, family: str, grain: str = "day") -> DataFrame:
    return fx.STREAMS[FAMILIES[family].hits](spark, d, grain)


def _dwell(spark: SparkSession, d: str, family: str, grain: str = "day") -> DataFrame:
    return fx.STREAMS[FAMILIES[family].dwell](spark, d, grain)


def _traffic(family: str, area: bool = False, level: str | None = None, grain: str = "day", channel=None) -> Query:
    def run(spark: SparkSession, d: str) -> DataFrame:
        rows = visitor_cells(
            _hits(spark, d, family, grain), FAMILIES[family], ("traffic",), area=area, channel=channel
        )
        return rows if level is None else rows.where(F.col("level") == level)

    return run


def _bounce(family: str, area: bool = False, level: str | None = None, grain: str = "day", rates: str = "points") -> Query:
    def run(spark: SparkSession, d: str) -> DataFrame:
        rows = visitor_cells(_hits(spark, d, family, grain), FAMILIES[family], ("bounce",), area=area, rates=rates)
        rows = rows if level is None else rows.where(F.col("level") == level)
        base = [c for c in rows.columns if c.endswith("pv")]
        return rows.where("bc > 0").drop(*base)

    return run


def _dwell_time(family: str, area: bool = False, level: str | None = None, grain: str = "day", form: str = "long") -> Query:
    def run(spark: SparkSession, d: str) -> DataFrame:
        rows = dwell_cells(_dwell(spark, d, family, grain), FAMILIES[family], area=area, form=form)
        return rows if level is None else rows.where(F.col("level") == level)

    return run


CASCADED = {"engine", "keyword", "engine_province", "engine_city", "link"}

for _name in FAMILIES:
    if _name in ("region", "link_total", "engine_region"):
        continue
    _suffix = "_cascade" if _name in CASCADED else ""
    register(f"traffic_{_name}", o.family(_name, "traffic"))(_traffic(_name))
    register(f"bounce_{_name}{_suffix}", o.family(_name, "bounce"))(_bounce(_name))
    register(f"dwell_{_name}", o.family(_name, "dwell"))(_dwell_time(_name))

for _level in ("province", "city"):
    register(f"traffic_{_level}", o.family("region", "traffic", only=_level))(_traffic("region", level=_level))
    register(f"bounce_{_level}", o.family("region", "bounce", only=_level))(_bounce("region", level=_level))
    register(f"dwell_{_level}", o.family("region", "dwell", only=_level))(_dwell_time("region", level=_level))

for _name, _label in (("engine", "engine"), ("link_total", "link"), ("direct", "direct")):
    register(f"traffic_{_label}_area", o.family(_name, "traffic", area=True))(_traffic(_name, True))
    register(f"bounce_{_label}_area", o.family(_name, "bounce", area=True))(_bounce(_name, True))
    register(f"dwell_{_label}_area", o.family(_name, "dwell", area=True))(_dwell_time(_name, True))

register("traffic_direct_any_referrer", o.family("direct", "traffic", channel="ref is not null"))(
    _traffic("direct", channel="has_ref")
)
register("traffic_site_alltime", o.family("site", "traffic", "all"))(_traffic("site", grain="all"))

# ---- hourly ----------------------------------------------------------------------------------

register("hourly_traffic_site", o.family("site", "traffic", "hour"))(_traffic("site", grain="hour"))
register("bounce_site_pct", o.family("site", "bounce", hourly=True))(_bounce("site", rates="percent"))
register("dwell_site_fmt", o.family("site", "dwell", hourly=True))(_dwell_time("site", form="clock"))


def _wide(family: str, grain: str = "day", loyalty: bool = False) -> Query:
    rates, form = ("percent", "clock") if grain == "hour" else ("points", "long")

    def run(spark: SparkSession, d: str) -> DataFrame:
        cells = wide_cells(
            _hits(spark, d, family, grain), _dwell(spark, d, family, grain), FAMILIES[family],
            loyalty=loyalty, rates=rates, form=form,
        )
        return cells

    return run


for _name in (
    "site", "engine", "engine_province", "engine_city", "link_total", "link_region", "direct", "direct_region",
):
    register(
        f"hourly_{_name}", o.family(_name, "wide", "hour", FAMILIES[_name].area, hourly=True)
    )(_wide(_name, "hour"))

# ---- whole rows ------------------------------------------------------------------------------

for _name, _label in (("site", "site_dashboard"), ("ad", "ad_dashboard")):
    register(_label, o.family(_name, "wide", loyalty_too=True))(_wide(_name, loyalty=True))
for _name, _label in (
    ("region", "region_rows"), ("engine", "engine_rows"), ("keyword", "keyword_rows"), ("direct", "direct_rows"),
):
    register(_label, o.family(_name, "wide", area=FAMILIES[_name].area))(_wide(_name))

# ---- loyalty ---------------------------------------------------------------------------------


def _loyalty(family: str, what: str, grain: str = "day") -> Query:
    def run(spark: SparkSession, d: str) -> DataFrame:
        rows = visitor_cells(_hits(spark, d, family, grain), FAMILIES[family], ("loyalty",), area=False)
        keys = ["period", *FAMILIES[family].keys]
        return rows.select(*keys, *[c for c in rows.columns if c.startswith("loty_") and c.endswith(what)])

    return run


for _name, _src, _keys in (("site", "hits", "domain"), ("ad", "ad_hits", "domain, adsid")):
    register(f"loyalty_{_name}", f"{o.base(_src)} {o.loyalty(_src, _keys, 'count')}")(_loyalty(_name, "count"))
    register(f"loyalty_{_name}_rate", f"{o.base(_src)} {o.loyalty(_src, _keys, 'rate')}")(_loyalty(_name, "rate"))
register("loyalty_site_alltime", f"{o.base('hits', 'all')} {o.loyalty('hits', 'domain', 'count')}")(
    _loyalty("site", "count", "all")
)

# ---- hosts, pages, clicks --------------------------------------------------------------------


@register("traffic_host", f"{o.base('hits')} {o.older_counts('hits', 'period, domain, respondomain')}")
def traffic_host(spark, d):
    return behaviour.views_and_visitors(fx.hits(spark, d), ["domain", "respondomain"])


@register("traffic_page", f"{o.base('hits')} {o.older_counts('hits', 'period, domain, page')}")
def traffic_page(spark, d):
    return behaviour.views_and_visitors(fx.hits(spark, d), ["domain", "page"], "ip")


@register("site_views_visitors", f"{o.base('hits')} {o.older_counts('hits', 'period, domain')}")
def site_views_visitors(spark, d):
    return behaviour.views_and_visitors(fx.hits(spark, d), ["domain"], "ip")


_HOST = "period, domain, respondomain"


@register(
    "host_bounce_zero_filled",
    f"{o.base('hits')}, b as (select {_HOST}, count(*) as bc from ({o.singles('hits', _HOST)}) group by {_HOST}), "
    f"t as ({o.older_counts('hits', _HOST)}) "
    f"select {_HOST}, pv, coalesce(bc,0) as bc, {o.pct('coalesce(bc,0)', 'pv')} as br from t left join b using ({_HOST})",
)
def host_bounce_zero_filled(spark, d):
    return visitors.host_bounce(fx.hits(spark, d))


@register(
    "dwell_host_fmt",
    f"{o.base('dwell')} select {_HOST}, {o.clock('(sum(page_avg_time)//count(domain))')} as avg_time "
    f"from dwell group by {_HOST}",
)
def dwell_host_fmt(spark, d):
    return visitors.host_dwell(fx.dwell(spark, d))


@register("link_clicks", f"{o.base('hot')} select period, domain, page, u, count(*) as count from hot group by all")
def link_clicks(spark, d):
    return behaviour.link_clicks(fx.hot(spark, d))


@register("click_positions", f"{o.base('hot')} select period, domain, page, x, y, count(*) as count from hot group by all")
def click_positions(spark, d):
    return behaviour.click_positions(fx.hot(spark, d))


@register("click_marks", f"{o.base('click_marks')} select period, page, click, count(*) as count from click_marks group by all")
def click_marks(spark, d):
    return behaviour.click_marks(fx.click_marks(spark, d))


@register("page_referrer_counts", f"{o.base('hits')} select period, page, ref, count(*) as count from hits group by all")
def page_referrer_counts(spark, d):
    return behaviour.page_referrers(fx.hits(spark, d))


@register(
    "row_key_descending",
    f"{o.base('hits')}, c as (select period, page, ref, count(*) as n from hits group by all) "
    "select concat(period, chr(26), bin(-n), chr(26), page, chr(26), ref) as row_key, n as count from c",
)
def row_key_descending(spark, d):
    counts = behaviour.page_referrers(fx.hits(spark, d))
    key = sc.row_key_descending("period", "count", "page", "ref")
    return counts.select(key.alias("row_key"), "count")


@register(
    "row_key",
    f"{o.base('hits')}, c as (select distinct period, domain, province, city from hits) "
    "select period, domain, province, city, "
    "concat(period, chr(26), domain, chr(26), province, chr(26), coalesce(city,'')) as row_key, "
    "concat(period, chr(26), domain) as key_head from c",
)
def row_key(spark, d):
    groups = fx.hits(spark, d).select("period", "domain", "province", "city").distinct()
    keyed = groups.withColumn("row_key", sc.row_key("period", "domain", "province", "city"))
    return keyed.withColumn("key_head", sc.key_head("row_key"))


@register(
    "exit_page",
    f"{o.base('hits')} select period, domain, wid, page, ts_text as vtime from (select *, "
    "substr(cast(ts as string),1,19) as ts_text, "
    "row_number() over (partition by period, domain, wid order by ts desc, seq desc) as rn from hits) where rn=1",
)
def exit_page(spark, d):
    last = behaviour.exit_pages(fx.timed_hits(spark, d), ["domain", "wid"])
    return last.withColumn("vtime", F.substring(F.col("vtime").cast("string"), 1, 19))


@register(
    "marker_count",
    f"{o.base('hits')} select period, domain, count(case when ref in ('1','-') then 1 end) as ref_marks, "
    "count(case when cast(new as string) in ('1','-') then 1 end) as new_marks, "
    "count(case when kw in ('1','-') then 1 end) as kw_marks from hits group by period, domain",
)
def marker_count(spark, d):
    return behaviour.markers(fx.hits(spark, d), ["domain"], ["ref", "new", "kw"])


# ---- older layouts ---------------------------------------------------------------------------

_ENGINE = "period, domain, se_root"
_VARIANT = {"": "true", "www": "se like 'www.%'", "m": "se like 'm.%'"}


def _variants(cells: dict[str, str], src: str, where: str, keep: str) -> str:
    selects = []
    for v, cond in _VARIANT.items():
        picked = ", ".join(f"{expr.format(c=cond)} as {name}" for name, expr in cells.items())
        sql = f"select {_ENGINE}, '{v}' as variant, {picked} from {src} where {where} group by {_ENGINE}"
        selects.append(sql if not v else f"select * from ({sql}) where {keep}")
    return " union all ".join(selects)


_VARIANT_TRAFFIC = _variants(
    {"pv": "count(case when {c} then wid end)", "uv": "count(distinct case when {c} then wid end)"},
    "hits", o.SE, "pv<>0",
)
_SINGLE_SE = o.singles("hits", "period, domain, se_root, se", o.SE)


@register("engine_www_mobile_traffic", f"{o.base('hits')} {_VARIANT_TRAFFIC}")
def engine_www_mobile_traffic(spark, d):
    return visitors.engine_variant_traffic(fx.hits(spark, d))


_VARIANT_BOUNCE = _variants({"bc": "count(case when {c} then 1 end)"}, f"({_SINGLE_SE})", "true", "true")


@register(
    "engine_www_mobile_bounce",
    f"{o.base('hits')}, t as ({_VARIANT_TRAFFIC}), b as ({_VARIANT_BOUNCE}) "
    f"select {_ENGINE}, variant, pv, bc, {o.pct('bc', 'pv')} as br from t join b using ({_ENGINE}, variant) where pv>0",
)
def engine_www_mobile_bounce(spark, d):
    return visitors.engine_variant_bounce(fx.hits(spark, d))


@register(
    "engine_www_mobile_dwell",
    f"{o.base('dwell')} "
    + _variants({"avgtime": o.clock("avg(case when {c} then page_avg_time end)")}, "dwell", o.SE, "avgtime is not null"),
)
def engine_www_mobile_dwell(spark, d):
    return visitors.engine_variant_dwell(fx.dwell(spark, d))


def _link_raw() -> str:
    selects = []
    for keys, label in (("period, domain, ref_root, ref", "ref"), ("period, domain, ref_root", "''")):
        counts = o.older_counts("hits", keys, o.WB)
        ones = f"select {keys}, count(*) as b from ({o.singles('hits', keys, o.WB)}) group by {keys}"
        selects.append(
            f"select period, domain, ref_root, {label} as ref, pv, uv, coalesce(b,0) as bc, {o.pct('b', 'pv')} as br "
            f"from ({counts}) left join ({ones}) using ({keys})"
        )
    return f"{o.base('hits')} " + " union all ".join(selects)


@register("link_raw", _link_raw())
def link_raw(spark, d):
    return visitors.link_raw(fx.hits(spark, d))


@register("dwell_link_fmt", o.family("link", "dwell", hourly=True))
def dwell_link_fmt(spark, d):
    return dwell_cells(fx.dwell(spark, d), FAMILIES["link"], form="clock")


@register(
    "new_visitors_left_join",
    f"{o.base('hits')}, a as ({o.older_counts('hits', 'period, domain, province')}), "
    "r as (select period, domain, province, count(wid) as rp, count(distinct wid) as ru from hits "
    "where new is null group by period, domain, province) "
    "select period, domain, province, pv, uv, coalesce(rp,0) as retpv, coalesce(ru,0) as retuv, "
    "pv-coalesce(rp,0) as newpv, uv-coalesce(ru,0) as newuv from a left join r using (period, domain, province)",
)
def new_visitors_left_join(spark, d):
    return visitors.new_by_left_join(fx.hits(spark, d), ["domain", "province"])


@register(
    "visitor_bounce",
    o.base("hits") + " "
    + o.bounce(
        f"select period, domain, count(wid) as pv, count(case when new is null then wid end) as retpv, "
        f"count(wid)-count(case when new is null then wid end) as newpv from hits group by period, domain",
        o.bounce_counts(o.singles("hits", "period, domain"), "period, domain"),
        "period, domain", rate=o.pct,
    ),
)
def visitor_bounce(spark, d):
    return visitors.visitor_bounce(fx.hits(spark, d), ["domain"]).drop("pv", "retpv", "newpv")


@register("loyalty_visitor_pct", f"{o.base('hits')} {o.loyalty('hits', 'domain', 'all', 'wid', o.pct)}")
def loyalty_visitor_pct(spark, d):
    rows = visitors.visitor_loyalty(fx.hits(spark, d), ["domain"])
    return rows.select("period", "domain", *[c for c in rows.columns if c.startswith("loty_")])


def _visitor_dwell() -> str:
    cells = [
        f"cast(sum(case when {c} then page_avg_time end)//nullif(count(case when {c} then ref end),0) as bigint) as {n}avgtime"
        for n, c in (("", "true"), ("ret", "new is null"), ("new", "new is not null"))
    ]
    return f"{o.base('dwell')} select period, domain, {', '.join(cells)} from dwell group by period, domain"


@register("dwell_visitor_int", _visitor_dwell())
def dwell_visitor_int(spark, d):
    return visitors.visitor_dwell(fx.dwell(spark, d), ["domain"])


_TYPES = {"ret": "new is null", "new": "new is not null"}
_CHANNELS = {"wb": "wb=1", "zj": "ref='-'"}


def _channel_visitors(what: str) -> str:
    selects = []
    for ch, cond in _CHANNELS.items():
        cells = []
        for t, of in _TYPES.items():
            cells += [
                f"count(case when {cond} and {of} then wid end) as {t}pv",
                f"count(distinct case when {cond} and {of} then wid end) as {t}uv",
            ]
        counts = f"select period, domain, {', '.join(cells)} from hits group by period, domain"
        ones = (
            "select period, domain, wid, max(new) as new, max(wb) as wb, max(ref) as ref from hits "
            "group by period, domain, wid having count(*)=1"
        )
        b = ", ".join(f"count(case when {cond} and {of} then 1 end) as {t}bc" for t, of in _TYPES.items())
        bounces = f"select period, domain, {b} from ({ones}) group by period, domain"
        if what == "traffic":
            out = "retpv, retuv, newpv, newuv"
        else:
            out = "coalesce(retbc,0) as retbc, coalesce(newbc,0) as newbc, " + ", ".join(
                f"case when {t}bc>0 then {o.pct(t + 'bc', t + 'pv')} end as {t}br" for t in _TYPES
            )
        selects.append(
            f"select period, domain, '{ch}' as channel, {out} from ({counts}) left join ({bounces}) using (period, domain)"
        )
    return f"{o.base('hits')} " + " union all ".join(selects)


@register("visitor_channel_traffic", _channel_visitors("traffic"))
def visitor_channel_traffic(spark, d):
    keys = ["period", "domain", "channel"]
    return visitors.channel_visitors(fx.hits(spark, d)).select(*keys, "retpv", "retuv", "newpv", "newuv")


@register("visitor_channel_bounce", _channel_visitors("bounce"))
def visitor_channel_bounce(spark, d):
    keys = ["period", "domain", "channel"]
    return visitors.channel_visitors(fx.hits(spark, d)).select(*keys, "retbc", "newbc", "retbr", "newbr")


def _channel_dwell() -> str:
    selects = []
    for ch, cond in _CHANNELS.items():
        cells = [
            o.clock(
                f"(sum(case when {cond} and {of} then page_avg_time end)"
                f"//nullif(count(case when {cond} and {of} then ref end),0))"
            ) + f" as {t}avgtime"
            for t, of in _TYPES.items()
        ]
        selects.append(f"select period, domain, '{ch}' as channel, {', '.join(cells)} from dwell group by period, domain")
    return f"{o.base('dwell')} " + " union all ".join(selects)


@register("visitor_channel_dwell", _channel_dwell())
def visitor_channel_dwell(spark, d):
    return visitors.channel_dwell(fx.dwell(spark, d))


# ---- cleaning --------------------------------------------------------------------------------

RULES = clean.Rules(fx.FILTER_RULES, fx.REWRITE_RULES)


def _cleaned(spark: SparkSession, d: str) -> DataFrame:
    return clean.clean(fx.raw_lines(spark, d), RULES, fx.sites(spark, d), fx.ip_ranges(spark, d))


def _clean_stream(kind: str) -> Query:
    return lambda spark, d: clean.stream(_cleaned(spark, d), kind)


# The province and city of each location text, written out.
_PLACE = """case n_nationkey%9 when 0 then '北京' when 1 then '广东' when 2 then '湖北' when 3 then '云南'
when 4 then '西藏' when 5 then '内蒙古' when 6 then '上海' when 7 then n_name else '未知' end"""
_TOWN = """case n_nationkey%9 when 0 then '海淀区' when 1 then '广州市' when 2 then '利川市'
when 3 then '大理州' when 4 then '拉萨市' when 5 then '包头市' end"""
_COUNTY = "case n_nationkey%9 when 1 then '天河区' end"
_NET = "case n_nationkey%4 when 1 then '电信' when 2 then '联通' end"
_IPN = (
    "(cast(split_part(ip,'.',1) as bigint)*16777216+cast(split_part(ip,'.',2) as bigint)*65536"
    "+cast(split_part(ip,'.',3) as bigint)*256+cast(split_part(ip,'.',4) as bigint))"
)
_RANGES = (
    f"r as (select {fx.RANGE_BEGIN} as begin_ip, {fx.RANGE_END} as end_ip, {fx.COUNTRY} as country, "
    f"{fx.RANGE_AREA} as range_area, {_PLACE} as r_province, {_TOWN} as r_city, {_COUNTY} as r_district, {_NET} as r_net from nation)"
)


def _clean_base() -> str:
    """The streams the raw lines must come back as, straight from the events."""
    x = fx.EXPRESSIONS
    picked = ", ".join(f"{x[c]} as {c}" for c in x if c not in ("page", "ref", "area", "province", "city", "domain"))
    return (
        f"with e as (select *, {fx.K} as k, event_id%50 as fault from events), {_RANGES}, "
        f"p as (select *, {picked}, case when k%50=49 then '-' else event_type end as domain, "
        "'http://' || event_type || '.example.com/p/' || case when k%12>=10 then 'tens' else 'ones' end as page, "
        f"split_part({x['ref']},'?',1) as ref, substr(cast(ts as string),1,19) as vtime, "
        "fault in (29,31) as is_mark, event_id%4=3 as is_close, "
        "case when fault=41 then 'blacklisted' when fault=23 then 'field_count' when fault=11 then 'script_load' "
        "when fault=13 then 'bad_status' when fault=7 then 'http_error' when fault=17 then 'no_page' "
        "when fault=19 then 'bad_url' end as reason, "
        f"{x['ref']} as plain_ref from e), "
        f"l as (select p.*, coalesce(r_province,'未知国家') as province, r_city as city, "
        f"case when r.begin_ip is null then '未知地区' else r_net end as area "
        f"from p left join r on {_IPN} between r.begin_ip and r.end_ip)"
    )


_TRACKED = "domain not in ('error','-')"
_CLEAN_SELECTS = {
    "hits": "select ip, wid, page, ref, domain, respondomain, enter, new, se, wb, kw, vtime, province, city, area "
    f"from l where reason is null and not is_mark and not is_close and {_TRACKED}",
    "dwell": "select page, ref, domain, page_avg_time, respondomain, enter, new, se, wb, kw, province, city, area, vtime "
    f"from l where reason is null and not is_mark and is_close and {_TRACKED} and fault not in (35,37)",
    "ad_hits": "select ip, wid, domain, new, adsref, adsnew, adsid, vtime "
    "from l where reason is null and not is_mark and not is_close and adsid is not null",
    "ad_dwell": "select domain, adsid, new, case when fault in (35,37) then null else page_avg_time end as page_avg_time, vtime "
    "from l where reason is null and not is_mark and is_close and adsid is not null",
    "hot": "select domain, page, x, y, u, vtime from l where reason is null and not is_mark and k%3=0 union all "
    "select domain, page, l.y || '.5' as x, l.x as y, null as u, vtime from l where reason is null and not is_mark and k%3=0",
    "click_marks": "select page, click, vtime from l where reason is null and is_mark and fault<>31",
}
for _kind, _select in _CLEAN_SELECTS.items():
    register(f"clean_{_kind}", f"{_clean_base()} {_select}")(_clean_stream(_kind))


@register(
    "clean_kind_counts",
    _clean_base() + " " + " union all ".join(
        f"select '{k}' as kind, count(*) as records from ({s})" for k, s in _CLEAN_SELECTS.items()
    ),
)
def clean_kind_counts(spark, d):
    return clean.route(_cleaned(spark, d)).groupBy("kind").agg(F.count(F.lit(1)).alias("records"))


@register(
    "clean_rejects",
    f"{_clean_base()}, "
    "w as (select coalesce(reason, case when is_mark and fault=31 then 'blank_click' "
    "when is_mark then null "
    "when adsid is not null or k%3=0 then null "
    "when is_close and fault in (35,37) then 'blank_dwell' "
    f"when not ({_TRACKED}) then 'untracked_site' end) as reason from l) "
    "select reason, count(*) as line_count from w where reason is not null group by reason",
)
def clean_rejects(spark, d):
    lost = clean.rejects(_cleaned(spark, d))
    return lost.groupBy("reason").agg(F.count(F.lit(1)).alias("line_count"))


@register(
    "clean_to_site_traffic",
    f"{_clean_base()}, h as (select *, replace(substr(vtime,1,10),'-','') as period from ({_CLEAN_SELECTS['hits']})) "
    + o.traffic("h", "period, domain, province"),
)
def clean_to_site_traffic(spark, d):
    hits = with_period(clean.stream(_cleaned(spark, d), "hits"))
    keys = ["period", "domain", "province"]
    return m.tally(m.members(hits, keys), keys, ("traffic",))


# ---- scalar functions over the page URLs -----------------------------------------------------

_URLS = "with p as (select page_id, url, html from pages) "


@register(
    "url_decode",
    _URLS + "select page_id, url_decode(url_encode(url)) as decoded, "
    "url_decode(replace(url,'/','%2F')) as slashes, cast(null as string) as broken from p",
)
def url_decode(spark, d):
    pages = fx.table(spark, d, "pages")
    return pages.select(
        "page_id",
        sc.url_decoded(F.url_encode("url")).alias("decoded"),
        sc.url_decoded(F.replace("url", F.lit("/"), F.lit("%2F"))).alias("slashes"),
        sc.url_decoded(F.concat("url", F.lit("%zz"))).alias("broken"),
    )


@register(
    "url_host",
    _URLS + "select page_id, coalesce(nullif(regexp_extract(url,'^(?:https?://)?([^/]+)',1),''),'-') as host from p",
)
def url_host(spark, d):
    return fx.table(spark, d, "pages").select("page_id", sc.host_of("url").alias("host"))


@register("url_query_strip", _URLS + "select page_id, split_part(url,'?',1) as page from p")
def url_query_strip(spark, d):
    return fx.table(spark, d, "pages").select("page_id", sc.without_query("url").alias("page"))


_URL_RULES = [
    (r"^https?://blog\.([a-z]+)\.example\.(com|net|org)/", "http://$1.example.$2/blog/"),
    (r"/[0-9]+(\.html)?", "/n"),
    (r"example", "never-after-the-second-rule"),
]


@register(
    "url_canonical",
    _URLS + "select page_id, split_part(case "
    r"when regexp_matches(url,'^https?://blog\.([a-z]+)\.example\.(com|net|org)/') then "
    r"regexp_replace(url,'^https?://blog\.([a-z]+)\.example\.(com|net|org)/','http://\1.example.\2/blog/','g') "
    r"when regexp_matches(url,'/[0-9]+(\.html)?') then regexp_replace(url,'/[0-9]+(\.html)?','/n','g') "
    "when regexp_matches(url,'example') then regexp_replace(url,'example','never-after-the-second-rule','g') "
    "else url end,'?',1) as canonical from p",
)
def url_canonical(spark, d):
    rule = sc.rewritten("url", _URL_RULES)
    return fx.table(spark, d, "pages").select("page_id", sc.without_query(rule).alias("canonical"))


@register(
    "referrer_root",
    _URLS + f"select page_id, {o.ROOT.format(c='url')} as url_root, "
    + o.ROOT.format(c="host") + " as host_root from "
    "(select *, regexp_extract(url,'^(?:https?://)?([^/]+)',1) as host from p)",
)
def referrer_root(spark, d):
    return fx.table(spark, d, "pages").select(
        "page_id", sc.root_of("url").alias("url_root"), sc.root_of(sc.host_of("url")).alias("host_root")
    )


@register(
    "line_blacklist",
    _URLS + "select page_id, url from p where not regexp_matches(url,'(?:spam-farm|utm_source=|#top$)')",
)
def line_blacklist(spark, d):
    pages = fx.table(spark, d, "pages").select("page_id", "url")
    return pages.where(~clean.blacklisted("url", ["spam-farm", "utm_source=", "#top$"]))


@register("tracked_sites_semi", f"{o.base('hits')} select period, domain, wid, page from hits where domain<>'error'")
def tracked_sites_semi(spark, d):
    kept = clean.only_tracked(fx.hits(spark, d), fx.sites(spark, d))
    return kept.select("period", "domain", "wid", "page")


@register(
    "hot_json_explode",
    "with e as (select *, " + fx.K + " as k from events) "
    "select event_id, cast(k as string) || '.5' as x, cast(event_id%7 as string) as y, "
    "case when k%2=0 then 'http://a.example/' || cast(k as string) end as u from e union all "
    "select event_id, '7' as x, cast(k as string) as y, null as u from e",
)
def hot_json_explode(spark, d):
    text = F.expr(
        "concat('[{x:', k, '.50, y:', event_id%7, ', t:', case when k%2=0 then 'a' else 'b' end, "
        "',u:\"http%3A%2F%2Fa.example%2F', k, '%3Fq=1\"},{\"x\":\"7\",y:', k, '}]')"
    )
    points = fx.events(spark, d).select("event_id", F.explode(clean.parse_hot(text)).alias("p"))
    link = F.when(F.col("p.t") == "a", sc.without_query(sc.url_decoded("p.u")))
    return points.select("event_id", "p.x", "p.y", link.alias("u"))


# ---- addresses -------------------------------------------------------------------------------

_LOCATED = (
    f"{o.base('hits')}, {_RANGES} select seq, ip, coalesce(country,'未知国家') as country, "
    f"coalesce(range_area,'未知地区') as area from (select seq, ip from hits) left join r on {_IPN} between begin_ip and end_ip"
)


def _addresses(spark: SparkSession, d: str) -> DataFrame:
    e = fx.events(spark, d).where(f"not ({fx.IS_CLOSE})")
    return e.select(F.col("event_id").alias("seq"), F.expr(fx.EXPRESSIONS["ip"]).alias("ip"))


@register("ip_region_range_join", _LOCATED)
def ip_region_range_join(spark, d):
    return geo.locate(_addresses(spark, d), fx.ip_ranges(spark, d))


@register("ip_region_window", _LOCATED)
def ip_region_window(spark, d):
    pieces = geo.range_pieces(fx.ip_ranges(spark, d))
    return geo.locate_by_window(_addresses(spark, d), pieces)


@register(
    "traffic_located_province",
    f"{o.base('hits')}, {_RANGES}, h as (select period, domain, ip, wid, new, coalesce(r_province,'未知国家') as province "
    f"from hits left join r on {_IPN} between begin_ip and end_ip) " + o.traffic("h", "period, domain, province"),
)
def traffic_located_province(spark, d):
    hits = fx.hits(spark, d).drop("province", "city", "area")
    keys = ["period", "domain", "province"]
    return m.tally(m.members(geo.with_location(hits, fx.ip_ranges(spark, d)), keys), keys, ("traffic",))


@register(
    "location_parts",
    f"{o.base('hits')}, {_RANGES} select seq, coalesce(r_province,'未知国家') as province, r_city as city, "
    "r_district as district, case when begin_ip is null then '未知地区' else r_net end as area "
    f"from (select seq, ip from hits) left join r on {_IPN} between begin_ip and end_ip",
)
def location_parts(spark, d):
    located = geo.locate(_addresses(spark, d), fx.ip_ranges(spark, d))
    return located.select(
        "seq",
        location.province_of("country").alias("province"),
        location.city_of("country").alias("city"),
        location.district_of("country").alias("district"),
        location.area_of("area").alias("area"),
    )


@register(
    "location_search",
    f"{o.base('hits')}, {_RANGES} select begin_ip, end_ip, count(seq) as hit_count from r left join hits "
    f"on {_IPN} between begin_ip and end_ip where contains(country,'州') or contains(range_area,'州') group by begin_ip, end_ip",
)
def location_search(spark, d):
    return geo.hits_in_ranges(geo.find_ranges(fx.ip_ranges(spark, d), "州"), _addresses(spark, d))


@register(
    "ip_number",
    f"{o.base('hits')} select seq, {_IPN} as n, ip as back from hits",
)
def ip_number(spark, d):
    n = sc.ip_number("ip")
    return _addresses(spark, d).select("seq", n.alias("n"), sc.ip_text(n).alias("back"))


# ---- times and ratios ------------------------------------------------------------------------


@register(
    "duration_text",
    f"with t as (select event_id, value*40000 as ms from events) select event_id, {o.clock('ms')} as took from t",
)
def duration_text(spark, d):
    e = fx.table(spark, d, "events")
    return e.select("event_id", sc.duration_text(F.col("value") * 40000).alias("took"))


@register(
    "time_helpers",
    "with t as (select event_id, cast(event_id*7919000037 as bigint) as us from events) "
    "select event_id, us, epoch_us(make_timestamp(us)) as back, "
    "strftime(make_timestamp(us),'%Y-%m-%d %H:%M:%S') as text, "
    "(us//60000000)*60000 as minute_ms, (us//1000000)*1000000 as second_us from t",
)
def time_helpers(spark, d):
    t = fx.table(spark, d, "events").select("event_id", F.expr("event_id*7919000037").alias("us"))
    time = sc.micros_to_time("us")
    text = sc.time_text(time)
    return t.select(
        "event_id",
        "us",
        sc.time_to_micros(time).alias("back"),
        text.alias("text"),
        sc.minute_to_millis(F.substring(text, 1, 16)).alias("minute_ms"),
        sc.time_to_micros(sc.to_time(text)).alias("second_us"),
    )


@register(
    "ratio_points",
    "with t as (select event_id, event_id%97 as a, event_id%89 as b from events) "
    f"select event_id, {o.bp('a', 'b')} as points, cast(a//nullif(b,0) as bigint) as whole, "
    "cast((a//nullif(b,0)//nullif(b,0))%nullif(b,0) as bigint) as chained from t",
)
def ratio_points(spark, d):
    t = fx.table(spark, d, "events").selectExpr("event_id", "event_id%97 as a", "event_id%89 as b")
    whole = sc.whole_quotient("a", "b")
    chained = sc.whole_quotient(whole, F.col("b")) % F.nullif(F.col("b"), F.lit(0))
    return t.select("event_id", sc.basis_points("a", "b").alias("points"), whole.alias("whole"), chained.alias("chained"))


@register(
    "array_functions",
    f"{o.base('hits')} select seq, len(string_split(ref,'/'))=1 as single, "
    "len(string_split(page,'/')) between 4 and 5 as few, string_split(ref,'/')[1] as first_part, "
    "new is null and se is null as no_source, "
    "concat(period, chr(26), domain) as first_head from hits",
)
def array_functions(spark, d):
    e = fx.events(spark, d).where(f"not ({fx.IS_CLOSE})").withColumnRenamed("event_id", "seq")
    names = {c: F.expr(fx.EXPRESSIONS[c].replace("event_id", "seq")) for c in ("ref", "page", "new", "se", "domain")}
    hits = with_period(e.withColumns(names), "day", "ts")
    return hits.select(
        "seq",
        sc.size_is(F.split("ref", "/"), 1).alias("single"),
        sc.size_between(F.split("page", "/"), 4, 5).alias("few"),
        sc.first_text(F.split("ref", "/")).alias("first_part"),
        sc.array_blank(F.array(F.col("new").cast("string"), F.col("se"))).alias("no_source"),
        sc.first_key_head(F.array(sc.row_key("period", "domain", "page"))).alias("first_head"),
    )


def _added(rows: DataFrame, suffix: str) -> DataFrame:
    """A relation macro: sum of two columns as text with a parameter behind it."""
    total = (F.col("x") + F.col("y")).cast("string")
    return rows.select("event_id", F.concat(total, F.lit(suffix)).alias("added"))


@register(
    "relation_macro",
    "select event_id, cast(event_id%97 + user_id as string) || '20140220' as added from events",
)
def relation_macro(spark, d):
    rows = fx.table(spark, d, "events").selectExpr("event_id", "event_id%97 as x", "user_id as y")
    return rows.transform(_added, "20140220")


# ---- joins, merges and group sizes -----------------------------------------------------------


@register(
    "metric_inner_join",
    f"{o.base('hits dwell')} select * from ({o.older_counts('hits', 'period, domain, page')}) "
    f"join ({o.dwell('dwell', 'period, domain, page')}) using (period, domain, page)",
)
def metric_inner_join(spark, d):
    from ..operators.dwell import averages, dwell_sums

    keys = ["period", "domain", "page"]
    views = behaviour.views_and_visitors(fx.hits(spark, d), keys[1:])
    return matched(views, averages(dwell_sums(fx.dwell(spark, d), keys)), keys)


@register(
    "group_size_filter",
    f"{o.base('hits')} select period, domain, wid, count(*) as n from hits group by all having count(*) between 2 and 4",
)
def group_size_filter(spark, d):
    return behaviour.sized_groups(fx.hits(spark, d), ["period", "domain", "wid"], 2, 4)


@register(
    "upsert_rows",
    f"{o.base('hits')}, s as (select period, domain, count(*) as pv, count(distinct wid) as uv from hits where wb=1 group by all), "
    "f as (select period, domain, count(*) as pv from hits where k_new group by all) "
    "select period, domain, coalesce(f.pv, s.pv) as pv, s.uv as uv from s full join f using (period, domain)".replace(
        "where k_new", "where new=1"
    ),
)
def upsert_rows(spark, d):
    hits = fx.hits(spark, d)
    keys = ["period", "domain"]
    stored = behaviour.views_and_visitors(hits.where("wb = 1"), ["domain"])
    fresh = behaviour.views_and_visitors(hits.where("new = 1"), ["domain"]).drop("uv")
    return overlay(stored, fresh, keys)


# ---- whole result tables ---------------------------------------------------------------------


@register(
    "table_out_link",
    f"with a as ({o.family('link', 'wide')}), b as ({o.family('link_total', 'wide', area=True)}), "
    "k as (select period, level, domain, ref_root, ref from a) "
    "select a.*, " + ", ".join(
        f"b.{p}{v}{c}"
        for p in ("other_", "china_") for c in ("pv", "uv", "ip", "br", "avgtime") for v in ("", "ret", "new")
    ) + " from a left join b on a.period=b.period and a.domain=b.domain and a.level='total'",
)
def table_out_link(spark, d):
    return result_table("out_link", {k: s(spark, d) for k, s in fx.STREAMS.items()})


@register(
    "table_search_region",
    f"with p as ({o.family('engine_province', 'wide')}), c as ({o.family('engine_city', 'wide')}) "
    "select *, '' as city from p union all by name select * from c",
)
def table_search_region(spark, d):
    return result_table("search_region", {k: s(spark, d) for k, s in fx.STREAMS.items()})


def _whole_table(name: str, grain: str = "day") -> Query:
    def run(spark: SparkSession, d: str) -> DataFrame:
        return result_table(name, {k: s(spark, d, grain) for k, s in fx.STREAMS.items()}, grain == "hour")

    return run


def _levelled(name: str, sql: str) -> str:
    return f"select *, '{name}' as level from ({sql})"


def _host_table(grain: str) -> str:
    hits, dwell = f"from hits group by {_HOST}", f"from dwell group by {_HOST}"
    return (
        f"{o.base('hits dwell', grain)}, b as (select {_HOST}, count(*) as bc from ({o.singles('hits', _HOST)}) group by {_HOST}), "
        f"t as (select {_HOST}, count(ip) as pv, count(distinct wid) as uv {hits}), "
        f"w as (select {_HOST}, {o.clock('(sum(page_avg_time)//count(domain))')} as avg_time {dwell}) "
        f"select {_HOST}, 'respondomain' as level, pv, uv, case when pv is not null then {o.pct('coalesce(bc,0)', 'pv')} end as br, avg_time "
        f"from t full join w using ({_HOST}) left join b using ({_HOST})"
    )


for _name, _family, _loyal in (
    ("domain", "site", True), ("ads", "ad", True), ("region_distribute", "region", False), ("search_engines", "engine", False),
    ("search_word", "keyword", False), ("out_region", "link_region", False), ("direct_access", "direct", False),
    ("direct_region", "direct_region", False),
):
    _sql = o.family(_family, "wide", area=FAMILIES[_family].area, loyalty_too=True) if _loyal else o.family(
        _family, "wide", area=FAMILIES[_family].area
    )
    register(f"table_{_name}", _sql)(_whole_table(_name))
for _name, _source in (
    ("page", "traffic_page"), ("detail", "page_referrer_counts"), ("hotlink", "link_clicks"), ("hotmap", "click_positions"),
    ("heatmap", "click_marks"),
):
    register(f"table_{_name}", _levelled(_name, CATALOG[_source].sql))(_whole_table(_name))
register("table_respondomain", _host_table("day"))(_whole_table("respondomain"))
register("hourly_host", _host_table("hour"))(_whole_table("respondomain", "hour"))
register(
    "table_gjsx",
    _levelled(
        "gjsx",
        f"select * exclude (retbc, newbc) from ({CATALOG['visitor_channel_traffic'].sql}) full join ({CATALOG['visitor_channel_bounce'].sql}) "
        f"using (period, domain, channel) full join ({CATALOG['visitor_channel_dwell'].sql}) using (period, domain, channel)",
    ),
)(_whole_table("gjsx"))


# ---- sources and sinks, through files in the shared folder --------------------------------------


def _folder(spark: SparkSession, name: str) -> str:
    """A new path that all machines of the session see; the query reads it, so it stays until the folder is cleared."""
    return shared_folder(spark, f"{name}-{uuid.uuid4().hex}")


@register("clean_two_batches_hits", f"{_clean_base()} {_CLEAN_SELECTS['hits']}")
def clean_two_batches_hits(spark, d):
    """Lines of all days in two runs, so each run has stragglers of the other's day; both are kept."""
    root, half = _folder(spark, "batches"), F.pmod(F.xxhash64("value"), F.lit(2))
    for n, batch in enumerate(("20240115", "2024011607")):
        lines = fx.raw_lines(spark, d).where(half == n)
        write_streams(clean.route(clean.clean(lines, RULES, fx.sites(spark, d), fx.ip_ranges(spark, d)), with_rejects=True), root, batch)
    return readers.cleaned(spark, root, "hits").drop("day", "hour")


@register("clean_batch_rejects", CATALOG["clean_rejects"].sql)
def clean_batch_rejects(spark, d):
    root = _folder(spark, "batches")
    write_streams(clean.route(_cleaned(spark, d), with_rejects=True), root, "20240101")
    return readers.cleaned(spark, root, "rejects").groupBy("reason").agg(F.count(F.lit(1)).alias("line_count"))


@register("upsert_through_files", CATALOG["upsert_rows"].sql)
def upsert_through_files(spark, d):
    root, hits = _folder(spark, "upsert"), fx.hits(spark, d)
    level = F.lit("domain").alias("level")
    stored = behaviour.views_and_visitors(hits.where("wb = 1"), ["domain"]).select("*", level)
    fresh = behaviour.views_and_visitors(hits.where("new = 1"), ["domain"]).drop("uv").select("*", level)
    for cells in (stored, fresh):
        upsert_table(cells, root, "domain")
    return read_table(spark, root, "domain").select("period", "domain", "pv", "uv")


_TEXT_COLUMNS = "ip wid page ref domain respondomain enter new se wb kw"
_TEXT_SQL = f"{o.base('hits')} select {', '.join(_TEXT_COLUMNS.split())} from hits"


def _through_text(sep: str) -> Query:
    def run(spark: SparkSession, d: str) -> DataFrame:
        path = _folder(spark, "text")
        write_text(fx.hits(spark, d).select(*_TEXT_COLUMNS.split()), path, sep)
        return readers.delimited(spark, path, OLDER_STREAMS["hits_2014_site"], sep)

    return run


register("text_backtick_hits", _TEXT_SQL)(_through_text(readers.FIELD_MARK))
register("text_comma_hits", _TEXT_SQL)(_through_text(","))


@register("raw_log_kind_counts", CATALOG["clean_kind_counts"].sql)
def raw_log_kind_counts(spark, d):
    path = _folder(spark, "log")
    fx.raw_lines(spark, d).write.text(path)
    parsed = clean.clean(readers.raw_log(spark, path), RULES, fx.sites(spark, d), fx.ip_ranges(spark, d))
    return clean.route(parsed).groupBy("kind").agg(F.count(F.lit(1)).alias("records"))


@register("one_column_urls", "select url from pages where url is not null and not contains(url, chr(10)) and not contains(url, chr(13))")
def one_column_urls(spark, d):
    path = _folder(spark, "urls")
    fx.table(spark, d, "pages").select("url").where("url is not null and not url rlike '[\\r\\n]'").write.text(path)
    return readers.lines(spark, path)


@register("key_folders", "select event_type, count(*) as n, sum(event_id)::bigint as ids from events group by event_type")
def key_folders(spark, d):
    path = _folder(spark, "keys")
    write_by_key(fx.table(spark, d, "events").select("event_type", "event_id"), "event_type", path)
    rows = spark.read.schema("event_id long, event_type string").parquet(path)
    return rows.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("event_id").alias("ids"))


@register("address_dictionary_text", f"with {_RANGES} select begin_ip, end_ip, nullif(country, '') as country, nullif(range_area, '') as area from r")
def address_dictionary_text(spark, d):
    path, ranges = _folder(spark, "ranges"), fx.ip_ranges(spark, d)
    texts = ranges.select(sc.ip_text("begin_ip").alias("b"), sc.ip_text("end_ip").alias("e"), "country", "area")
    write_text(texts, path, ",")
    return readers.ip_ranges(spark, path)


@register("tracked_sites_config", "select distinct event_type as domain from events where event_type <> 'error'")
def tracked_sites_config(spark, d):
    path = _folder(spark, "config")
    write_text(fx.table(spark, d, "events").select("event_type").distinct(), path)
    return readers.tracked_sites(readers.delimited(spark, path, SITES), "error")


@register("missing_stream", f"{o.base('hits')} select period, count(*) as hits, 0::bigint as marks from hits group by period")
def missing_stream(spark, d):
    """Hits beside a stream that no run has written."""
    none = readers.cleaned(spark, _folder(spark, "none"), "click_marks").select(F.col("day").alias("period"), F.lit(1).alias("mark"))
    rows = fx.hits(spark, d).select("period", F.lit(None).cast("int").alias("mark")).unionByName(none)
    return rows.groupBy("period").agg(F.sum(F.when(F.col("mark").isNull(), 1).otherwise(0)).alias("hits"), F.count("mark").alias("marks"))


def _older_hits(layout: str, count: Query) -> Query:
    """Hits through a text file in an older layout, then a report of today's operators."""

    def run(spark: SparkSession, d: str) -> DataFrame:
        path = _folder(spark, "older")
        names = [c for c in OLDER_STREAMS[layout].names if c in fx.EXPRESSIONS]
        time, beacon = F.substring(F.col("ts").cast("string"), 1, 19).alias("vtime"), F.lit("/5a.gif").alias("path")
        events = fx.events(spark, d).where(f"not ({fx.IS_CLOSE})")
        rows = events.select(*[F.expr(fx.EXPRESSIONS[c]).alias(c) for c in names], time, beacon)
        if layout == "hits_2013_host":
            rows = rows.withColumn("new", F.coalesce(F.col("new").cast("string"), F.lit("-")))
        write_text(rows.select(*OLDER_STREAMS[layout].names), path)
        return count(with_period(readers.older_stream(spark, path, layout)))

    return run


register("older_host_traffic", CATALOG["traffic_host"].sql)(
    _older_hits("hits_2013_host", lambda hits: behaviour.views_and_visitors(hits, ["domain", "respondomain"]))
)
register("older_visitor_channels", CATALOG["visitor_channel_traffic"].sql)(
    _older_hits(
        "hits_2013_visitor",
        lambda hits: visitors.channel_visitors(hits).select("period", "domain", "channel", "retpv", "retuv", "newpv", "newuv"),
    )
)
register("older_region_traffic", CATALOG["traffic_province"].sql)(
    _older_hits(
        "hits_2014_region", lambda hits: visitor_cells(hits, FAMILIES["region"], ("traffic",)).where("level = 'province'")
    )
)


# Further queries register themselves in the same catalog.
from . import catalog_stored  # noqa: E402, F401
