"""Plain SQL for every query, written from the metric definitions with count(distinct)."""

from __future__ import annotations

from . import fixture as fx

DAY = "replace(cast(cast(ts as date) as string),'-','')"
HOUR = "replace(replace(substr(cast(ts as string),1,13),'-',''),' ','')"
PERIODS = {"day": DAY, "hour": HOUR, "all": "'all'"}

ROOT = (
    "case when regexp_matches({c},'^(www|m|3g|wap|search)[.]') then regexp_replace({c},'^(www|m|3g|wap|search)[.]','') "
    "when starts_with({c},'http://') then regexp_extract({c},'^(http://[^/]*)',1) else {c} end"
)

COLUMNS = {
    "hits": "ip wid page ref domain respondomain enter new se wb kw province city area seq",
    "dwell": "page ref domain page_avg_time respondomain enter new se wb kw province city area",
    "ad_hits": "ip wid domain new adsref adsnew adsid",
    "ad_dwell": "domain adsid new page_avg_time",
    "hot": "domain page x y u",
    "click_marks": "page click",
}
FILTERS = {
    "hits": f"not ({fx.IS_CLOSE})",
    "dwell": fx.IS_CLOSE,
    "ad_hits": f"not ({fx.IS_CLOSE}) and k%8=0",
    "ad_dwell": f"{fx.IS_CLOSE} and k%8=0",
    "hot": f"not ({fx.IS_CLOSE})",
    "click_marks": "event_type='click'",
}


def base(streams: str, grain: str = "day") -> str:
    """WITH clause: events plus the asked streams, each with its period and roots."""
    parts = [f"e as (select *, {fx.K} as k from events)"]
    for name in streams.split():
        columns = COLUMNS[name].split()
        picked = [f"{fx.EXPRESSIONS[c]} as {c}" for c in columns]
        roots = [
            f"{ROOT.format(c=c)} as {r}" for c, r in (("se", "se_root"), ("ref", "ref_root")) if c in columns
        ]
        inner = f"select {PERIODS[grain]} as period, ts, {', '.join(picked)} from e where {FILTERS[name]}"
        parts.append(f"{name} as (select *{''.join(', ' + r for r in roots)} from ({inner}))")
    return "with " + ", ".join(parts)


def bp(b: str, p: str) -> str:
    ratio = f"cast(cast({b} as float)/cast(nullif({p},0) as float) as float)"
    return f"cast(floor(cast({ratio}*cast(10000 as float) as double)+0.5) as bigint)"


def pct(b: str, p: str) -> str:
    ratio = f"cast(cast({b} as float)/cast(nullif({p},0) as float) as float)"
    return f"(cast({ratio}*cast(100 as float) as string) || '%')"


def clock(ms: str) -> str:
    r = f"cast(floor({ms}+0.5) as bigint)"
    two = "lpad(cast({} as string),2,'0')"
    h = two.format(f"({r}%86400000)//3600000")
    m = two.format(f"({r}%3600000)//60000")
    s = two.format(f"({r}%60000+500)//1000")
    return f"({h} || ':' || {m} || ':' || {s})"


SLICES = {"": "true", "ret": "new is null"}
AREA_SLICES = SLICES | {"other_": "area is null", "other_ret": "area is null and new is null"}


def _subtract(measures: str, area: bool) -> list[str]:
    out = []
    for m in measures.split():
        out += [m, f"ret{m}", f"{m}-ret{m} as new{m}"]
        if area:
            out += [
                f"other_{m}", f"other_ret{m}", f"other_{m}-other_ret{m} as other_new{m}",
                f"{m}-other_{m} as china_{m}", f"ret{m}-other_ret{m} as china_ret{m}",
                f"({m}-ret{m})-(other_{m}-other_ret{m}) as china_new{m}",
            ]
    return out


def traffic(src: str, keys: str, where: str = "true", area: bool = False) -> str:
    cells = []
    for name, cond in (AREA_SLICES if area else SLICES).items():
        cells += [
            f"count(case when {cond} then ip end) as {name}pv",
            f"count(distinct case when {cond} then wid end) as {name}uv",
            f"count(distinct case when {cond} then ip end) as {name}ip",
        ]
    inner = f"select {keys}, {', '.join(cells)} from {src} where {where} group by {keys}"
    return f"select {keys}, {', '.join(_subtract('pv uv ip', area))} from ({inner})"


def singles(src: str, keys: str, where: str = "true", area: bool = False) -> str:
    more = ", max(area) as area" if area else ""
    return (
        f"select {keys}, wid, max(new) as new{more} from {src} where {where} "
        f"group by {keys}, wid having count(*)=1"
    )


def bounce_counts(singles_sql: str, keys: str, area: bool = False) -> str:
    cells = [
        f"count(case when {cond} then 1 end) as {name}bc"
        for name, cond in (AREA_SLICES if area else SLICES).items()
    ]
    inner = f"select {keys}, {', '.join(cells)} from ({singles_sql}) group by {keys}"
    return f"select {keys}, {', '.join(_subtract('bc', area))} from ({inner})"


def bounce(traffic_sql: str, counts_sql: str, keys: str, area: bool = False, rate=bp) -> str:
    prefixes = ["", "other_", "china_"] if area else [""]
    names = [f"{p}{v}" for p in prefixes for v in ("", "ret", "new")]
    cells = [f"{n}bc" for n in names] + [f"{rate(n + 'bc', n + 'pv')} as {n}br" for n in names]
    return f"select {keys}, {', '.join(cells)} from ({traffic_sql}) join ({counts_sql}) using ({keys})"


def dwell(src: str, keys: str, where: str = "true", area: bool = False, form: str = "long") -> str:
    ret, new, oth, chn = "new is null", "new is not null", "area is null", "area is not null"
    slices = {"": "true", "ret": ret, "new": new}
    if area:
        for p, c in (("other_", oth), ("china_", chn)):
            slices |= {p: c, f"{p}ret": f"{c} and {ret}", f"{p}new": f"{c} and {new}"}
    cells = []
    for name, cond in slices.items():
        mean = f"avg(case when {cond} then page_avg_time end)"
        value = f"cast(trunc({mean}) as bigint)" if form == "long" else clock(mean)
        cells.append(f"{value} as {name}avgtime")
    return f"select {keys}, {', '.join(cells)} from {src} where {where} group by {keys}"


# family -> (hits, dwell, channel filter, levels finest first: name, keys, cascade, extra filter)
SE, WB, DIRECT = "se is not null", "wb=1", "ref='-'"
CITY = "city is not null"
REGION = [
    ("city", "domain, province, city", False, CITY),
    ("province", "domain, province", False, "true"),
]
FAMILIES = {
    "site": ("hits", "dwell", "true", [("site", "domain", False, "true")]),
    "ad": ("ad_hits", "ad_dwell", "true", [("ad", "domain, adsid", False, "true")]),
    "region": ("hits", "dwell", "true", REGION),
    "engine": ("hits", "dwell", SE, [
        ("sub", "domain, se_root, se", False, "true"),
        ("root", "domain, se_root", True, "true"),
        ("total", "domain", True, "true"),
    ]),
    "keyword": ("hits", "dwell", SE, [
        ("sub", "domain, se_root, se, kw", False, "true"),
        ("root", "domain, se_root, kw", True, "true"),
        ("total", "domain, kw", True, "true"),
    ]),
    "engine_province": ("hits", "dwell", SE, [
        ("sub_province", "domain, se_root, se, province", False, "true"),
        ("root_province", "domain, se_root, province", True, "true"),
        ("total_province", "domain, province", True, "true"),
    ]),
    "engine_city": ("hits", "dwell", f"{SE} and {CITY}", [
        ("sub_city", "domain, se_root, se, province, city", False, "true"),
        ("root_city", "domain, se_root, province, city", True, "true"),
        ("total_city", "domain, province, city", True, "true"),
    ]),
    "link": ("hits", "dwell", WB, [
        ("sub", "domain, ref_root, ref", False, "true"),
        ("root", "domain, ref_root", True, "true"),
        ("total", "domain", False, "true"),
    ]),
    "link_total": ("hits", "dwell", WB, [("total", "domain", False, "true")]),
    "link_region": ("hits", "dwell", WB, REGION),
    "direct": ("hits", "dwell", DIRECT, [("total", "domain", False, "true")]),
    "direct_region": ("hits", "dwell", DIRECT, REGION),
}


def family(
    name: str, what: str, grain: str = "day", area: bool = False, hourly: bool = False,
    only: str | None = None, channel: str | None = None, loyalty_too: bool = False,
) -> str:
    """One report of a family: all levels stacked. ``what``: traffic, bounce, dwell or wide."""
    hits, times, where, levels = FAMILIES[name]
    where = channel or where
    finest = levels[0][1].split(", ")
    rate = pct if hourly else bp
    form = "clock" if hourly else "long"
    selects, previous = [], ""
    for label, keys, cascade, extra in levels:
        pkeys = f"period, {keys}"
        cond = f"{where} and {extra}"
        if cascade:
            single = singles(f"({previous})", pkeys, area=area)
        else:
            single = singles(hits, pkeys, cond, area)
        previous = single
        t = traffic(hits, pkeys, cond, area)
        b = bounce(t, bounce_counts(single, pkeys, area), pkeys, area, rate)
        d = dwell(times, pkeys, cond, area, form)
        if what == "wide":
            prefixes = ["", "other_", "china_"] if area else [""]
            cells = [f"{p}{v}{m}" for p in prefixes for m in ("pv", "uv", "ip") for v in ("", "ret", "new")]
            cells += [f"{p}{v}{m}" for p in prefixes for m in ("br", "avgtime") for v in ("", "ret", "new")]
            sql = f"select * from ({t}) full join ({b}) using ({pkeys}) full join ({d}) using ({pkeys})"
            if loyalty_too:
                sql += f" full join ({loyalty(hits, keys, 'all')}) using ({pkeys})"
                cells += LOYALTY_COLUMNS
        else:
            sql = {"traffic": t, "bounce": b, "dwell": d}[what]
            cells = None
        labelled = [k if k in keys.split(", ") else f"'' as {k}" for k in finest]
        rest = ", ".join(cells) if cells else f"* exclude ({pkeys})"
        selects.append(f"select period, '{label}' as level, {', '.join(labelled)}, {rest} from ({sql})")
        if only and only != label:
            selects.pop()
    streams = " ".join(dict.fromkeys([hits, times] if what in ("wide", "dwell") else [hits]))
    return f"{base(streams, grain)} " + " union all ".join(selects)


BUCKETS = {
    "2": "n=2", "3": "n=3", "4": "n=4", "5_10": "n between 5 and 10",
    "11_20": "n between 11 and 20", "21_50": "n between 21 and 50", "50": "n>50",
}
LOYALTY_COLUMNS = [f"loty_{b}_{x}" for b in ("1", *BUCKETS) for x in ("count", "rate")]


def loyalty(src: str, keys: str, what: str, first: str = "ip", rate=bp, where: str = "true") -> str:
    keys = f"period, {keys}"
    visitors = f"select {keys}, wid, count({first}) as n, count(*) as rows_ from {src} where {where} group by {keys}, wid"
    counts = ["nullif(count(case when rows_=1 then 1 end),0) as loty_1_count", "count(wid) as uv"]
    counts += [f"count(case when {c} then 1 end) as loty_{b}_count" for b, c in BUCKETS.items()]
    inner = f"select {keys}, {', '.join(counts)} from ({visitors}) group by {keys}"
    rates = [f"{pct('loty_1_count', 'uv')} as loty_1_rate"]
    rates += [f"{rate(f'loty_{b}_count', 'uv')} as loty_{b}_rate" for b in BUCKETS]
    cells = [f"loty_{b}_count" for b in ("1", *BUCKETS)]
    chosen = {"count": cells, "rate": rates, "all": cells + rates}[what]
    return f"select {keys}, {', '.join(chosen)} from ({inner})"


def older_counts(src: str, keys: str, where: str = "true") -> str:
    return (
        f"select {keys}, count(wid) as pv, count(distinct wid) as uv from {src} where {where} group by {keys}"
    )
