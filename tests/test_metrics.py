"""Metric semantics on hand-made rows and against brute force."""

import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from grainmill.operators import behaviour, members as m, merge, visitors
from grainmill.plans.grains import FAMILIES, dwell_cells, visitor_cells

HITS = "period string, ip string, wid string, domain string, new int, se string, kw string, ref string, wb int, province string, city string, area string"


def hit(wid, domain="s", new=None, se=None, ip="1.1.1.1", kw="-", ref="-", wb=0, province="p", city=None, area=None):
    return ("d", ip, wid, domain, new, se, kw, ref, wb, province, city, area)


def rows_by(frame, *keys):
    return {tuple(r[k] for k in keys): r.asDict() for r in frame.collect()}


def hits_frame(spark, rows):
    return spark.createDataFrame(rows, HITS)


def test_cascade_keeps_a_visitor_with_one_surviving_singleton(spark):
    rows = [hit("A", se="www.baidu.com")] + [hit("A", se="m.baidu.com")] * 5
    got = rows_by(visitor_cells(hits_frame(spark, rows), FAMILIES["engine"], ("bounce",)), "level", "se")
    assert got["sub", "www.baidu.com"]["bc"] == 1
    assert got["sub", "m.baidu.com"]["bc"] == 0
    assert got["root", ""]["bc"] == 1 and got["total", ""]["bc"] == 1


def test_cascade_drops_a_visitor_with_two_singletons(spark):
    rows = [hit("B", se="www.baidu.com"), hit("B", se="m.baidu.com")]
    got = rows_by(visitor_cells(hits_frame(spark, rows), FAMILIES["engine"], ("bounce",)), "level", "se")
    assert got["sub", "www.baidu.com"]["bc"] == got["sub", "m.baidu.com"]["bc"] == 1
    assert got["root", ""]["bc"] == 0 and got["total", ""]["bc"] == 0


def test_link_total_restarts_from_the_hits(spark):
    rows = [hit("A", ref="http://x.com/1", wb=1)] + [hit("A", ref="http://x.com/2", wb=1)] * 2
    got = rows_by(visitor_cells(hits_frame(spark, rows), FAMILIES["link"], ("bounce",)), "level", "ref")
    assert got["root", ""]["bc"] == 1
    assert got["total", ""]["bc"] == 0


def test_new_visitors_are_a_subtraction(spark):
    rows = [hit("C", new=1), hit("C"), hit("D", new=1)]
    got = visitor_cells(hits_frame(spark, rows), FAMILIES["site"], ("traffic",)).first()
    assert (got.uv, got.retuv, got.newuv) == (2, 1, 1)
    assert (got.pv, got.retpv, got.newpv) == (3, 1, 2)


def test_rate_is_null_without_a_base_and_without_bounces(spark):
    only_returning = visitor_cells(hits_frame(spark, [hit("A"), hit("B"), hit("B")]), FAMILIES["site"], ("bounce",)).first()
    assert (only_returning.br, only_returning.retbr, only_returning.newbr) == (3333, 3333, None)
    nobody = visitor_cells(hits_frame(spark, [hit("B"), hit("B")]), FAMILIES["site"], ("bounce",)).first()
    assert (nobody.br, nobody.retbr, nobody.newbr) == (None, None, None)


def test_null_first_column_is_no_view_but_counts_for_the_singleton_test(spark):
    rows = [hit("A", ip=None), hit("B"), hit("B", ip=None)]
    got = visitor_cells(hits_frame(spark, rows), FAMILIES["site"], ("traffic", "bounce")).first()
    assert (got.pv, got.uv, got.ip, got.bc) == (1, 2, 1, 1)


def test_city_level_skips_null_cities_and_province_keeps_them(spark):
    rows = [hit("A", city="c"), hit("A"), hit("B")]
    got = rows_by(visitor_cells(hits_frame(spark, rows), FAMILIES["region"], ("traffic", "bounce")), "level", "city")
    assert set(got) == {("city", "c"), ("province", "")}
    assert (got["city", "c"]["bc"], got["province", ""]["bc"]) == (1, 1)


def test_area_split(spark):
    rows = [hit("A", area=None), hit("A", area="x"), hit("B", area="x", new=1), hit("C", area=None, new=1)]
    rows = [r[:5] + ("www.a.com",) + r[6:] for r in rows]
    cells = visitor_cells(hits_frame(spark, rows), FAMILIES["engine"], ("traffic", "bounce"))
    got = rows_by(cells, "level")[("total",)]
    assert (got["uv"], got["other_uv"], got["china_uv"]) == (3, 2, 1)
    assert (got["pv"], got["other_pv"], got["china_pv"], got["other_newpv"], got["china_newpv"]) == (4, 2, 2, 1, 1)
    assert (got["bc"], got["other_bc"], got["china_bc"], got["china_newbc"]) == (2, 1, 1, 1)


def test_golden_click_marks(spark):
    """The one captured result: five clicks on one mark."""
    rows = [("20131224", "http://bbs.example.com", "copyright")] * 5
    got = behaviour.click_marks(spark.createDataFrame(rows, "period string, page string, click string")).collect()
    assert [tuple(r) for r in got] == [("20131224", "http://bbs.example.com", "copyright", 5)]


def test_exit_page_breaks_ties(spark):
    rows = [("d", "s", "A", "p1", "10:00", 1), ("d", "s", "A", "p2", "11:00", 2), ("d", "s", "A", "p3", "11:00", 3)]
    frame = spark.createDataFrame(rows, "period string, domain string, wid string, page string, vtime string, seq int")
    assert behaviour.exit_pages(frame, ["domain", "wid"]).first().page == "p3"


DWELL = "period string, domain string, ref string, new int, area string, page_avg_time long, province string, city string"


def test_dwell_truncates_and_leaves_empty_slices_null(spark):
    rows = [("d", "s", "-", None, None, 1, "p", None), ("d", "s", "-", None, "x", 2, "p", None), ("d", "s", "-", None, "x", None, "p", None)]
    got = dwell_cells(spark.createDataFrame(rows, DWELL), FAMILIES["site"], area=True).first()
    assert (got.avgtime, got.retavgtime, got.newavgtime) == (1, 1, None)
    assert (got.other_avgtime, got.china_avgtime, got.china_newavgtime) == (1, 2, None)


def test_dwell_levels_tell_null_data_from_rolled_up(spark):
    rows = [("d", "s", "-", None, None, 10, None, "c"), ("d", "s", "-", None, None, 30, "p", None)]
    got = dwell_cells(spark.createDataFrame(rows, DWELL), FAMILIES["region"])
    assert sorted((r.level, str(r.province), r.city, r.avgtime) for r in got.collect()) == [
        ("city", "None", "c", 10), ("province", "None", "", 10), ("province", "p", "", 30),
    ]


def test_overlay_replaces_only_cells_it_has(spark):
    stored = spark.createDataFrame([("a", 1, 2), ("b", 3, 4), (None, 7, 7)], "k string, x int, y int")
    fresh = spark.createDataFrame([("a", 9), ("c", 5), (None, 8)], "k string, x int")
    got = {r.k: (r.x, r.y) for r in merge.overlay(stored, fresh, ["k"]).collect()}
    assert got == {"a": (9, 2), "b": (3, 4), "c": (5, None), None: (8, 7)}


def test_zero_filled(spark):
    left = spark.createDataFrame([("a", 1), ("b", 2)], "k string, x int")
    right = spark.createDataFrame([("a", 5)], "k string, y int")
    assert {r.k: r.y for r in merge.zero_filled(left, right, ["k"]).collect()} == {"a": 5, "b": 0}


# ---- brute force on skewed random hits -------------------------------------------------------


@pytest.fixture(scope="module")
def random_rows():
    rng = random.Random(7)
    rows = []
    for _ in range(3000):
        wid = "-" if rng.random() < 0.35 else f"v{rng.randrange(900)}"
        rows.append(
            hit(
                wid, domain="big" if rng.random() < 0.6 else f"s{rng.randrange(4)}",
                new=rng.choice([None, 1]), se=rng.choice([None, "www.a.com", "m.a.com", "www.b.com", "c.com"]),
                ip=rng.choice([None, "1.1.1.1"]) if rng.random() < 0.2 else f"9.9.9.{rng.randrange(200)}",
                kw=f"k{rng.randrange(3)}", ref=rng.choice(["-", "http://x.com/1", "http://x.com/2", "http://y.com/z"]),
                wb=rng.randrange(2), province=f"p{rng.randrange(3)}", city=rng.choice([None, "c1", "c2"]),
                area=rng.choice([None, "isp"]),
            )
        )
    return rows


NAMES = [c.split()[0] for c in HITS.split(", ")]


def brute(rows, levels):
    """(level, key) -> pv, uv, ip, retuv, bounces, for levels of (name, key function, cascade)."""
    rows = [dict(zip(NAMES, r)) for r in rows]
    out, survivors = {}, None
    for name, key, cascade in levels:
        groups, per_visitor = defaultdict(list), Counter()
        for r in rows:
            groups[key(r)].append(r)
            per_visitor[key(r), r["wid"]] += 1
        if cascade:
            count = Counter((key(r), r["wid"]) for r in survivors)
            survivors = [r for r in survivors if count[key(r), r["wid"]] == 1]
        else:
            survivors = [r for r in rows if per_visitor[key(r), r["wid"]] == 1]
        bounced = Counter(key(r) for r in survivors)
        for k, g in groups.items():
            out[name, k] = (
                sum(r["ip"] is not None for r in g),
                len({r["wid"] for r in g}),
                len({r["ip"] for r in g} - {None}),
                len({r["wid"] for r in g if r["new"] is None}),
                bounced[k],
            )
    return out


def root(host):
    for p in ("www.", "m."):
        if host.startswith(p):
            return host[len(p):]
    return "/".join(host.split("/")[:3]) if host.startswith("http://") else host


def measured(frame, keys):
    out = {}
    for r in frame.collect():
        out[r.level, tuple(r[k] for k in keys)] = (r.pv, r.uv, r.ip, r.retuv, r.bc)
    return out


def test_engine_family_against_brute_force(spark, random_rows):
    rows = [r for r in random_rows if r[5] is not None]
    want = brute(rows, [
        ("sub", lambda r: (r["domain"], root(r["se"]), r["se"]), False),
        ("root", lambda r: (r["domain"], root(r["se"]), ""), True),
        ("total", lambda r: (r["domain"], "", ""), True),
    ])
    got = visitor_cells(hits_frame(spark, random_rows), FAMILIES["engine"], ("traffic", "bounce"))
    assert measured(got, ["domain", "se_root", "se"]) == want


def test_link_family_against_brute_force(spark, random_rows):
    rows = [r for r in random_rows if r[8] == 1]
    want = brute(rows, [
        ("sub", lambda r: (r["domain"], root(r["ref"]), r["ref"]), False),
        ("root", lambda r: (r["domain"], root(r["ref"]), ""), True),
        ("total", lambda r: (r["domain"], "", ""), False),
    ])
    got = visitor_cells(hits_frame(spark, random_rows), FAMILIES["link"], ("traffic", "bounce"))
    assert measured(got, ["domain", "ref_root", "ref"]) == want


def test_site_properties(spark, random_rows):
    cells = visitor_cells(hits_frame(spark, random_rows), FAMILIES["site"], ("traffic", "bounce", "loyalty"))
    for r in cells.collect():
        assert r.newuv + r.retuv == r.uv and r.newip + r.retip == r.ip
        assert r.bc <= r.uv
        rows = [x for x in random_rows if x[3] == r.domain]
        views = Counter(x[2] for x in rows if x[1] is not None)
        for name, low, high in m.LOYALTY[1:]:
            inside = sum(low <= n and (high is None or n <= high) for n in views.values())
            assert r[f"loty_{name}_count"] == inside


def test_cascade_never_exceeds_the_finer_level(spark, random_rows):
    cells = visitor_cells(hits_frame(spark, random_rows), FAMILIES["keyword"], ("bounce",)).collect()
    finer = Counter()
    for r in cells:
        if r.level == "sub":
            finer[r.domain, r.kw] += r.bc
    assert all(r.bc <= finer[r.domain, r.kw] for r in cells if r.level == "total")


def test_visitor_channel_against_brute_force(spark, random_rows):
    rows = [dict(zip(NAMES, r)) for r in random_rows]
    sizes = Counter((r["domain"], r["wid"]) for r in rows)
    got = rows_by(visitors.channel_visitors(hits_frame(spark, random_rows)), "domain", "channel")
    for (domain, channel), cells in got.items():
        here = [r for r in rows if r["domain"] == domain and (r["wb"] == 1 if channel == "wb" else r["ref"] == "-")]
        for kind, is_kind in (("ret", lambda r: r["new"] is None), ("new", lambda r: r["new"] is not None)):
            mine = [r for r in here if is_kind(r)]
            assert cells[f"{kind}pv"] == len(mine)
            assert cells[f"{kind}uv"] == len({r["wid"] for r in mine})
            assert cells[f"{kind}bc"] == sum(sizes[domain, r["wid"]] == 1 for r in mine)


def test_new_by_left_join_equals_subtraction(spark, random_rows):
    frame = hits_frame(spark, random_rows)
    joined = {r.domain: (r.newpv, r.newuv) for r in visitors.new_by_left_join(frame, ["domain"]).collect()}
    cells = visitor_cells(frame.withColumn("ip", F.col("wid")), FAMILIES["site"], ("traffic",))
    assert joined == {r.domain: (r.newpv, r.newuv) for r in cells.collect()}
