"""Raw lines: what is kept, defaulted, decoded, rewritten and rejected."""

import random
import re

import pytest
from pyspark.sql import functions as F

from grainmill.operators import clean

SEP = "\x1a"
QUERY = "?wb=1&re=http%3A%2F%2Fr.com%2Fx%3Fid%3D1&id=xy&lnt=3261&u=http%3A%2F%2Fmy.x.com%2Fmy%2F10%2FP.php%3Fid%3D1&se=www.g.com&kw=job"


def line(path="/5a.gif", query=QUERY, status="200", cookies="wid=abc; newer=1; enter=0", ip="1.25.96.0", agent="UA"):
    return SEP.join([ip, "0", "2014-01-07 09:15:06", "GET", path, query, status, "0", "http://p", agent, cookies])


RULES = clean.Rules(["bot", r"bad/[0-9]+"], [(r"/my/[0-9]+/", "/my/")])


@pytest.fixture(scope="module")
def sites(spark):
    return spark.createDataFrame([("xy",), ("www",)], "domain string")


@pytest.fixture(scope="module")
def ranges(spark):
    rows = [(18_440_192, 18_505_727, "广东省广州市", "电信"), (0, 255, "局域网", " CZ88.NET")]
    return spark.createDataFrame(rows, "begin_ip long, end_ip long, country string, area string")


def cleaned(spark, sites, ranges, *lines):
    frame = spark.createDataFrame([(x,) for x in lines], "value string")
    return clean.clean(frame, RULES, sites, ranges)


def one(spark, sites, ranges, kind, text):
    rows = clean.stream(cleaned(spark, sites, ranges, text), kind).collect()
    return rows[0] if rows else None


def test_hit(spark, sites, ranges):
    r = one(spark, sites, ranges, "hits", line())
    assert (r.ip, r.wid, r.page, r.ref, r.domain, r.respondomain) == (
        "1.25.96.0", "abc", "http://my.x.com/my/P.php", "http://r.com/x", "xy", "my.x.com",
    )
    assert (r.enter, r.new, r.se, r.wb, r.kw, r.vtime) == ("0", 1, "www.g.com", 1, "job", "2014-01-07 09:15:06")
    assert (r.province, r.city, r.area) == ("广东", "广州市", "电信")


def test_defaults(spark, sites, ranges):
    r = one(spark, sites, ranges, "hits", line(query="?id=xy&u=a.com&re=&kw=", cookies="x=1"))
    assert (r.wid, r.ref, r.kw, r.wb, r.se, r.new, r.enter) == ("-", "-", "-", 0, None, None, None)
    assert one(spark, sites, ranges, "hits", line(query="?id=xy&u=a.com&wb=")).wb is None


def test_last_value_wins_and_cookies_match_by_content(spark, sites, ranges):
    r = one(spark, sites, ranges, "hits", line(query="?u=a.com&id=www&id=xy&xid=no", cookies="wid=1;wid=2=3;noname newer"))
    assert (r.domain, r.wid) == ("xy", "2=3")


def test_unknown_address(spark, sites, ranges):
    r = one(spark, sites, ranges, "hits", line(ip="200.1.1.1"))
    assert (r.province, r.city, r.area) == ("未知国家", None, "未知地区")
    r = one(spark, sites, ranges, "hits", line(ip="0.0.0.7"))
    assert (r.province, r.area) == ("局域网", None)


REJECTS = [
    (line(agent="a bot"), "blacklisted"),
    (line(agent="bad/77"), "blacklisted"),
    (line(cookies=""), "field_count"),
    ("", "field_count"),
    (line() + SEP + "more", "field_count"),
    (line(path="/51js.php"), "script_load"),
    (line(status="-"), "bad_status"),
    (line(status="404"), "http_error"),
    (line(query="?id=xy"), "no_page"),
    (line(query="?id=xy&u=%zz"), "bad_url"),
    (line(query="?id=xy&u=a.com&re=%zz"), "bad_url"),
    (line(path="/5g.gif", query="?id=xy&u=a.com&lnt="), "blank_dwell"),
    (line(path="/5c.gif", query="?click=&u=a.com"), "blank_click"),
    (line(query="?id=other&u=a.com"), "untracked_site"),
    (line(), None),
    (line(status=" 399 "), None),
    (line(query="?id=other&u=a.com&adsnum=7"), None),
    (line(query="?id=other&u=a.com&hot=[{x:1,y:2,t:b}]"), None),
    (line(query="?id=other&u=a.com&hot=nonsense"), "untracked_site"),
]


def test_rejects(spark, sites, ranges):
    lost = clean.rejects(cleaned(spark, sites, ranges, *[text for text, _ in REJECTS])).collect()
    assert {r.line: r.reason for r in lost} == {text: why for text, why in REJECTS if why}


def test_page_close(spark, sites, ranges):
    r = one(spark, sites, ranges, "dwell", line(path="/5g.gif"))
    assert (r.page_avg_time, r.domain, r.new) == (3261, "xy", 1)
    assert one(spark, sites, ranges, "hits", line(path="/5g.gif")) is None
    kept = one(spark, sites, ranges, "dwell", line(path="/5g.gif", query="?id=xy&u=a.com&lnt=x"))
    assert kept.page_avg_time is None


def test_click_mark(spark, sites, ranges):
    r = one(spark, sites, ranges, "click_marks", line(path="/5c.gif", query="?click=top&u=http%3A%2F%2Fa.com%2F%3Fq"))
    assert (r.page, r.click) == ("http://a.com/", "top")
    assert one(spark, sites, ranges, "click_marks", line(path="/5c.gif", query="?click=top")).page == "-"
    assert one(spark, sites, ranges, "hits", line(path="/5c.gif", query="?click=top&u=a.com")) is None


def test_ads_ignore_the_site_list(spark, sites, ranges):
    query = "?id=none&u=a.com&adsnum=77&adsnew=1&adsfrom=%2Fhttp%253A%252F%252Fad.com%252F%253Fx%2F"
    r = one(spark, sites, ranges, "ad_hits", line(query=query))
    assert (r.domain, r.adsid, r.adsnew, r.adsref) == ("none", "77", 1, "http://ad.com/")
    assert one(spark, sites, ranges, "ad_dwell", line(path="/5g.gif", query=query)).adsid == "77"


def test_one_line_feeds_several_streams(spark, sites, ranges):
    both = line(query=QUERY + "&adsnum=1&hot=[{x:1.50,y:2.0,t:a,u:http%3A%2F%2Fl%3Fq},{'x':'3.0','y':4,'t':'b','u':'z'}]")
    routed = clean.route(cleaned(spark, sites, ranges, both))
    assert sorted(r.kind for r in routed.collect()) == ["ad_hits", "hits", "hot", "hot"]
    points = [(r.x, r.y, r.u) for r in routed.where("kind = 'hot'").collect()]
    assert sorted(points) == [("1.5", "2", "http://l"), ("3.0", "4", None)]


JSON_TEXTS = {
    "[{x:272.5,y:615,t:b}]": [("272.5", "615", "b", None)],
    '[{"x":"1.0","y":2,"t":"a","u":"k,x:1"}]': [("1.0", "2", "a", "k,x:1")],
    "[{x:1.250,y:-3.00,t:null}]": [("1.25", "-3", None, None)],
    "[]": [],
    "nonsense": None,
    "[{x:1": None,
}


def test_lenient_json(spark):
    frame = spark.createDataFrame([(t,) for t in JSON_TEXTS], "h string")
    rows = frame.select("h", clean.parse_hot("h").alias("p")).collect()
    assert {r.h: r.p if r.p is None else [tuple(x) for x in r.p] for r in rows} == JSON_TEXTS


def test_unreadable_link_drops_the_points(spark, sites, ranges):
    bad = line(query=QUERY + "&hot=[{x:1,y:2,t:a,u:%zz}]")
    assert one(spark, sites, ranges, "hot", bad) is None
    assert one(spark, sites, ranges, "hits", bad) is not None


def test_cleaning_moves_no_rows(spark, sites, ranges):
    frame = spark.createDataFrame([(line(),)], "value string").select(F.col("value"))
    routed = clean.route(clean.clean(frame, RULES, sites, ranges))
    plan = routed._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan


def test_each_filter_rule_is_on_its_own(spark):
    frame = spark.createDataFrame([("GoodBot",), ("spamX",), ("bot7",), ("abab",)], "value string")
    hit = lambda *rules: {r.value for r in frame.where(clean.blacklisted("value", list(rules))).collect()}
    assert hit("(?i)SPAM.", "bot[0-9]*") == {"spamX", "bot7"}
    assert hit("(x)(y)", r"(ab)\1") == {"abab"}


def test_large_site_lists_are_salted(spark):
    lines = spark.createDataFrame([("l1", "a"), ("l2", "b"), ("l3", None), ("l4", "a")], "line string, domain string")
    sites = spark.createDataFrame([("a",), ("c",)], "domain string")
    for limit in (None, 0):
        got = {r.line: r.tracked for r in clean.mark_tracked(lines, sites, limit).collect()}
        assert got == {"l1": True, "l2": False, "l3": False, "l4": True}


HOT = {
    '[{x:272.5,y:615,t:b}]': [("272.5", "615", "b", None)],
    "[{x:1,y:2,t:a,u:http://a}]": None,
    """[{'x':1,"y":'2',t:a,u:"a:b,c"}]""": [("1", "2", "a", "a:b,c")],
    "[{x:1,y:2": None,
    "[{x:1;y=2;t=>b},]junk": [("1", "2", "b", None)],
    '[{x:12.50,y:"12.50",t:b}]': [("12.5", "12.50", "b", None)],
    """[{x:1,y:2,t:a,u:'it said "hi"'}]""": [("1", "2", "a", 'it said "hi"')],
    "[{x:null,y:5,y:6}]": None,
    "[{x:1,y:5,y:6}]": None,
    "[]": [],
    "[{}]": [(None, None, None, None)],
    "{x:1}": None,
    "[{x:1,y:2,t:a,u:http%3A%2F%2Fa.b},{x:3,y:4.00,t:b}]": [("1", "2", "a", "http%3A%2F%2Fa.b"), ("3", "4", "b", None)],
    "[ { x : 5 , y : two words , t : null } ]": [("5", "two words", None, None)],
    r'[{x:1,y:"a\"b\u0041"}]': [("1", 'a"bA', None, None)],
    "": None,
    "[{x:1,,}]": None,
    "[{x:{a:1}}]": None,
    "[{x:TRUE,y:007,t:00.50}]": [("true", "007", "0.5", None)],
    "[{u:it's}]": [(None, None, None, "it's")],
    "[{x:1}{x:2}]": None,
}


def test_click_texts_of_many_shapes(spark):
    frame = spark.createDataFrame([(t,) for t in HOT], "t string")
    read = frame.select("t", clean.parse_hot("t").alias("p"), clean._tokens_hot(F.col("t")).alias("q")).collect()
    shown = lambda points: None if points is None else [tuple(p) for p in points]
    assert {r.t: shown(r.p) for r in read} == HOT == {r.t: shown(r.q) for r in read}


def test_literal_of_a_rule():
    cases = {r"crawler/[0-9]+\.0": "crawler/", "abc?def": "def", "(x|y)longer": "longer", "a|b": None, "(?i)foo": None, r"ab\.cd+ef": "ab.cd", "[^]x]yyy+z": "yyy", "foo(?:bar)baz.*": "foo", r"\d+abc\b": "abc", "ab": None, "(open": None, r"\Qabc\E": None, "abc{0,2}defg": "defg"}
    assert {p: clean.required_literal(p) for p in cases} == cases


def test_many_rules_equal_the_chain(spark):
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcde") for _ in range(rng.randrange(3, 6)))
    rules = [rng.choice([word, lambda: f"{word()}/[0-9]+", lambda: f"(?:x|y){word()}?{word()}", lambda: f"(?i){word()}{word()}", lambda: rf"({word()})-\\1", lambda: f"{word()}.{word()}$"])() for _ in range(400)]
    lines = ["".join(rng.choice("aabbccddeexy/-3") for _ in range(rng.randrange(0, 30))) for _ in range(400)] + [None]
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(lines)], "i int, t string")
    got = {r.i for r in frame.where(clean.blacklisted("t", rules)).collect()}
    want = {i for i, t in enumerate(lines) if t is not None and any(re.search(p, t) for p in rules)}
    assert 50 < len(want) < 400 and got == want
    rewrites = [(f"{word()}{n}", f"<{n}>") for n in range(40)]
    urls = [f"http://a/{rng.choice(rewrites)[0]}/{rng.choice(rewrites)[0]}" for _ in range(40)] + ["http://none"]
    both = spark.createDataFrame([(u,) for u in urls], "u string").select(clean.canonical_url("u", rewrites).alias("a"), clean.rewritten("u", rewrites).alias("b")).collect()
    assert all(r.a == r.b for r in both)


def test_many_rules_share_their_beginnings(spark):
    rules = [rf"wid={3 * n}[;]" for n in range(2000)]
    whole = clean.any_pattern([clean.leading_text(r) for r in rules])
    assert whole.count("wid") == 1 and str(clean.blacklisted("t", rules)._jc).count("wid") == 1
    others = [r"[0-9]+/late\.x", r"[a-c]+/late\.y$", r"\p{Alpha}{2}#", r"\x41bc9", r"wid=7+!", r"wid=7+\?", "wid=71", r"wid=71[;]0", r"wid=71\b"]
    lines = ["a; wid=3; b", "wid=4;", "wid=5997;", "wid=5998; wid=0;", "wid=300", "12/late.x", "x/late.x", "q ab/late.y", "ab/late.y q", "qr#", "1#", "Abc9", "41bc9", "wid=777!", "wid=77", "wid=7?", "wid=712", ""]
    frame = spark.createDataFrame([(t,) for t in lines], "t string")
    got = {r.t for r in frame.where(clean.blacklisted("t", rules + others)).collect()}
    known = [r.replace(r"\p{Alpha}", "[A-Za-z]") for r in rules + others]
    assert got == {t for t in lines if any(re.search(r, t) for r in known)} and len(got) == 10
    cases = {r"wid=3[;]": ("wid=3", "[;]"), "abc?d": ("ab", "c?d"), r"a\.b\d": ("a.b", r"\d"), r"ab\.+": ("ab", r"\.+"), "^a": ("", "^a"), "ab": ("ab", ""), r"ab\x41": ("ab", r"\x41")}
    assert {p: clean.leading_text(p) for p in cases} == cases
