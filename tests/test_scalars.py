import datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from grainmill.functions import location, scalars as sc


def values(spark, rows, schema, expression):
    frame = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, " + schema)
    return [r[0] for r in frame.orderBy("i").select(expression).collect()]


def test_duration_rounds_seconds_and_wraps_hours(spark):
    rows = [(59_999.0,), (25 * 3_600_000.0,), (641_041.0,), (38_707.0,), (None,), (1499.5,)]
    got = values(spark, rows, "ms double", sc.duration_text("ms"))
    assert got == ["00:00:60", "01:00:00", "00:10:41", "00:00:39", None, "00:00:02"]


def test_duration_of_text(spark):
    assert values(spark, [("1500",), ("x",)], "ms string", sc.duration_text("ms")) == ["00:00:02", None]


def test_basis_points_follow_32_bit_arithmetic(spark):
    pairs = [(b, p) for p in range(1, 90) for b in range(0, p + 1)]
    got = values(spark, pairs, "b long, p long", sc.basis_points("b", "p"))
    want = []
    for b, p in pairs:
        ratio = np.float32(np.float32(b) / np.float32(p))
        want.append(int(np.floor(float(np.float32(ratio * np.float32(10000))) + 0.5)))
    assert got == want


def test_ratios_with_zero_denominator_are_null(spark):
    rows = [(1, 0), (None, 3), (1, 8)]
    assert values(spark, rows, "b long, p long", sc.basis_points("b", "p")) == [None, None, 1250]
    assert values(spark, rows, "b long, p long", sc.percent_text("b", "p")) == [None, None, "12.5%"]
    assert values(spark, rows, "b long, p long", sc.whole_quotient("p", "b")) == [0, None, 8]


def test_row_keys(spark):
    rows = [("20140101", "a", None)]
    got = values(spark, rows, "p string, d string, c string", sc.row_key("p", "d", "c"))
    assert got == ["20140101\x1aa\x1a"]
    assert values(spark, rows, "p string, d string, c string", sc.row_key("p")) == [None]
    key = sc.row_key_descending("p", F.lit(3), "d")
    assert values(spark, rows, "p string, d string, c string", key) == [
        "20140101\x1a" + format((1 << 64) - 3, "b") + "\x1aa"
    ]
    assert values(spark, [("a\x1ab\x1ac",)], "k string", sc.key_head("k")) == ["a\x1ab"]
    with pytest.raises(ValueError):
        sc.row_key_descending("p", F.lit(3))


def test_descending_key_sorts_large_counts_first(spark):
    rows = [(1,), (300,), (7,), (65_536,)]
    texts = values(spark, rows, "n long", sc.descending("n"))
    assert sorted(range(4), key=lambda i: texts[i]) == [3, 1, 2, 0]


def test_roots(spark):
    rows = [
        ("www.baidu.com",), ("m.baidu.com",), ("3g.sogou.com",), ("wap.x.com",), ("search.x.com",),
        ("http://a.com/x/y",), ("http://a.com",), ("https://a.com/x",), ("news.x.com",), ("www.m.x.com",), (None,),
    ]
    assert values(spark, rows, "s string", sc.root_of("s")) == [
        "baidu.com", "baidu.com", "sogou.com", "x.com", "x.com",
        "http://a.com", "http://a.com", "https://a.com/x", "news.x.com", "m.x.com", None,
    ]


def test_hosts_and_decoding(spark):
    rows = [("http://trace.x.com/t.php?id=1",), ("https://x/",), ("x.com/a",), ("",), (None,)]
    assert values(spark, rows, "s string", sc.host_of("s")) == ["trace.x.com", "x", "x.com", "-", "-"]
    rows = [("http%3A%2F%2Fa%2Fb+c",), ("plain",), ("%zz",), ("%E6%90%9C",), (None,)]
    assert values(spark, rows, "s string", sc.url_decoded("s")) == ["http://a/b c", "plain", None, "搜", None]


def test_rewrite_takes_the_first_rule(spark):
    rules = [(r"/my/[0-9]+/", "/my/"), (r"/my/", "/other/")]
    rows = [("http://x/my/12/p",), ("http://x/my/p",), ("http://x/q",)]
    assert values(spark, rows, "u string", sc.rewritten("u", rules)) == [
        "http://x/my/p", "http://x/other/p", "http://x/q",
    ]


def test_last_piece(spark):
    rows = [("a=1; wid=2; x=3; widget=4; b",), ("none",), ("wid",), (";wid=9;",)]
    assert values(spark, rows, "c string", sc.last_piece("c", ";", "wid")) == [" widget=4", "", "wid", "wid=9"]
    assert values(spark, rows, "c string", sc.after_equals(sc.last_piece("c", ";", "wid"))) == ["4", "", "wid", "9"]


def test_whole_number(spark):
    rows = [("12",), ("-",), ("",), (" 7 ",), ("+3",), ("1.5",), ("99999999999",), (None,)]
    assert values(spark, rows, "s string", sc.whole_number("s")) == [12, None, None, 7, 3, None, None, None]


def test_ip_numbers(spark):
    rows = [("1.2.3.4",), ("255.255.255.255",), ("256.1.1.1",), ("1.2.3",), ("-",), (None,)]
    got = values(spark, rows, "ip string", sc.ip_number("ip"))
    assert got == [16909060, 4294967295, None, None, None, None]
    assert values(spark, [(16909060,)], "n long", sc.ip_text("n")) == ["1.2.3.4"]


def test_times(spark):
    rows = [("2013-11-29 11:04:34",), ("bad",)]
    assert values(spark, rows, "s string", sc.to_time("s")) == [datetime.datetime(2013, 11, 29, 11, 4, 34), None]
    assert values(spark, [("2014-04-15 10:53",)], "s string", sc.minute_to_millis("s")) == [1397559180000]
    micros = 1_385_723_074_123_456
    time = sc.micros_to_time("u")
    assert values(spark, [(micros,)], "u long", sc.time_to_micros(time)) == [micros]
    assert values(spark, [(micros,)], "u long", sc.time_text(time)) == ["2013-11-29 11:04:34"]


def test_array_helpers(spark):
    rows = [([None, ""],), (["a"],), ([],), (["x\x1ay\x1az", "b"],)]
    assert values(spark, rows, "a array<string>", sc.array_blank("a")) == [True, False, True, False]
    assert values(spark, rows, "a array<string>", sc.size_is("a", 2)) == [True, False, False, True]
    assert values(spark, rows, "a array<string>", sc.size_between("a", 1, 1)) == [False, True, False, False]
    assert values(spark, rows, "a array<string>", sc.first_text("a")) == [None, "a", None, "x\x1ay\x1az"]
    assert values(spark, rows[3:], "a array<string>", sc.first_key_head("a")) == ["x\x1ay"]
    assert values(spark, [({},), ({"k": "v"},)], "m map<string,string>", sc.map_empty("m")) == [True, False]


def test_decoded_bytes(spark):
    text = "广东省广州市"
    assert values(spark, [(bytearray(text, "utf-8"),)], "b binary", sc.decoded_bytes("b")) == [text]
    spark.conf.set("spark.sql.legacy.javaCharsets", "true")
    try:
        assert values(spark, [(bytearray(text, "gbk"),)], "b binary", sc.decoded_bytes("b", "GBK")) == [text]
    finally:
        spark.conf.unset("spark.sql.legacy.javaCharsets")


# country text -> province, city, district
PLACES = {
    "北京市海淀区": ("北京", "海淀区", None),
    "上海市": ("上海", None, None),
    "广东省广州市天河区": ("广东", "广州市", "天河区"),
    "湖北省恩施州利川市": ("湖北", "利川市", None),
    "云南省大理州": ("云南", "大理州", None),
    "四川省": ("四川", None, None),
    "西藏拉萨市": ("西藏", "拉萨市", None),
    "香港": ("香港", None, None),
    "内蒙古包头市": ("内蒙古", "包头市", None),
    "美国": ("美国", None, None),
    "": ("未知", None, None),
}


def test_locations(spark):
    rows = [(c,) for c in PLACES]
    assert values(spark, rows, "c string", location.province_of("c")) == [v[0] for v in PLACES.values()]
    assert values(spark, rows, "c string", location.city_of("c")) == [v[1] for v in PLACES.values()]
    assert values(spark, rows, "c string", location.district_of("c")) == [v[2] for v in PLACES.values()]
    areas = [("电信",), (" CZ88.NET",), ("",), (None,)]
    assert values(spark, areas, "a string", location.area_of("a")) == ["电信", None, None, None]
