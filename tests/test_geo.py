"""Range lookup against a linear search."""

import random

import pytest
from pyspark.sql import functions as F

from grainmill.operators import geo, sizing


def number(ip):
    a, b, c, d = map(int, ip.split("."))
    return ((a * 256 + b) * 256 + c) * 256 + d


def search(ranges, ip):
    at = number(ip)
    holding = [r for r in ranges if r[0] <= at <= r[1]]
    return holding[0][2:] if holding else ("未知国家", "未知地区")


@pytest.fixture(scope="module")
def case(spark):
    rng = random.Random(3)
    ranges, at = [], number("10.0.0.0")
    for i in range(60):
        at += rng.randrange(1, 9000)
        end = at + rng.randrange(0, 200_000 if i % 9 == 0 else 12_000)
        ranges.append((at, end, f"c{i}", f"a{i}"))
        at = end if i % 4 else end + 5000
    addresses = [f"10.{rng.randrange(6)}.{rng.randrange(256)}.{rng.randrange(256)}" for _ in range(1500)]
    addresses += ["10.0.0.0", "9.255.255.255", "255.255.255.255", "0.0.0.0"] + ["10.1.1.1"] * 700
    for low, high, _, _ in ranges[:20]:
        for n in (low - 1, low, high, high + 1):
            addresses.append(".".join(str(n >> s & 255) for s in (24, 16, 8, 0)))
    frame = spark.createDataFrame([(i, a) for i, a in enumerate(addresses)], "i int, ip string")
    table = spark.createDataFrame(ranges, "begin_ip long, end_ip long, country string, area string")
    want = {i: search(ranges, a) for i, a in enumerate(addresses)}
    return frame, table, want


def result(frame):
    rows = frame.collect()
    got = {r.i: (r.country, r.area) for r in rows}
    assert len(got) == len(rows)
    return got


def test_broadcast_lookup(case):
    frame, table, want = case
    assert result(geo.locate(frame, table)) == want


@pytest.mark.parametrize("hot_rows", [100, 4_000_000])
def test_window_lookup(case, hot_rows):
    frame, table, want = case
    assert result(geo.locate_by_window(frame, geo.range_pieces(table), hot_rows=hot_rows)) == want


def test_large_dictionary_is_not_broadcast(case, monkeypatch):
    frame, table, want = case
    monkeypatch.setattr(sizing, "BROADCAST_BYTES", 10)
    located = geo.locate(frame, table)
    assert "Window" in located._jdf.queryExecution().optimizedPlan().toString()
    assert result(located) == want


def test_invalid_addresses_keep_their_rows(spark, case):
    _, table, _ = case
    frame = spark.createDataFrame([(0, None), (1, "-"), (2, "300.1.1.1")], "i int, ip string")
    unknown = {i: ("未知国家", "未知地区") for i in range(3)}
    assert result(geo.locate(frame, table)) == unknown
    assert result(geo.locate_by_window(frame, geo.range_pieces(table))) == unknown


def test_bare_range_join_is_avoided(case):
    frame, table, _ = case
    plan = geo.locate(frame, table)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan
    assert "BroadcastNestedLoopJoin" not in plan and "CartesianProduct" not in plan


def test_overlapping_ranges_never_repeat_a_row(spark):
    rows = [(0, 70_000, "a", "x"), (10, 20, "b", "x"), (10, 15, "c", "x"), (15, 66_000, "d", "x")]
    table = spark.createDataFrame(rows, "begin_ip long, end_ip long, country string, area string")
    frame = spark.createDataFrame([(i, f"0.0.0.{i}") for i in range(256)], "i int, ip string")
    assert len(result(geo.locate(frame, table))) == 256


def test_find_ranges(spark):
    rows = [(0, 1, "广东省广州市", "电信"), (2, 3, "北京市", "广电"), (4, 5, "上海市", "联通")]
    table = spark.createDataFrame(rows, "begin_ip long, end_ip long, country string, area string")
    assert sorted(r.begin_ip for r in geo.find_ranges(table, "广").collect()) == [0, 2]


def test_dense_bucket_meets_few_pieces(spark):
    """65,536 ranges of one address each in one /16: no address meets more than 16 pieces."""
    ranges = spark.range(65536).selectExpr("id + 655360 as begin_ip", "id + 655360 as end_ip", "cast(id as string) as country", "'n' as area")
    pieces = geo.prefix_pieces(geo.range_pieces(ranges))
    assert pieces.groupBy("cut", "prefix").count().agg(F.max("count")).first()[0] == 16
    frame = spark.createDataFrame([(7, "0.10.1.2"), (8, "0.11.0.0")], "i int, ip string")
    assert result(geo.locate(frame, ranges)) == {7: ("258", "n"), 8: ("未知国家", "未知地区")}
    whole = geo.prefix_pieces(geo.range_pieces(ranges.limit(0).union(spark.createDataFrame([(65536 * 3, 65536 * 9 + 255, "c", "a")], ranges.schema))))
    assert sorted((r.cut, r["count"]) for r in whole.groupBy("cut").count().collect()) == [(8, 1), (16, 6)]
