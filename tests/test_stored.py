"""Versions, gathered writes, ordered files, log ranges, stored counters, sketches, hierarchies of one home."""

import os
import random
import re

import pytest
from pyspark.sql import functions as F
from test_metrics import hit, hits_frame

from grainmill.operators import geo, sketches
from grainmill.plans import state
from grainmill.plans.grains import FAMILIES, visitor_cells, wide_cells
from grainmill.sources import readers, versions, writers

DWELL = "period string, domain string, page_avg_time long, new int, se string, wb int, kw string, ref string, province string, city string, area string"
ADS = "period string, ip string, wid string, domain string, new int, adsid string"
AD_DWELL = "period string, domain string, adsid string, new int, page_avg_time long"
PAGE = "period string, level string, domain string, page string, pv long, uv long"


def rows_of(frame):
    names = sorted(frame.columns)
    return sorted(str([r[c] for c in names]) for r in frame.collect())


def failing(spark, n=3):
    rows = spark.range(n).selectExpr("'20240101' as period", "'page' as level", "'s' as domain", "cast(id as string) as page", "id as pv", "id as uv")
    return rows.withColumn("uv", F.when(F.col("pv") == n - 1, F.raise_error(F.lit("broken"))).otherwise(F.col("uv")).cast("long"))


def test_a_failed_write_keeps_the_stored_period(spark, tmp_path):
    root = str(tmp_path)
    good = spark.createDataFrame([("20240101", "page", "s", "old", 1, 1)], PAGE)
    writers.replace_period(good, root, "page", "20240101")
    with pytest.raises(Exception, match="broken"):
        writers.replace_period(failing(spark), root, "page", "20240101")
    with pytest.raises(Exception, match="broken"):
        writers.upsert_table(failing(spark), root, "page")
    assert rows_of(writers.read_table(spark, root, "page", "20240101")) == rows_of(good)
    assert len([n for n in os.listdir(f"{root}/page") if n.startswith("version=")]) == 1
    writers.replace_period(good.limit(0), root, "page", "20240101")
    assert writers.read_table(spark, root, "page").count() == 0


def test_old_versions_go_and_a_taken_number_is_not_overwritten(spark, tmp_path):
    root = str(tmp_path)
    for n in range(5):
        with versions.replacing(spark, root, [f"part={n % 2}"]) as folder:
            spark.range(n + 1).write.parquet(f"{folder}/part={n % 2}")
    kept = versions.current(spark, root)
    assert set(kept) == {"part=0", "part=1"}
    assert spark.read.option("basePath", root).parquet(*versions.paths(spark, root)).count() == 5 + 4
    assert len([n for n in os.listdir(root) if n.startswith("version=")]) == 3
    assert not versions._create(spark, root, max(versions._numbers(spark, root)), {"other": "x"})
    assert versions.current(spark, root) == kept
    versions.publish(spark, root, [], "", ["part=0"])
    assert set(versions.current(spark, root)) == {"part=1"}


def test_files_follow_the_amount_of_data(spark, tmp_path):
    rows = spark.range(0, 40_000, 1, 200).selectExpr(
        "case when id % 10 < 7 then 'hot' else concat('h', id % 24) end as hour", "uuid() as text", "id"
    )
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "256k")
    try:
        writers.write_by_key(rows, "hour", str(tmp_path / "t"))
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    files = [f"{d}/{n}" for d, _, names in os.walk(tmp_path / "t") for n in names if n.endswith(".parquet")]
    hot = [f for f in files if "hour=hot" in f]
    assert len(files) < 80 and 2 <= len(hot) <= 20
    assert spark.read.parquet(str(tmp_path / "t")).count() == 40_000


def test_ordered_files_are_skipped_by_prefix(spark, tmp_path):
    path = str(tmp_path / "o")
    rows = spark.range(5000).selectExpr("concat(lpad(cast(id % 50 as string), 2, '0'), chr(26), id) as k", "id")
    rows = rows.union(spark.createDataFrame([(None, -1)], rows.schema))
    writers.write_in_key_order(rows, "k", path, files=10)
    found = writers.read_key_prefix(spark, rows.schema, "k", path, "07\x1a")
    assert rows_of(found) == rows_of(rows.where("startswith(k, concat('07', chr(26)))"))
    assert len(writers.files_of_prefix(spark, path, "07\x1a")) <= 2
    assert writers.read_key_prefix(spark, rows.schema, "k", path, "99").count() == 0
    assert spark.read.parquet(path).count() == 5001
    for f in writers.files_of_prefix(spark, path, ""):
        keys = [r.k for r in spark.read.parquet(f).collect() if r.k]
        assert keys == sorted(keys)


def test_log_files_of_a_range(spark, tmp_path):
    for name in ("20240131/a.2024013122", "20240131/a.2024013123.gz", "20240131/a.20240131230", "20240201/a.2024020100", "20240201/b.2024020101", "20240203/a.2024020300"):
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_text(f"{name}\n")
    names = lambda *span: [f.rsplit("/", 1)[1] for f in readers.log_files(spark, str(tmp_path), *span, "a.")]
    assert names("2024013123", "2024020301") == ["a.2024013123.gz", "a.2024020100", "a.2024020300"]
    assert names("20240131", "20240131") == ["a.2024013122", "a.2024013123.gz"]
    assert readers.log_range(spark, str(tmp_path), "20250101", "20250102").count() == 0
    assert [r.value for r in readers.log_range(spark, str(tmp_path), "2024020100", "2024020102", "a.").collect()] == ["20240201/a.2024020100"]


def random_streams(spark, seed, n=400):
    rng = random.Random(seed)
    some = lambda *xs: rng.choice(xs)
    hits, dwell, ads, ad_dwell = [], [], [], []
    for _ in range(n):
        common = {"domain": some("s", "t"), "new": some(None, 1), "se": some(None, "www.baidu.com", "m.baidu.com", "www.google.com"), "kw": some("a", "b"),
                  "ref": some("-", "http://www.p.com/1", "http://m.p.com/2"), "wb": some(0, 1), "province": some("p", "q"), "city": some(None, "c", "d"), "area": some(None, "i")}
        period = some("20240101", "20240102")
        hits.append((period, *hit(some("-", *"ABCDEF"), ip=some(None, "1.1.1.1", "2.2.2.2"), **common)[1:]))
        dwell.append((period, common["domain"], rng.randrange(9000), *(common[c] for c in "new se wb kw ref province city area".split())))
        ads.append((period, some("1.1.1.1", "2.2.2.2"), some("-", *"ABC"), common["domain"], common["new"], some("x", "y")))
        ad_dwell.append((period, common["domain"], some("x", "y"), common["new"], rng.randrange(9000)))
    return {"hits": hits_frame(spark, hits), "dwell": spark.createDataFrame(dwell, DWELL), "ad_hits": spark.createDataFrame(ads, ADS), "ad_dwell": spark.createDataFrame(ad_dwell, AD_DWELL)}


def test_counters_of_batches_equal_one_run(spark, tmp_path):
    root = str(tmp_path)
    first, second, wrong = (random_streams(spark, n) for n in (1, 2, 3))
    state.add_batch(first, root, "20240102")
    state.add_batch(wrong, root, "2024010305")
    state.add_batch(second, root, "2024010305")
    both = {k: first[k].union(second[k]) for k in first}

    def same(name, grain="day", **more):
        family = FAMILIES[name]
        streams = {k: s.withColumn("period", F.lit("all")) if grain == "all" else s for k, s in both.items()}
        loyal = name in ("site", "ad")
        want = wide_cells(streams[family.hits], streams[family.dwell], family, loyalty=loyal)
        got = state.wide_rows(spark, root, name, ("traffic", "bounce", "loyalty") if loyal else ("traffic", "bounce"), grain=grain, **more)
        assert rows_of(got) == rows_of(want.select(*got.columns)), name

    for name in ("site", "ad", "engine", "engine_region"):
        same(name)
    same("site", "all")
    state.fold(spark, root)
    assert list(versions.current(spark, root)) == [state.FOLDED]
    same("engine")
    same("link")
    day = state.wide_rows(spark, root, "direct", ("traffic",), "20240101")
    want = visitor_cells(both["hits"].where("period = '20240101'"), FAMILIES["direct"], ("traffic",))
    assert rows_of(day.select(*want.columns)) == rows_of(want)


def test_no_counters_yet(spark, tmp_path):
    assert state.wide_rows(spark, str(tmp_path), "engine", ("traffic", "bounce")).count() == 0


@pytest.mark.parametrize(("name", "most"), [("engine", 2), ("keyword", 2), ("link", 2), ("region", 2), ("engine_region", 3)])
def test_all_levels_share_the_exchange_of_their_members(spark, name, most):
    """One exchange combines the members, one brings them home, and no coarser level adds one."""
    hits = random_streams(spark, 4, 50)["hits"]
    cells = visitor_cells(hits, FAMILIES[name], ("traffic", "bounce"))
    cells.collect()
    plan = cells._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    moved = {i: keys for keys, i in re.findall(r"Exchange hashpartitioning\(([^)]*)\).*?plan_id=(\d+)", plan) if "kind#" in keys}
    assert 1 <= len(moved) <= most, moved


def test_both_region_families_at_once(spark):
    hits = random_streams(spark, 5)["hits"]
    both = visitor_cells(hits, FAMILIES["engine_region"], ("traffic", "bounce"))
    for part in ("engine_province", "engine_city"):
        want = visitor_cells(hits, FAMILIES[part], ("traffic", "bounce"))
        levels = [level.name for level in FAMILIES[part].levels]
        assert rows_of(both.where(F.col("level").isin(levels)).select(*want.columns)) == rows_of(want)


def test_sketches_unite_like_sets(spark):
    rows = spark.range(60_000).selectExpr(
        "concat('202401', lpad(cast(1 + id % 3 as string), 2, '0'), lpad(cast(id % 24 as string), 2, '0')) as period", "'s' as domain",
        "cast(pmod(hash(id), 20000) as string) as wid", "case when id % 5 > 0 then cast(id % 700 as string) end as ip", "case when id % 2 = 0 then 1 end as new",
    )
    hours = sketches.sketch_cells(rows, ["period", "domain"])
    day = F.substring("period", 1, 8).alias("period")
    days = sketches.united(hours.select(day, *[c for c in hours.columns if c != "period"]), ["period", "domain"])
    got = {r.period: r for r in sketches.estimates(days).collect()}
    for r in visitor_cells(rows.select(day, "domain", "wid", "ip", "new"), FAMILIES["site"], ("traffic",)).collect():
        near = got[r.period]
        assert (near.pv, near.retpv) == (r.pv, r.retpv)
        for cell in ("uv", "ip", "retuv", "retip"):
            assert abs(near[cell] - r[cell]) <= 4 * sketches.standard_error() * r[cell]
    assert sketches.estimates(sketches.sketch_cells(rows.limit(0), ["period"])).count() == 0


@pytest.mark.parametrize("seed", range(3))
def test_nested_and_overlapping_ranges_against_all_ranges(spark, seed):
    rng = random.Random(seed)
    ranges = []
    for n in range(60):
        low = rng.randrange(0, 200_000)
        ranges.append((low, low + rng.choice([0, 3, 255, 256, 5000, 65536, 120_000]), f"c{n}", None if n % 9 == 0 else "a"))
    ranges += [(10, 20, "same", "x"), (15, 25, "same-long", "x"), (9, 8, "backwards", "x"), (70_000, 80_000, "tie1", "x"), (70_001, 80_001, "tie2", "x")]
    table = spark.createDataFrame(ranges, "begin_ip long, end_ip long, country string, area string")
    points = sorted({rng.randrange(0, 330_000) for _ in range(800)} | {b for b, *_ in ranges} | {e + d for _, e, *_ in ranges for d in (0, 1)})
    frame = spark.createDataFrame([(p, f"0.{p >> 16}.{p >> 8 & 255}.{p & 255}") for p in points], "i int, ip string")

    def best(p):
        inside = [r for r in ranges if r[0] <= p <= r[1]]
        return min(inside, key=lambda r: (r[1] - r[0], -r[0], r[2]))[2] if inside else "未知国家"

    want = {p: best(p) for p in points}
    pieces = geo.range_pieces(table)
    for located in (geo.locate(frame, table), geo.locate_by_window(frame, pieces)):
        assert {r.i: r.country for r in located.collect()} == want
    held = sorted((r.low, r.high) for r in pieces.collect())
    assert all(a[1] < b[0] for a, b in zip(held, held[1:], strict=False))


def test_batches_do_not_make_the_streams_again(spark, monkeypatch):
    from grainmill.plans import catalog_stored, fixture as fx

    seen = []
    monkeypatch.setattr(catalog_stored.state, "add_batch", lambda streams, root, batch: seen.append({k: (s.inputFiles(), s.columns, s.count()) for k, s in streams.items()}))
    d = "/root/testdata/sf0.001"
    catalog_stored._two_batches(spark, d, again=True)
    assert len(seen) == 3 and seen[1] == seen[2]
    for k in ("hits", "dwell", "ad_hits", "ad_dwell"):
        whole = fx.STREAMS[k](spark, d)
        assert seen[0][k][2] + seen[1][k][2] == whole.count() and seen[0][k][1] == whole.columns
        assert not any("events.parquet" in f for batch in seen for f in batch[k][0])


def test_many_batches_fold_in_pieces(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(state, "FOLD_ROWS", 50)
    from grainmill.plans import fixture as fx

    streams = {k: fx.STREAMS[k](spark, "/root/testdata/sf0.001") for k in ("hits", "dwell", "ad_hits", "ad_dwell")}
    root = str(tmp_path / "counters")
    for batch in ("20240131", "20240201"):
        state.add_batch(streams, root, batch)
    members = lambda: sorted(map(str, state.members_of(spark, root, "site").collect()))
    before = members()
    state.fold(spark, root)
    assert members() == before and len(before) > 50
