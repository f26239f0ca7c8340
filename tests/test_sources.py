"""Readers, writers and the jobs, through files."""

import os

import pytest
from pyspark.sql import functions as F

from grainmill import schemas
from grainmill.operators import clean
from grainmill.operators.periods import valid_day, with_period
from grainmill.plans import fixture as fx, jobs
from grainmill.sources import readers, writers

SF = "/root/testdata/sf0.01"


def write(path, text, encoding="utf-8"):
    path.write_bytes(text.encode(encoding))
    return str(path)


def test_delimited_pads_cuts_and_nulls(spark, tmp_path):
    text = "a`1`\n\"b`-\n`7`z`extra\n"
    path = write(tmp_path / "f", text)
    rows = readers.delimited(spark, path, schemas.struct("s n:int t")).collect()
    assert [tuple(r) for r in rows] == [("a", 1, None), ('"b', None, None), (None, 7, "z")]


def test_comma_scan_keeps_blanks(spark, tmp_path):
    path = write(tmp_path / "f.csv", "5, John, Smith\n")
    row = readers.delimited(spark, path, schemas.struct("id:int first last"), sep=",").first()
    assert tuple(row) == (5, " John", " Smith")


def test_older_layout(spark, tmp_path):
    path = write(tmp_path / "f", "1.1.1.1`w`p`-`xy`/5a.gif`2013-12-25 12:59:09`h`1`-\n")
    row = readers.delimited(spark, path, schemas.OLDER_STREAMS["hits_2013_host"]).first()
    assert (row.domain, row.vtime, row.new, row.enter) == ("xy", "2013-12-25 12:59:09", "1", "-")


def test_ranges_in_another_charset(spark, tmp_path):
    path = write(tmp_path / "r", "1.0.0.0,1.0.0.9,广东省,电信\n", "gbk")
    spark.conf.set("spark.sql.legacy.javaCharsets", "true")
    try:
        ranges = readers.ip_ranges(spark, path, encoding="GBK")
        assert tuple(ranges.first()) == (16777216, 16777225, "广东省", "电信")
    finally:
        spark.conf.unset("spark.sql.legacy.javaCharsets")


def test_lines_and_text_sink(spark, tmp_path):
    path = write(tmp_path / "u", "http://a/%E6%90%9C\n")
    out = str(tmp_path / "out")
    decoded = readers.lines(spark, path).select(F.try_url_decode("url").alias("url"))
    writers.write_text(decoded, out)
    assert [r.url for r in readers.lines(spark, out).collect()] == ["http://a/搜"]


def test_text_sink_round_trip(spark, tmp_path):
    out = str(tmp_path / "out")
    rows = [("a", None, 3), ("b", 'q"x', None)]
    writers.write_text(spark.createDataFrame(rows, "s string, t string, n int"), out)
    back = readers.delimited(spark, out, schemas.struct("s t n:int")).collect()
    assert sorted(tuple(r) for r in back) == rows


def test_key_as_folder(spark, tmp_path):
    out = str(tmp_path / "out")
    frame = spark.createDataFrame([("x", 1), ("y", 2)], "k string, v int")
    writers.write_by_key(frame, "k", out)
    assert {n for n in os.listdir(out) if n.startswith("k=")} == {"k=x", "k=y"}


def test_period_paths():
    assert readers.period_path("/log", "20140101") == "/log/20140101"
    assert readers.period_path("/log", "2014010107", "access.") == "/log/20140101/access.2014010107"
    with pytest.raises(ValueError):
        readers.period_path("/log", "2014")
    assert valid_day("20140131") and not valid_day("20140132") and not valid_day("2014131")


def test_period_of_times_and_bad_text(spark):
    frame = spark.createDataFrame([("2014-01-07 09:15:06",), ("nonsense",)], "vtime string")
    assert [r.period for r in with_period(frame, "hour").collect()] == ["2014010709", None]
    assert [r.period for r in with_period(frame).collect()] == ["20140107", None]


def test_missing_stream_is_empty(spark, tmp_path):
    frame = readers.cleaned(spark, str(tmp_path / "none"), "hits", "20240101")
    assert frame.count() == 0 and "wid" in frame.columns


def test_configuration(spark):
    filters = spark.createDataFrame([("b",), ("a",)], schemas.RULES_FILTER)
    rewrites = spark.createDataFrame([(2, "y", "2"), (1, "x", "1")], schemas.RULES_REWRITE)
    rules = readers.rules_from(filters, rewrites)
    assert rules == clean.Rules(["a", "b"], [("x", "1"), ("y", "2")])
    config = spark.createDataFrame([("my",), ("xy",)], schemas.SITES)
    assert [r.domain for r in readers.tracked_sites(config).collect()] == ["xy"]


def test_raw_log_is_dealt_out_only_when_asked(spark, tmp_path):
    path = write(tmp_path / "log", "a\nb\n")
    assert readers.raw_log(spark, path).rdd.getNumPartitions() == 1
    assert readers.raw_log(spark, path, tasks=3).rdd.getNumPartitions() == 3


def test_upsert_merges_cells_and_keeps_other_periods(spark, tmp_path):
    root = str(tmp_path / "tables")
    day = lambda p, d, **cells: spark.createDataFrame([(p, "domain", d, *cells.values())], "period string, level string, domain string, " + ", ".join(f"{c} long" for c in cells))
    writers.upsert_table(day("20240101", "a", pv=5, uv=2), root, "domain")
    writers.upsert_table(day("20240102", "a", pv=9), root, "domain")
    writers.upsert_table(day("20240101", "a", br=7, uv=3), root, "domain")
    writers.upsert_table(day("20240101", "b", pv=1), root, "domain")
    writers.upsert_table(day("20240101", "b", pv=1), root, "domain")
    rows = writers.read_table(spark, root, "domain").collect()
    assert sorted((r.period, r.domain, r.pv, r.uv, r.br) for r in rows) == [
        ("20240101", "a", 5, 3, 7), ("20240101", "b", 1, None, None), ("20240102", "a", 9, None, None),
    ]


@pytest.fixture(scope="module")
def job_roots(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("job")
    log, cleaned, results = (str(base / n) for n in ("log", "cleaned", "results"))
    fx.raw_lines(spark, SF).where(F.col("value").contains("2024-01-05")).write.text(log)
    rules = clean.Rules(fx.FILTER_RULES, fx.REWRITE_RULES)
    for _ in range(2):  # a rerun replaces the day
        jobs.clean_logs(readers.raw_log(spark, log), rules, fx.sites(spark, SF), fx.ip_ranges(spark, SF), cleaned, "20240105")
    jobs.report(spark, cleaned, results, "20240105")
    jobs.report(spark, cleaned, results, "2024010507")
    return cleaned, results, log


def test_cleaning_job_equals_direct_streams(spark, job_roots):
    cleaned, _, log = job_roots
    rules = clean.Rules(fx.FILTER_RULES, fx.REWRITE_RULES)
    lines = readers.raw_log(spark, log)
    parsed = clean.clean(lines, rules, fx.sites(spark, SF), fx.ip_ranges(spark, SF))
    order = lambda frame: sorted(frame.collect(), key=str)
    for kind in schemas.STREAMS:
        stored = readers.cleaned(spark, cleaned, kind, "20240105").drop("day", "hour")
        direct = clean.stream(parsed, kind).select(stored.columns)
        assert order(stored) == order(direct) != [], kind


def test_stream_reader_prunes_partitions(spark, job_roots):
    plan = readers.cleaned(spark, job_roots[0], "hits", "20240105").select("wid")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(kind" in text and "ReadSchema: struct<wid:string>" in text


def test_daily_job_writes_every_table(spark, job_roots):
    for name, table in schemas.RESULT_TABLES.items():
        stored = writers.read_table(spark, job_roots[1], name, "20240105")
        rows = stored.count()
        assert rows > 0, name
        assert stored.select("level", *table.keys).distinct().count() == rows, name


def test_hourly_job_has_text_cells(spark, job_roots):
    rows = writers.read_table(spark, f"{job_roots[1]}_hourly", "domain", "2024010507", hourly=True).collect()
    for r in rows:
        assert r.br is None or r.br.endswith("%")
        assert r.avgtime is None or r.avgtime.count(":") == 2


def lines_of(spark, *times):
    """Valid beacon lines at these time texts."""
    mark = "\x1a"
    query = "?wb=0&cd=24&re=&id=click&u=http%3A%2F%2Fclick.example.com%2Fp%2F1&lnt=&se=&kw=&adsfrom=&adsnew=&adsnum=&hot="
    rows = [(mark.join(["10.0.0.1", "0", t, "GET", "/5a.gif", query, " 200", "0", "http://click.example.com/p/1", "Mozilla/5.0", f"wid=w{n}"]),) for n, t in enumerate(times)]
    return spark.createDataFrame(rows, "value string")


def run_batch(spark, root, batch, *times, rules=None):
    rules = rules or clean.Rules()
    return jobs.clean_logs(lines_of(spark, *times), rules, spark.createDataFrame([("click",)], "domain string"), fx.ip_ranges(spark, SF), root, batch)


def stored_hits(spark, root, period=None):
    return readers.cleaned(spark, root, "hits", period).count()


def test_two_hours_of_a_day_stay_both(spark, tmp_path):
    root = str(tmp_path / "c")
    assert run_batch(spark, root, "2024010507", "2024-01-05 07:10:00", "2024-01-05 07:20:00") == ["20240105"]
    run_batch(spark, root, "2024010508", "2024-01-05 08:10:00")
    run_batch(spark, root, "2024010508", "2024-01-05 08:10:00")  # again
    assert [stored_hits(spark, root, p) for p in ("2024010507", "2024010508", "20240105", "2024010509")] == [2, 1, 3, 0]


def test_stragglers_leave_their_day_alone(spark, tmp_path):
    root, results = str(tmp_path / "c"), str(tmp_path / "r")
    run_batch(spark, root, "20240105", "2024-01-05 10:00:00", "2024-01-05 11:00:00", "2024-01-05 12:00:00")
    days = run_batch(spark, root, "20240106", "2024-01-05 23:59:00", "2024-01-06 10:00:00")
    assert days == ["20240105", "20240106"] and stored_hits(spark, root, "20240105") == 4
    jobs.report(spark, root, results, "20240105")
    assert [r.pv for r in writers.read_table(spark, results, "domain", "20240105").collect()] == [4]


def test_a_rerun_that_rejects_everything_leaves_nothing(spark, tmp_path):
    root, results = str(tmp_path / "c"), str(tmp_path / "r")
    times = ("2024-01-05 10:00:00", "2024-01-05 11:00:00")
    run_batch(spark, root, "20240105", *times)
    jobs.report(spark, root, results, "20240105")
    assert run_batch(spark, root, "20240105", *times, rules=clean.Rules(["Mozilla"])) == []
    assert stored_hits(spark, root) == 0
    rejected = readers.cleaned(spark, root, "rejects", "20240105").collect()
    assert len(rejected) == 2 and {r.reason for r in rejected} != {None}
    jobs.report(spark, root, results, "20240105")
    assert writers.read_table(spark, results, "domain", "20240105").count() == 0


def test_unreadable_times_count_under_the_batch(spark, tmp_path):
    root = str(tmp_path / "c")
    run_batch(spark, root, "2024010507", "2024-01-05 07:10:00", "no time")
    run_batch(spark, root, "20240106", "no time")
    assert [stored_hits(spark, root, p) for p in ("2024010507", "20240105", "20240106")] == [2, 2, 1]


def test_upsert_keeps_other_rows_of_the_null_period(spark, tmp_path):
    root = str(tmp_path / "tables")
    rows = lambda *r: spark.createDataFrame([(None, "domain", *x) for x in r], "period string, level string, domain string, pv long, uv long")
    writers.upsert_table(rows(("a", 1, 2), ("b", 3, 4)), root, "domain")
    writers.upsert_table(rows(("a", 9, None)), root, "domain")
    got = writers.read_table(spark, root, "domain").collect()
    assert sorted((r.period, r.domain, r.pv, r.uv) for r in got) == [(None, "a", 9, 2), (None, "b", 3, 4)]


def test_a_failed_table_does_not_stop_the_report(spark, job_roots, tmp_path, monkeypatch):
    real = jobs.result_table

    def failing(name, *rest):
        if name == "ads":
            raise ValueError("no ads")
        return real(name, *rest)

    monkeypatch.setattr(jobs, "result_table", failing)
    with pytest.raises(ExceptionGroup, match="ads"):
        jobs.report(spark, job_roots[0], str(tmp_path / "r"), "20240105")
    assert writers.read_table(spark, str(tmp_path / "r"), "heatmap", "20240105").count() > 0


def test_hourly_job_writes_visited_hosts(spark, job_roots):
    rows = writers.read_table(spark, f"{job_roots[1]}_hourly", "respondomain", "2024010507", hourly=True)
    assert rows.count() > 0
