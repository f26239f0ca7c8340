"""Cleaned streams and raw log lines derived from the ``events`` table.

Everything here is a projection of the given tables, so its size grows with them. An event is
either a page close (one in four) or a page view, so the two streams together hold every event.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.scalars import SEP
from ..operators.periods import with_period


K = "cast(regexp_extract(props, '([0-9]+)', 1) as int)"

# Shared by Spark SQL and the oracle: column -> expression over events plus k.
EXPRESSIONS = {
    "ip": "concat('10.',cast(user_id%4 as string),'.',cast(k%16 as string),'.',cast(user_id%50 as string))",
    "wid": "case when user_id%37=0 then '-' else cast(user_id as string) end",
    "page": "concat('http://',event_type,'.example.com/p/',cast(k%12 as string))",
    "ref": "case k%4 when 0 then '-' when 1 then 'http://www.partner-a.com/x/1' "
    "when 2 then 'http://m.partner-b.com/y' else 'http://search.partner-c.com/z' end",
    "domain": "event_type",
    "respondomain": "concat(event_type,'.example.com')",
    "enter": "case when k%5=0 then '1' else '0' end",
    "new": "case when event_id%3=0 then 1 end",
    "se": "case k%6 when 0 then 'www.baidu.com' when 1 then 'm.baidu.com' "
    "when 2 then 'www.google.com' when 3 then '3g.sogou.com' end",
    "wb": "case when k%4 in (1,2) then 1 else 0 end",
    "kw": "case when k%7=0 then '-' else concat('kw',cast(k%7 as string)) end",
    "province": "case user_id%6 when 0 then '广东' when 1 then '广东' when 2 then '湖北' "
    "when 3 then '北京' when 4 then '西藏' else '未知国家' end",
    "city": "case user_id%6 when 0 then '广州市' when 1 then '深圳市' when 2 then '恩施州' "
    "when 3 then '海淀区' end",
    "area": "case when k%3=0 then null else concat('isp',cast(k%3 as string)) end",
    "page_avg_time": "cast(floor(value*1000) as bigint)",
    "adsid": "case when k%8=0 then concat('ad',cast(user_id%3 as string)) end",
    "adsref": "case when k%16=0 then 'http://ads.example.net/c' else '-' end",
    "adsnew": "case when k%8=0 then k%2 end",
    "x": "cast(k%20 as string)",
    "y": "cast(event_id%15 as string)",
    "u": "case when k%2=0 then concat('http://',event_type,'.example.com/l/',cast(k%10 as string)) end",
    "click": "concat('mark',cast(k%9 as string))",
    "seq": "event_id",
}
IS_CLOSE = "event_id%4=3"

# The two rewrite rules of the raw-log job, in priority order.
REWRITE_RULES = [
    (r"^(http://[a-z]+\.example\.com/p)/1[0-9]", "$1/tens"),
    (r"^(http://[a-z]+\.example\.com/p)/[0-9]", "$1/ones"),
]
FILTER_RULES = ["spiderbot", r"crawler/[0-9]+\.0"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").withColumn("k", F.expr(K))


def _project(df: DataFrame, columns: str) -> DataFrame:
    picked = [F.expr(EXPRESSIONS[c]).alias(c) for c in columns.split()]
    return df.select("ts", *picked)


def _stream(spark: SparkSession, sf_dir: str, where: str, columns: str, grain: str) -> DataFrame:
    rows = events(spark, sf_dir).where(where)
    return with_period(_project(rows, columns), grain, "ts").drop("ts")


def hits(spark: SparkSession, sf_dir: str, grain: str = "day") -> DataFrame:
    columns = "ip wid page ref domain respondomain enter new se wb kw province city area"
    return _stream(spark, sf_dir, f"not ({IS_CLOSE})", columns, grain)


def timed_hits(spark: SparkSession, sf_dir: str, grain: str = "day") -> DataFrame:
    """Hits that keep their visit time and a sequence number."""
    rows = events(spark, sf_dir).where(f"not ({IS_CLOSE})")
    shaped = _project(rows, "wid page domain seq").withColumnRenamed("ts", "vtime")
    return with_period(shaped, grain)


def dwell(spark: SparkSession, sf_dir: str, grain: str = "day") -> DataFrame:
    columns = "page ref domain page_avg_time respondomain enter new se wb kw province city area"
    return _stream(spark, sf_dir, IS_CLOSE, columns, grain)


def ad_hits(spark: SparkSession, sf_dir: str, grain: str = "day") -> DataFrame:
    where = f"not ({IS_CLOSE}) and ({EXPRESSIONS['adsid']}) is not null"
    return _stream(spark, sf_dir, where, "ip wid domain new adsref adsnew adsid", grain)


def ad_dwell(spark: SparkSession, sf_dir: str, grain: str = "day") -> DataFrame:
    where = f"{IS_CLOSE} and ({EXPRESSIONS['adsid']}) is not null"
    return _stream(spark, sf_dir, where, "domain adsid new page_avg_time", grain)


def hot(spark: SparkSession, sf_dir: str, grain: str = "day") -> DataFrame:
    return _stream(spark, sf_dir, f"not ({IS_CLOSE})", "domain page x y u", grain)


def click_marks(spark: SparkSession, sf_dir: str, grain: str = "day") -> DataFrame:
    return _stream(spark, sf_dir, "event_type='click'", "page click", grain)


STREAMS = {
    "hits": hits,
    "dwell": dwell,
    "ad_hits": ad_hits,
    "ad_dwell": ad_dwell,
    "hot": hot,
    "click_marks": click_marks,
}


def sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tracked sites: every event type but ``error``."""
    types = table(spark, sf_dir, "events").select(F.col("event_type").alias("domain")).distinct()
    return types.where("domain <> 'error'")


# Location text of an address range, by nation key; every branch of the parsers occurs.
COUNTRY = """case n_nationkey%9 when 0 then '北京市海淀区' when 1 then '广东省广州市天河区'
when 2 then '湖北省恩施州利川市' when 3 then '云南省大理州' when 4 then '西藏拉萨市'
when 5 then '内蒙古包头市' when 6 then '上海市' when 7 then n_name else '' end"""
RANGE_AREA = """case n_nationkey%4 when 0 then ' CZ88.NET' when 1 then '电信' when 2 then '联通'
else '' end"""
RANGE_BEGIN = "cast(167772160 + n_nationkey*10486 as bigint)"
RANGE_END = "cast(167772160 + n_nationkey*10486 + case when n_nationkey%5=4 then 9000 else 10485 end as bigint)"


def ip_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Address ranges inside 10.0.0.0/14, one per nation, some crossing a /16, some leaving gaps."""
    return table(spark, sf_dir, "nation").select(
        F.expr(RANGE_BEGIN).alias("begin_ip"),
        F.expr(RANGE_END).alias("end_ip"),
        F.expr(COUNTRY).alias("country"),
        F.expr(RANGE_AREA).alias("area"),
    )


def raw_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw beacon lines (``value``), one per event, with every kind of reject among them.

    The fault of a line follows from ``event_id % 50``.
    """
    rows = table(spark, sf_dir, "events").repartition(spark.sparkContext.defaultParallelism)
    e = rows.withColumn("k", F.expr(K)).withColumn("fault", F.expr("event_id%50"))
    cols = {c: F.expr(EXPRESSIONS[c]) for c in EXPRESSIONS if c not in ("domain", "respondomain")}
    e = e.withColumns(cols)
    encode = F.url_encode
    page_url = F.concat("page", F.lit("?id="), F.col("event_id").cast("string"))
    u = (
        F.when(F.col("fault") == 17, F.lit(""))
        .when(F.col("fault") == 19, F.lit("http%zz"))
        .otherwise(encode(page_url))
    )
    hot_text = F.expr(
        "concat('[{x:', x, ',y:', y, ',t:', case when k%2=0 then 'a' else 'b' end, "
        "case when k%2=0 then concat(',u:', url_encode(concat(u, '?z=1'))) else '' end, '},"
        "{x:', y, '.50,y:', x, ',t:b}]')"
    )
    params = {
        "wb": F.col("wb").cast("string"),
        "cd": F.lit("24"),
        "re": F.when(F.col("ref") == "-", F.lit("")).otherwise(encode(F.concat("ref", F.lit("?q=7")))),
        "id": F.when(F.expr("k%50=49"), F.lit("")).otherwise(F.col("event_type")),
        "u": u,
        "lnt": F.when(F.expr(IS_CLOSE + " and fault<>37 and fault<>35"), F.col("page_avg_time").cast("string")).otherwise(F.lit("")),
        "se": F.coalesce("se", F.lit("")),
        "kw": F.when(F.col("kw") == "-", F.lit("")).otherwise(F.col("kw")),
        "adsfrom": F.when(F.col("adsref") == "-", F.lit("")).otherwise(
            encode(encode(F.concat("adsref", F.lit("?c=1"))))
        ),
        "adsnew": F.coalesce(F.col("adsnew").cast("string"), F.lit("")),
        "adsnum": F.coalesce("adsid", F.lit("")),
        "hot": F.when(F.expr("k%3=0"), hot_text).otherwise(F.lit("")),
    }
    pairs = [F.concat(F.lit(f"{name}="), value) for name, value in params.items()]
    query = F.concat(F.lit("?"), F.concat_ws("&", *pairs))
    mark_query = F.concat(
        F.lit("?click="), F.when(F.col("fault") == 31, F.lit("")).otherwise(F.col("click")), F.lit("&u="), encode(page_url)
    )
    is_mark = F.col("fault").isin(29, 31)
    path = (
        F.when(F.col("fault") == 11, F.lit("/51js.php"))
        .when(is_mark, F.lit("/5c.gif"))
        .when(F.expr(IS_CLOSE), F.lit("/5g.gif"))
        .otherwise(F.lit("/5a.gif"))
    )
    status = (
        F.when(F.col("fault") == 7, F.lit("404")).when(F.col("fault") == 13, F.lit("-")).otherwise(F.lit(" 200"))
    )
    agent = F.when(F.col("fault") == 41, F.lit("spiderbot 2")).otherwise(F.lit("Mozilla/5.0"))
    cookies = F.concat(
        F.when(F.col("wid") == "-", F.lit("a=b")).otherwise(F.concat(F.lit("wid=old; wid="), F.col("wid"))),
        F.when(F.col("new").isNotNull(), F.lit("; newer=1")).otherwise(F.lit("")),
        F.concat(F.lit("; enter="), F.col("enter")),
    )
    cookies = F.when(F.col("fault") == 23, F.lit("")).otherwise(cookies)
    fields = [
        F.col("ip"), F.lit("0"), F.date_format("ts", "yyyy-MM-dd HH:mm:ss"), F.lit("GET"), path,
        F.when(is_mark, mark_query).otherwise(query), status, F.lit("0"), F.col("page"), agent, cookies,
    ]
    return e.select(F.concat_ws(SEP, *fields).alias("value"))
