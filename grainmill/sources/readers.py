"""Inputs: raw logs, delimited text, cleaned streams, configuration and address ranges."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..functions.scalars import ip_number, whole_number
from ..operators.clean import Rules
from ..schemas import KINDS, OLDER_STREAMS, STREAMS, struct
from . import versions

FIELD_MARK = "`"


def period_path(root: str, period: str, hour_prefix: str = "") -> str:
    """Folder of a day (``yyyyMMdd``) or file of an hour (``yyyyMMddHH``) below a log root."""
    if len(period) == 8:
        return f"{root}/{period}"
    if len(period) == 10:
        return f"{root}/{period[:8]}/{hour_prefix}{period}"
    raise ValueError(f"not a day or an hour: {period}")


def hours_between(begin: str, end: str) -> list[str]:
    """All hours (``yyyyMMddHH``) from one day or hour to another, both included."""
    first = datetime.strptime(begin if len(begin) == 10 else f"{begin}00", "%Y%m%d%H")
    last = datetime.strptime(end if len(end) == 10 else f"{end}23", "%Y%m%d%H")
    return [(first + timedelta(hours=n)).strftime("%Y%m%d%H") for n in range(int((last - first).total_seconds() // 3600) + 1)]


def log_files(spark: SparkSession, root: str, begin: str, end: str, hour_prefix: str = "") -> list[str]:
    """Existing log files of all hours from ``begin`` to ``end`` (days or hours) below a log root, in order.

    An hour's files are all that its path begins: ``root/day/prefix + hour`` and what follows the hour (parts, ``.gz``). Each day's folder
    is listed once, whatever the number of hours, and no other folder is; missing days and hours have no files.
    """
    found: list[str] = []
    hours = hours_between(begin, end)
    path = spark._jvm.org.apache.hadoop.fs.Path
    for day in dict.fromkeys(h[:8] for h in hours):
        folder = path(period_path(root, day))
        store = folder.getFileSystem(spark._jsc.hadoopConfiguration())
        if not store.exists(folder):
            continue
        wanted = {f"{hour_prefix}{h}" for h in hours if h[:8] == day}
        size = len(hour_prefix) + 10
        names = {s.getPath().getName(): s.getPath().toString() for s in store.listStatus(folder)}
        found += [names[n] for n in sorted(names) if n[:size] in wanted and not n[size : size + 1].isdigit()]
    return found


def log_range(spark: SparkSession, root: str, begin: str, end: str, hour_prefix: str = "", tasks: int | None = None) -> DataFrame:
    """Raw beacon lines of all hours from ``begin`` to ``end``; no lines where no file exists."""
    found = log_files(spark, root, begin, end, hour_prefix)
    return raw_log(spark, *found, tasks=tasks) if found else empty(spark, struct("value"))


def raw_log(spark: SparkSession, *paths: str, tasks: int | None = None) -> DataFrame:
    """Raw beacon lines as ``value``; paths may be files, folders or globs.

    ``tasks`` deals the lines of a few unsplittable files out to so many tasks.
    """
    lines = spark.read.text(list(paths))
    return lines if tasks is None else lines.repartition(tasks)


def delimited(
    spark: SparkSession, path: str, schema: T.StructType, sep: str = FIELD_MARK, encoding: str = "UTF-8"
) -> DataFrame:
    """Delimited text without quoting.

    Short rows are padded with nulls, long rows cut, empty text is null, and text that is not a
    number is null in a numeric column without losing the row.
    """
    texts = T.StructType([T.StructField(f.name, T.StringType()) for f in schema])
    rows = (
        spark.read.schema(texts)
        .option("sep", sep)
        .option("quote", "")
        .option("mode", "PERMISSIVE")
        .option("encoding", encoding)
        .csv(path)
    )
    return rows.select(*[_typed(f).alias(f.name) for f in schema])


def _typed(field: T.StructField) -> Column:
    if isinstance(field.dataType, T.StringType):
        return F.nullif(field.name, F.lit(""))
    if isinstance(field.dataType, (T.IntegerType, T.LongType)):
        return whole_number(field.name, field.dataType.simpleString())
    return F.col(field.name).try_cast(field.dataType)


def older_stream(spark: SparkSession, path: str, layout: str, sep: str = FIELD_MARK) -> DataFrame:
    """A text file in one of the older layouts as today's stream: same columns and types, null where the layout has none.

    ``new`` is read as a number, so the ``-`` of a returning visitor is null as in today's streams.
    """
    rows = delimited(spark, path, OLDER_STREAMS[layout], sep)
    kind = layout.split("_")[0]

    def column(field: T.StructField) -> Column:
        if field.name not in rows.columns:
            return F.lit(None).cast(field.dataType)
        same = rows.schema[field.name].dataType == field.dataType
        return F.col(field.name) if same else whole_number(field.name, field.dataType.simpleString())

    return rows.select(*[column(f).alias(f.name) for f in STREAMS[kind]])


def lines(spark: SparkSession, path: str, column: str = "url") -> DataFrame:
    """One text column per line."""
    return spark.read.text(path).withColumnRenamed("value", column)


def empty(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return spark.createDataFrame([], schema)


def if_present(read, spark: SparkSession, schema: T.StructType) -> DataFrame:
    """The frame ``read()`` gives, or an empty one of the schema when its path does not exist."""
    try:
        return read()
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return empty(spark, schema)
        raise


def cleaned(spark: SparkSession, root: str, kind: str, period: str | None = None) -> DataFrame:
    """One cleaned stream of all batches, pruned to a kind and a period (day or hour) by folder names."""
    fields = {f.name: f for f in [*KINDS[kind].fields, *struct("vtime").fields]}
    folders = struct("batch kind day hour").fields
    layout = T.StructType([*fields.values(), *folders])
    with_period = T.StructType([*fields.values(), *struct("day hour").fields])

    batches = versions.paths(spark, root)
    if not batches:
        return empty(spark, with_period)
    rows = spark.read.schema(layout).option("basePath", root).parquet(*batches).where(F.col("kind") == kind)
    if period:
        rows = rows.where(F.col("day") == period[:8])
    if period and len(period) == 10:
        rows = rows.where(F.col("hour") == period[8:])
    return rows.select(*with_period.names)


def batch_days(spark: SparkSession, root: str, batch: str) -> list[str]:
    """Days that a cleaning run wrote records for: those to report again after it."""
    schema = struct("kind day hour")
    found = versions.paths(spark, root, lambda part: part == f"batch={batch}")
    rows = spark.read.schema(schema).parquet(*found) if found else empty(spark, schema)
    return sorted(r["day"] for r in rows.where("kind <> 'rejects'").select("day").distinct().collect())


def rules_from(filters: DataFrame | None = None, rewrites: DataFrame | None = None) -> Rules:
    """Rules out of the two configuration tables: a handful of rows somebody wrote by hand."""
    kept = [] if filters is None else [r["regex"] for r in filters.orderBy("regex").collect()]
    ordered = [] if rewrites is None else rewrites.orderBy("priority").collect()
    return Rules(kept, [(r["regex"], r["replacement"]) for r in ordered])


def tracked_sites(config: DataFrame, config_row: str = "my") -> DataFrame:
    """Tracked sites; the row that holds the rules is not a site."""
    return config.where(F.col("domain") != config_row).select("domain")


def text_ranges(df: DataFrame) -> DataFrame:
    """Ranges given as dotted addresses -> numeric bounds."""
    return df.select(
        ip_number("begin_ip").alias("begin_ip"), ip_number("end_ip").alias("end_ip"), "country", "area"
    )


def ip_ranges(spark: SparkSession, path: str, sep: str = ",", encoding: str = "UTF-8") -> DataFrame:
    """The address dictionary from delimited text: begin, end, country, area.

    A dictionary in GBK needs ``spark.sql.legacy.javaCharsets=true`` in the session.
    """
    names = T.StructType([T.StructField(n, T.StringType()) for n in ("begin_ip", "end_ip", "country", "area")])
    return text_ranges(delimited(spark, path, names, sep, encoding))
