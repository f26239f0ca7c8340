"""Outputs: routed streams, text, and result tables with one row per key."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..operators.merge import overlay
from ..operators.periods import period_of
from ..schemas import RESULT_TABLES
from ..session import kept
from . import versions
from .readers import FIELD_MARK

INDEX = "_key_index"
NO_PERIOD = "__HIVE_DEFAULT_PARTITION__"


def gathered(df: DataFrame, *folders: str) -> DataFrame:
    """The rows of a folder side by side before a write by folders, in pieces of like size.

    Without it every task writes a file into every folder it has a row of. Small folders share a task, and a large one is split by size
    (``spark.sql.adaptive.advisoryPartitionSizeInBytes``), so the number of files follows the amount of data.
    """
    return df.hint("rebalance", *folders)


def write_streams(routed: DataFrame, root: str, batch: str) -> None:
    """Routed records of one run as ``batch=.../kind=.../day=.../hour=...`` folders.

    A run owns its batch (a day or an hour): running it again replaces exactly that, once all of it is written, and other runs keep what
    they wrote for the same days. Records whose time cannot be read count under the batch's own day and hour.
    """
    day, hour = period_of("vtime", "day"), F.substring(period_of("vtime", "hour"), 9, 2)
    own_hour = F.lit(batch[8:10] or None).cast("string")
    rows = routed.withColumns({"day": F.coalesce(day, F.lit(batch[:8])), "hour": F.when(day.isNull(), own_hour).otherwise(hour)})
    with versions.replacing(routed.sparkSession, root, [f"batch={batch}"]) as folder:
        gathered(rows, "kind", "day", "hour").write.partitionBy("kind", "day", "hour").parquet(f"{folder}/batch={batch}")


def write_by_key(df: DataFrame, key: str, path: str) -> None:
    """Rows under one folder per key value, the key itself only in the folder name."""
    gathered(df, key).write.partitionBy(key).mode("overwrite").parquet(path)


def write_in_key_order(df: DataFrame, key: str, path: str, files: int | None = None) -> None:
    """Rows sorted by a key text over files that follow each other, and an index of the first and last key of each file.

    The ranges come from a sample of the keys, so files are of like size; equal keys share a file. ``row_key_descending`` gives keys with
    descending counts. Rows without a key are the first ones.
    """
    spread = df.repartitionByRange(files, key) if files else df.repartitionByRange(key)
    spread.sortWithinPartitions(key).write.mode("overwrite").parquet(path)
    written = df.sparkSession.read.schema(df.schema).parquet(path).select(F.input_file_name().alias("file"), F.col(key).alias("k"))
    # The index is read from the written files and lies beside the rows, where readers of the folder do not see it.
    index = written.groupBy("file").agg(F.min("k").alias("low"), F.max("k").alias("high"))
    index.coalesce(1).write.mode("overwrite").parquet(f"{path}/{INDEX}")


def files_of_prefix(spark: SparkSession, path: str, prefix: str) -> list[str]:
    """Files that may hold keys with the prefix, by the index."""
    index = spark.read.schema("file string, low string, high string").parquet(f"{path}/{INDEX}")
    size = F.lit(len(prefix))
    inside = (F.substr("low", F.lit(1), size) <= prefix) & (F.substr("high", F.lit(1), size) >= prefix)
    return [r["file"] for r in index.where(inside).orderBy("low").select("file").collect()]


def read_key_prefix(spark: SparkSession, schema: T.StructType, key: str, path: str, prefix: str) -> DataFrame:
    """Rows whose key starts with the prefix, in key order inside each file; other files are not opened."""
    found = files_of_prefix(spark, path, prefix)
    if not found:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*found).where(F.col(key).startswith(prefix))


def write_text(df: DataFrame, path: str, sep: str = FIELD_MARK) -> None:
    """Delimited text without quoting; null is empty text."""
    (
        df.write.mode("overwrite")
        .option("sep", sep)
        .option("quote", "")
        .option("emptyValue", "")
        .option("nullValue", "")
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


def read_table(
    spark: SparkSession, root: str, name: str, period: str | None = None, hourly: bool = False
) -> DataFrame:
    """A result table, empty when nothing was written yet; of one period only its folder is listed."""
    schema, folder = RESULT_TABLES[name].schema(hourly), f"{root}/{name}"
    found = versions.paths(spark, folder, lambda part: period is None or part == f"period={period}")
    if not found:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", folder).parquet(*found).select(*schema.names)


def replace_period(rows: DataFrame, root: str, name: str, period: str) -> None:
    """Write one period of a result table in place of what was stored for it, also when no rows are left.

    What was stored stays until the new rows are complete.
    """
    names = [c for c in RESULT_TABLES[name].schema().names if c != "period"]
    part = f"period={period}"
    with versions.replacing(rows.sparkSession, f"{root}/{name}", [part]) as folder:
        rows.where(F.col("period") == period).select(*names).write.parquet(f"{folder}/{part}")


def upsert_table(fresh: DataFrame, root: str, name: str, hourly: bool = False) -> None:
    """Merge cells into the rows of the same key; only periods with new cells are rewritten, the null period like any other.

    The new cells are computed once. What was stored stays until the rewritten periods are complete.
    """
    keys = ["period", "level", *RESULT_TABLES[name].keys]
    spark = fresh.sparkSession
    with kept(fresh, "upsert") as cells:
        # One row per period that has new cells.
        periods = [r["period"] for r in cells.select("period").distinct().collect()]
        parts = [f"period={NO_PERIOD if p is None else p}" for p in periods]
        schema, root_folder = RESULT_TABLES[name].schema(hourly), f"{root}/{name}"
        found = versions.paths(spark, root_folder, set(parts).__contains__)
        stored = spark.createDataFrame([], schema) if not found else spark.read.schema(schema).option("basePath", root_folder).parquet(*found)
        with versions.replacing(spark, root_folder, parts) as folder:
            rows = overlay(stored.select(*schema.names), cells, keys).select(*schema.names)
            gathered(rows, "period").write.partitionBy("period").parquet(folder)
