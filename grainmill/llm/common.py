"""Words of a text, and tables kept in the shared folder while a query runs."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..session import shared_folder

SEPARATORS = " \t\n\x0b\f\r"
WORD_BREAK = r"[\x20\x09-\x0D]+"
HOT_SHARE = 1000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words(text: Column | str) -> Column:
    """Words of a whole text: what stands between spaces, tabs, line feeds, \\v, \\f and \\r; none for null."""
    text = F.col(text) if isinstance(text, str) else text
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), WORD_BREAK), "")


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` over a value that is computed once, also where the body mentions it inside a lambda."""
    return F.transform(F.array(value), body)[0]


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    return shared_folder(spark, "grainmill-llm", f"{name}-{uuid.uuid4().hex}")


def stored(df: DataFrame, name: str) -> DataFrame:
    """The frame written to the shared folder and read again: computed once, and safe from lost executors."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def join_by_count(rows: DataFrame, key: Column, dim: DataFrame, total: int) -> DataFrame:
    """``rows`` left-joined to ``dim``: one row per ``d_key``, a digest, with the number ``d_n`` of rows that hold it.

    Fewer than HOT_SHARE keys can have more than a HOT_SHARE-th of ``total`` rows each. Those are broadcast, and their rows go on
    with keys of their own, as do rows without a key; so no task of the shuffle join gets more rows of one key than that.
    """
    rows, cold = _placed(rows, key, dim, total)
    rows = rows.join(cold, F.col("_row_key") == F.col("_cold_key"), "left")
    added = [c for c in dim.columns if c not in ("d_key", "d_n")]
    rows = rows.withColumns({c: F.when(F.col("_hot_key").isNotNull(), F.col("_hot")[c]).otherwise(F.col("_cold")[c]) for c in added})
    return rows.drop("_row_key", "_hot_key", "_hot", "_cold_key", "_cold")


def _placed(rows: DataFrame, key: Column, dim: DataFrame, total: int) -> tuple[DataFrame, DataFrame]:
    """Rows with what the hot keys add and the key they are dealt by, and the other keys."""
    added = F.struct(*[c for c in dim.columns if c not in ("d_key", "d_n")])
    limit = total / HOT_SHARE
    hot = dim.where(F.col("d_n") > limit).select(F.col("d_key").alias("_hot_key"), added.alias("_hot"))
    cold = dim.where(F.col("d_n") <= limit).select(F.col("d_key").alias("_cold_key"), added.alias("_cold"))
    rows = rows.withColumn("_row_key", key).join(F.broadcast(hot), F.col("_row_key") == F.col("_hot_key"), "left")
    own = F.concat(F.lit("#"), F.monotonically_increasing_id().cast("string")).cast("binary")
    dealt = F.when(F.col("_hot_key").isNull() & F.col("_row_key").isNotNull(), F.col("_row_key")).otherwise(own)
    return rows.withColumn("_row_key", dealt), cold
