"""Session helpers shared by jobs, tests and the benchmark."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A single-JVM session for tests and the benchmark; clusters bring their own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("grainmill")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        # Recording the Python line of every Column call doubles the time to build a wide report.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession, *parts: str) -> str:
    """A path below the folder that all machines of the session share.

    ``spark.checkpoint.dir`` names it. Where a session names none, it is a folder in the warehouse, which a cluster shares too.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir") + "/_shared"
    return "/".join([root.rstrip("/"), *parts])


def written(df: DataFrame, name: str) -> DataFrame:
    """The frame computed once into the shared folder, where it stays until the folder is cleared."""
    path = shared_folder(df.sparkSession, f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def kept(df: DataFrame, name: str) -> Iterator[DataFrame]:
    """The frame computed once into the shared folder; its files go when the block ends."""
    spark = df.sparkSession
    path = shared_folder(spark, f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    try:
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        remove(spark, path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder in whatever store its path names; a missing one is fine."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
