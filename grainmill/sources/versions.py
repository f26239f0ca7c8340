"""Stored parts (a period of a table, a batch of streams) that are replaced without a gap.

A write goes to a new version folder. A numbered manifest then names the version of every part; it is written under another name and
renamed, which fails if its number is taken. So a write that fails leaves what was stored, readers see all of a write or nothing of it,
and of two writers at once the second one starts anew from the first one's manifest. A version that neither the current manifest
nor the one before mentions is removed, so a reader that has just listed its files can finish.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

from ..session import remove

MANIFESTS = "_manifests"


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _store(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark._jsc.hadoopConfiguration())


def _numbers(spark: SparkSession, root: str) -> list[int]:
    store, folder = _store(spark, root), _path(spark, f"{root}/{MANIFESTS}")
    if not store.exists(folder):
        return []
    names = [s.getPath().getName() for s in store.listStatus(folder)]
    return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json"))


def _read(spark: SparkSession, root: str, number: int) -> dict[str, str]:
    stream = _store(spark, root).open(_path(spark, f"{root}/{MANIFESTS}/{number:012d}.json"))
    try:
        return json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def _create(spark: SparkSession, root: str, number: int, parts: dict[str, str]) -> bool:
    """Write a manifest unless its number is taken."""
    store, folder = _store(spark, root), f"{root}/{MANIFESTS}"
    draft, final = _path(spark, f"{folder}/_{uuid.uuid4().hex}"), _path(spark, f"{folder}/{number:012d}.json")
    out = store.create(draft, True)
    try:
        out.write(json.dumps(parts, sort_keys=True).encode())
    finally:
        out.close()
    options = spark.sparkContext._gateway.new_array(spark._jvm.org.apache.hadoop.fs.Options.Rename, 0)
    files = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(store.getUri(), spark._jsc.hadoopConfiguration())
    try:
        files.rename(draft, final, options)
    except Exception:
        store.delete(draft, False)
        if store.exists(final):
            return False
        raise
    return True


def current(spark: SparkSession, root: str) -> dict[str, str]:
    """The version of each part; empty when nothing was stored."""
    numbers = _numbers(spark, root)
    return _read(spark, root, numbers[-1]) if numbers else {}


def paths(spark: SparkSession, root: str, wanted: Callable[[str], bool] = lambda part: True) -> list[str]:
    """Folders of the wanted parts, to be read with ``basePath`` = root."""
    return [f"{root}/version={version}/{part}" for part, version in sorted(current(spark, root).items()) if wanted(part)]


def publish(spark: SparkSession, root: str, parts: list[str], version: str, dropped: list[str] | None = None) -> None:
    """From now on the parts are those of the version, and the dropped ones are gone."""
    while True:
        numbers = _numbers(spark, root)
        number = numbers[-1] if numbers else 0
        old = _read(spark, root, number) if numbers else {}
        new = {p: v for p, v in old.items() if p not in set(dropped or [])} | dict.fromkeys(parts, version)
        if _create(spark, root, number + 1, new):
            break
    if len(numbers) > 1:
        before = _read(spark, root, numbers[-2])
        for gone in set(before.values()) - set(old.values()) - set(new.values()):
            remove(spark, f"{root}/version={gone}")
        for past in numbers[:-2]:
            remove(spark, f"{root}/{MANIFESTS}/{past:012d}.json")


@contextmanager
def replacing(spark: SparkSession, root: str, parts: list[str], dropped: list[str] | None = None) -> Iterator[str]:
    """The folder of a new version; its parts count once the block has ended without an error, else the folder goes."""
    version = uuid.uuid4().hex
    folder = f"{root}/version={version}"
    try:
        yield folder
    except BaseException:
        remove(spark, folder)
        raise
    publish(spark, root, parts, version, dropped)
