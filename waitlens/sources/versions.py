"""Published folders in versions (S12, S13): readers never see a half-written table.

``publish_version`` lets a job write a whole new folder and only then names it in a pointer file, which
replaces the old pointer in one rename. A job that fails leaves the pointer, and so all readers, on the
version before; its folder is removed by the next ``drop_old_versions``.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable

from pyspark.sql import SparkSession

POINTER = "_CURRENT"
PREFIX = "version-"


def _path(spark: SparkSession, text: str):
    return spark._jvm.org.apache.hadoop.fs.Path(text)


def _store(spark: SparkSession, base: str):
    return _path(spark, base).getFileSystem(spark._jsc.hadoopConfiguration())


def versions(spark: SparkSession, base: str) -> list[str]:
    """Names of the version folders, oldest first; unfinished ones too."""
    store = _store(spark, base)
    if not store.exists(_path(spark, base)):
        return []
    names = [e.getPath().getName() for e in store.listStatus(_path(spark, base)) if e.isDirectory()]
    return sorted(n for n in names if n.startswith(PREFIX))


def current_name(spark: SparkSession, base: str) -> str | None:
    """Name of the version that readers use, None before the first publish."""
    place, store = _path(spark, f"{base}/{POINTER}"), _store(spark, base)
    if not store.exists(place):
        return None
    stream = store.open(place)
    try:
        return spark._jvm.java.io.BufferedReader(spark._jvm.java.io.InputStreamReader(stream, "UTF-8")).readLine()
    finally:
        stream.close()


def current(spark: SparkSession, base: str) -> str:
    """Folder of the version that readers use."""
    name = current_name(spark, base)
    if name is None:
        raise FileNotFoundError(f"nothing is published in {base}")
    return f"{base}/{name}"


def _switch(spark: SparkSession, base: str, name: str) -> None:
    store, draft = _store(spark, base), _path(spark, f"{base}/{POINTER}.{uuid.uuid4().hex}")
    stream = store.create(draft, False)
    stream.write(bytearray(name, "utf-8"))
    stream.close()
    jvm, gateway = spark._jvm, spark.sparkContext._gateway
    rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    options = gateway.new_array(rename, 1)
    options[0] = rename.OVERWRITE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(store.getUri(), spark._jsc.hadoopConfiguration())
    context.rename(draft, _path(spark, f"{base}/{POINTER}"), options)


def publish_version(spark: SparkSession, base: str, write: Callable[[str], None]) -> str:
    """Calls ``write`` with a new folder below ``base`` and makes it the current version once it returns.
    When ``write`` fails, the version before stays current."""
    base = base.rstrip("/")
    name = f"{PREFIX}{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
    write(f"{base}/{name}")
    _switch(spark, base, name)
    return f"{base}/{name}"


def drop_old_versions(spark: SparkSession, base: str, keep: int = 2) -> list[str]:
    """Removes all but the current version and the ``keep`` - 1 before it; names of the removed ones.
    Later folders than the current one belong to failed or running jobs; they stay unless older
    than the current version."""
    now = current_name(spark, base)
    older = [n for n in versions(spark, base) if now and n < now]
    gone = older[:max(0, len(older) - (keep - 1))]
    for name in gone:
        _store(spark, base).delete(_path(spark, f"{base}/{name}"), True)
    return gone
