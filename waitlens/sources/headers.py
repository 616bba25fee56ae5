"""Headers of delimited text files, read per file.

Extracts of one input come as several files whose columns may differ in order and number, in a declared
charset and with banner lines above the header. The driver opens each file through the store that holds
it and reads only the lines down to its header; files with the same header form one ``Layout``, which is
read as one table. What is read here grows with the number of files, not with their size.
"""

from __future__ import annotations

import csv
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import SparkSession


@dataclass(frozen=True)
class Layout:
    """Files with the same header."""

    names: tuple[str, ...]
    files: tuple[str, ...]


def _hidden(entry) -> bool:
    return entry.getPath().getName().startswith(("_", "."))


def list_files(spark: SparkSession, path: str | Sequence[str]) -> list[str]:
    """The files that a path, folder (with its subfolders) or glob names, in any store that Spark reads;
    hidden ones (``_`` and ``.``) are left out, as Spark does."""
    conf = spark._jsc.hadoopConfiguration()
    out: list[str] = []
    for one in [path] if isinstance(path, str) else path:
        place = spark._jvm.org.apache.hadoop.fs.Path(one)
        store = place.getFileSystem(conf)
        open_places = list(store.globStatus(place) or [])
        if any(c in one for c in "*?[{"):
            open_places = [e for e in open_places if not _hidden(e)]
        if not open_places:
            raise FileNotFoundError(one)
        while open_places:
            entry = open_places.pop()
            if entry.isDirectory():
                open_places.extend(e for e in store.listStatus(entry.getPath()) if not _hidden(e))
            else:
                out.append(entry.getPath().toString())
    return sorted(out)


def first_lines(spark: SparkSession, file: str, count: int, encoding: str = "UTF-8") -> list[str]:
    """Up to ``count`` first lines of a file, decoded; compressed files are opened by their ending."""
    conf = spark._jsc.hadoopConfiguration()
    place = spark._jvm.org.apache.hadoop.fs.Path(file)
    stream = place.getFileSystem(conf).open(place)
    try:
        codec = spark._jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(place)
        if codec is not None:
            stream = codec.createInputStream(stream)
        reader = spark._jvm.java.io.BufferedReader(spark._jvm.java.io.InputStreamReader(stream, encoding))
        lines = []
        while len(lines) < count and (line := reader.readLine()) is not None:
            lines.append(line.removeprefix("\ufeff") if not lines else line)
        return lines
    finally:
        stream.close()


def layouts(spark: SparkSession, path: str | Sequence[str], *, sep: str = ",", encoding: str = "UTF-8",
            skip_lines: int = 0) -> list[Layout]:
    """The different headers of the files of ``path``, below ``skip_lines`` banner lines, with their
    files. Files without a single line hold nothing and are left out."""
    found: dict[tuple[str, ...], list[str]] = {}
    for file in list_files(spark, path):
        lines = first_lines(spark, file, skip_lines + 1, encoding)
        if not lines:
            continue
        if len(lines) <= skip_lines:
            raise ValueError(f"no header below {skip_lines} banner lines in {file}")
        found.setdefault(tuple(next(csv.reader([lines[skip_lines]], delimiter=sep))), []).append(file)
    if not found:
        raise ValueError(f"no header in {path}: its files are empty")
    return [Layout(names, tuple(files)) for names, files in found.items()]
